"""SimHash near-duplicates by multi-index hashing.

A document's fingerprint has bit k set if more than half of its shingle hashes have.
Fingerprints are cut into segments. If two of them differ in at most `distance` bits,
then in some segment they differ in no more bits than that segment's radius, so one
lies in the small Hamming ball around the other's segment. Balls are enumerated as
rows, matched with the segments of all fingerprints by a join, and each match is
verified on all 64 bits inside that join.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from casewatch.llm.common import checkpoint
from casewatch.llm.components import components

SHINGLE, SEED, BITS = 4, 42, 64
DISTANCE = 4
SEGMENTS = 3
_HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint of a whole text; 0 if it has no word.

    bytes.lower and bytes.split touch exactly A-Z and the six ASCII white spaces. A
    shingle is a slice of the normalised bytes, as its words are joined by one space.
    """
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    flat = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(0, len(found) - shingle)
    spans = zip(starts[: last + 1].tolist(), ends[min(shingle, len(found)) - 1 :].tolist())
    digest, seed = xxhash.xxh64_intdigest, SEED
    hashes = np.array([digest(flat[a:b], seed) for a, b in spans], dtype=">u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), _HASHES_AT_ONCE):
        some = hashes[at : at + _HASHES_AT_ONCE].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


@pandas_udf(T.LongType())
def fingerprint_of(texts: pd.Series) -> pd.Series:
    """The fingerprint's 64 bits as a signed number."""
    return pd.Series(np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64))


def radii(distance: int, segments: int) -> list[int]:
    """Radius per segment; -1 for one that need not be searched.

    Radii plus one add up to distance + 1: differences beyond every radius would be
    more than `distance` altogether.
    """
    share, more = divmod(distance + 1, segments)
    return [share + (i < more) - 1 for i in range(segments)]


def _segments(segments: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment."""
    cuts = [BITS * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _ball(width: int, radius: int) -> list[int]:
    """All masks of up to `radius` bits out of `width`."""
    masks = {0}
    for _ in range(radius):
        masks |= {m | 1 << b for m in masks for b in range(width)}
    return sorted(masks)


def _keys(fp: Column, distance: int, segments: int, ball: bool) -> Column:
    """Segment keys of a fingerprint, or with `ball` all keys within the radii."""
    found = []
    for n, ((low, width), radius) in enumerate(zip(_segments(segments), radii(distance, segments))):
        if radius < 0:
            continue
        key = F.shiftrightunsigned(fp, low).bitwiseAND((1 << width) - 1)
        masks = _ball(width, radius) if ball else [0]
        # a key is below 2^width, the segment's number is put above it
        tagged = key.bitwiseOR(F.lit(n << 33)) if width <= 32 else F.xxhash64(F.lit(n), key)
        if width > 32 and len(masks) > 1:
            raise ValueError("a segment with a ball may have 32 bits at most")
        found.append(F.transform(F.lit(masks).cast("array<bigint>"), tagged.bitwiseXOR))
    return F.flatten(F.array(*found)) if len(found) > 1 else found[0]


def _bits_between(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def near_links(fingerprints: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """(fp, root) for each fingerprint that links with another one; root is the smallest reached.

    fingerprints: one column `fp`, distinct. Each is first compared with the smallest
    fingerprint of its segment buckets only, and takes the smallest that it links with
    as its label. Links are then sought between fingerprints of different labels and
    counted by label inside the join's stage, so that a large group of near copies is
    compared but its pairs are not returned.
    """
    # keys have no sign; grouping by it keeps the join below on exchanges of its own
    table = fingerprints.select("fp", F.explode(_keys(F.col("fp"), distance, segments, False)).alias("key"))
    first = table.groupBy("key", (F.col("key") < 0).alias("sign")).agg(F.min("fp").alias("low"))
    linked = _bits_between("fp", "low") <= distance
    labels = table.join(first.drop("sign"), "key").groupBy("fp").agg(F.min(F.when(linked, F.col("low"))).alias("label"))
    labelled = checkpoint(labels.select("fp", F.coalesce("label", "fp").alias("label")))

    probes = labelled.select(
        F.col("fp").alias("a"),
        F.col("label").alias("label_a"),
        F.explode(_keys(F.col("fp"), distance, segments, True)).alias("key"),
    )
    targets = labelled.select(
        F.col("fp").alias("b"),
        F.col("label").alias("label_b"),
        F.explode(_keys(F.col("fp"), distance, segments, False)).alias("key"),
    )
    fits = (
        (probes["key"] == targets["key"])
        & (F.col("a") < F.col("b"))
        & (F.col("label_a") != F.col("label_b"))
        & (_bits_between("a", "b") <= distance)
    )
    # a fingerprint becomes many keys, which Spark can't foresee: never broadcast them
    across = probes.join(targets.hint("merge"), fits).select("label_a", "label_b").distinct()
    return components(labelled.select("fp", "label").union(across)).select(F.col("node").alias("fp"), "root")


def _classes(prints: DataFrame, rank: Column, distance: int, segments: int) -> tuple[DataFrame, DataFrame]:
    """(fp, root) of every fingerprint, and (root, least rank) of every component."""
    per_print = prints.groupBy("fp").agg(F.min(rank).alias("low"))
    linked = near_links(per_print.select("fp"), distance, segments)
    named = per_print.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return named, named.groupBy("root", (F.col("root") < 0).alias("sign")).agg(F.min("low").alias("low")).drop("sign")


def simhash_components(
    documents: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    distance: int = DISTANCE,
    segments: int = SEGMENTS,
) -> DataFrame:
    """One row per document: doc_id, fp (signed 64 bits), fingerprint (hex), component_id.

    component_id is the smallest doc_id that links reach, the row's own included.
    Null and word-less texts have fingerprint zero, which links like any other. A null
    doc_id is no candidate for component_id, which is null only if no document of the
    component has an id. Repeated rows are kept. An empty table gives no rows. Only
    the named columns are read, so other columns may have any name.
    """
    prints = checkpoint(documents.select(F.col(doc_id).alias("doc_id"), fingerprint_of(F.col(text)).alias("fp")))
    named, lowest = _classes(prints, F.col("doc_id"), distance, segments)
    members = named.join(lowest.withColumnRenamed("low", "component_id"), "root").select("fp", "component_id")
    return prints.join(members, "fp").select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(
    documents: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    distance: int = DISTANCE,
    segments: int = SEGMENTS,
) -> DataFrame:
    """`documents` without near-duplicates: one row of each component stays.

    It is a row with the component's smallest doc_id, of equal ids the one with the first
    text by digest, of equal texts too the first by a hash of the row. Null ids come last.
    Rows that share a doc_id but not their text are documents of their own. Null and
    word-less texts are one component. All columns are kept, whatever their names; an
    empty table gives no rows.
    """
    digest = F.md5(F.coalesce(F.col(text), F.lit("")))
    prints = checkpoint(documents.select(F.col(doc_id).alias("doc_id"), digest.alias("digest"), fingerprint_of(F.col(text)).alias("fp")))
    # a struct is ordered by its first field first
    rank = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "digest")
    _, lowest = _classes(prints, rank, distance, segments)
    winners = checkpoint(lowest.select(F.col("low.doc_id").alias("keep"), F.col("low.digest").alias("print")))
    packed = documents.select(F.struct("*").alias("row"), F.col(doc_id).alias("id"), digest.alias("digest"))
    kept = packed.join(winners, (F.col("digest") == F.col("print")) & F.col("id").eqNullSafe(F.col("keep")), "left_semi")
    if not prints.groupBy("digest", "doc_id").agg(F.count("*").alias("rows")).filter("rows > 1").isEmpty():
        kept = kept.groupBy("digest", "id").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return kept.select("row.*")
