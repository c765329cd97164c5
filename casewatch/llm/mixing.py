"""Mixing sources to target weights.

Every source is a stream of words, its documents one after another in a pseudorandom
order, cut into blocks of a fixed length. Output shards have a fixed number of slots. A
shard draws how many of its slots each source fills; the slots of a source are numbered
over all shards, and a pseudorandom permutation of the source's block numbers, another
one for each pass over the source, tells which block a slot takes. Blocks and slots are
joined by block number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from casewatch.llm.common import SPACE_CLASS, SPACES, checkpoint, local_table

WEIGHTS, MAX_PASSES = (1.0, 2.0, 3.0), 3
BLOCK_WORDS, SHARD_SLOTS, BUCKET_ROWS = 64, 4096, 4_000
TASK_SLOTS = 1 << 17
MAX_SOURCES = 100_000

_WORD = re.compile(rf"[^{SPACES}]+")


@dataclass(frozen=True)
class Source:
    number: int
    name: str | None
    size: int
    target: float

    @property
    def blocks(self) -> int:
        return -(-self.size // BLOCK_WORDS)

    @property
    def slots(self) -> float:
        """Slots to be filled on average, so that their words add up to the target."""
        return self.target * self.blocks / self.size if self.size else 0.0


def targets(sizes: list[int], weights: list[float], most: float = MAX_PASSES) -> list[float]:
    """Shares the sum of `sizes` by weight; what exceeds `most` times a size is shared again."""
    result, open_, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while open_:
        unit = left / sum(weights[k] for k in open_)
        full = {k for k in open_ if unit * weights[k] > most * sizes[k]}
        for k in full or open_:
            result[k] = float(most * sizes[k]) if full else unit * weights[k]
        left -= sum(result[k] for k in full)
        open_ = open_ - full if full else set()
    return result


def sources_of(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> tuple[list[Source], int]:
    """All sources by code point, null last, with size and target, and the number of rows.

    A mix names a weight for each source, so their list is small; more than MAX_SOURCES
    are refused.
    """
    grouped = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    found = grouped.limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found.sort(key=lambda r: (r.source is None, r.source or ""))
    own = [weights[k % len(weights)] for k in range(len(found))]
    wanted = targets([r["size"] for r in found], own)
    result = [Source(k, r.source, r["size"], t) for k, (r, t) in enumerate(zip(found, wanted))]
    return result, sum(r["rows"] for r in found)


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Each index below n at its place in a pseudorandom permutation of range(n) chosen by key.

    A Feistel network over the next power of four; values from n on are sent through
    again until they fall below n.
    """
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.uint64) + np.uint64(1)) // np.uint64(2))
    half = half.astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    value, todo = index.astype(np.uint64), np.ones(len(index), dtype=bool)
    while todo.any():
        left, right, m, k = value[todo] >> half[todo], value[todo] & mask[todo], mask[todo], key[todo].astype(np.uint64)
        for turn in range(4):
            mixed = (right + k + np.uint64(turn + 1)) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & m)
        value[todo] = (left << half[todo]) | right
        todo = value >= n.astype(np.uint64)
    return value.astype(np.int64)


def draw(expected: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Multinomial counts around `expected`: whole parts are given, the rest is drawn.

    That keeps each count within a few of its mean, however many shards add up.
    """
    whole = np.floor(expected)
    rest = expected - whole
    slots = int(round(rest.sum()))
    return (whole + (rng.multinomial(slots, rest / rest.sum()) if slots else 0)).astype(np.int64)


def _slots(documents: DataFrame, sources: list[Source], seed: int) -> DataFrame:
    """source_no, pass, block of every slot. None takes a block more than MAX_PASSES times."""
    spark = documents.sparkSession
    slots, blocks = np.array([s.slots for s in sources]), np.array([s.blocks for s in sources], dtype=np.int64)
    shards = max(1, -(-int(slots.sum()) // SHARD_SLOTS))

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"]:
                drawn = draw(slots / shards, np.random.default_rng([seed, shard]))
                yield pd.DataFrame({"shard": shard, "source_no": np.arange(len(drawn)), "n": drawn})

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                n = int(blocks[row.source_no])
                slot = np.arange(row.first, min(row.first + row.n, MAX_PASSES * n), dtype=np.int64)
                turn = slot // n if n else slot
                key = (turn * len(blocks) + row.source_no) * 0x10001 + seed
                block = permuted(slot % n, np.full(len(slot), n), key) if len(slot) else slot
                yield pd.DataFrame({"shard": row.shard, "source_no": row.source_no, "pass": turn, "block": block})

    tasks = max(1, min(shards, spark.sparkContext.defaultParallelism * 4))
    drawn = checkpoint(
        spark.range(0, shards, 1, tasks).mapInPandas(counts, "shard bigint, source_no int, n bigint").filter("n > 0")
    )
    before = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    numbered = drawn.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # by the slots, as their rows are too few and small for Spark to see the work behind them
    spread = numbered.repartition(max(1, -(-shards * SHARD_SLOTS // TASK_SLOTS)), "shard", "source_no")
    return spread.mapInPandas(places, "shard bigint, source_no int, pass bigint, block bigint")


@dataclass(frozen=True)
class Mix:
    """pieces: source_no, doc_id, digest, size, start, first_word, n_words, shard, pass, block.

    One row for each part of a document in a block and each slot that takes the block,
    or one row with a null pass if none does; documents without words are missing.
    sized: doc_id, source, digest, size for every document.
    """

    pieces: DataFrame
    sized: DataFrame
    sources: list[Source]


def mix(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", seed: int = 7) -> Mix:
    """Mixes all documents; the same rows give the same mix in any order and partitioning.

    A document's size is its number of words, 0 for a null text. Null ids and repeated
    rows are documents like any other. Only the named columns are read.
    """
    sized = checkpoint(
        documents.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            F.xxhash64(F.col(text)).alias("digest"),
            F.coalesce(F.regexp_count(F.col(text), F.lit(f"[^{SPACE_CLASS}]+")), F.lit(0)).cast("bigint").alias("size"),
        )
    )
    sources, rows = sources_of(sized)
    buckets = max(1, -(-rows // BUCKET_ROWS))
    turn = F.xxhash64("doc_id", F.lit(seed))
    own = _numbered(sized, sources).filter("size > 0").withColumns({"turn": turn, "bucket": F.pmod(turn, F.lit(buckets))})
    sums = own.groupBy("source_no", "bucket").agg(F.sum("size").alias("size"))
    lower = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("source_no", "bucket", F.coalesce(F.sum("size").over(lower), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source_no", "bucket").orderBy("turn", "doc_id", "digest", "size")
    placed = own.withColumn("before", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    started = placed.join(bases, ["source_no", "bucket"]).withColumn("start", F.col("base") + F.col("before"))

    first, last = F.col("start"), F.col("start") + F.col("size") - 1
    parts = started.withColumn(
        "block", F.explode(F.sequence(F.floor(first / BLOCK_WORDS), F.floor(last / BLOCK_WORDS)))
    )
    low = F.greatest(F.col("block") * BLOCK_WORDS, F.col("start"))
    high = F.least((F.col("block") + 1) * BLOCK_WORDS, F.col("start") + F.col("size"))
    parts = parts.select(
        "source_no", "block", "doc_id", "digest", "size", "start",
        (low - F.col("start")).alias("first_word"), (high - low).alias("n_words"),
    )
    # one small row of a shard becomes many slots, which Spark can't foresee: never broadcast them
    taken = _slots(documents, sources, seed).hint("merge")
    return Mix(parts.join(taken, ["source_no", "block"], "left"), sized, sources)


def _numbered(rows: DataFrame, sources: list[Source]) -> DataFrame:
    """rows with source_no, source_size and target for their `source`."""
    schema = T.StructType(
        [
            T.StructField("source_no", T.IntegerType()),
            T.StructField("name", T.StringType()),
            T.StructField("source_size", T.LongType()),
            T.StructField("target", T.DoubleType()),
        ]
    )
    known = local_table(rows.sparkSession, [(s.number, s.name, s.size, s.target) for s in sources], schema)
    return rows.join(known, rows["source"].eqNullSafe(known["name"])).drop("name")


def taken_words(mixed: Mix) -> DataFrame:
    """doc_id, size, source_size, target, taken per document, repeats counted."""
    used = F.sum(F.when(F.col("pass").isNotNull(), F.col("n_words")).otherwise(0)).alias("taken")
    per_document = mixed.pieces.groupBy("source_no", "start", "doc_id", "size").agg(used)
    names = {s.number: s for s in mixed.sources}
    schema = T.StructType(
        [
            T.StructField("source_no", T.IntegerType()),
            T.StructField("source_size", T.LongType()),
            T.StructField("target", T.DoubleType()),
        ]
    )
    known = local_table(per_document.sparkSession, [(k, s.size, s.target) for k, s in names.items()], schema)
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    empty = _numbered(mixed.sized.filter("size = 0"), mixed.sources).withColumn("taken", F.lit(0).cast("bigint"))
    return per_document.join(known, "source_no").select(columns).union(empty.select(columns))


def cut(text: str | None, spans) -> str | None:
    """The parts of a text given as (first word, number of words), with the white space inside
    each part as it is and a line break between parts."""
    if text is None:
        return None
    places = [m.span() for m in _WORD.finditer(text)]
    joined: list[list[int]] = []
    for first, n in spans:
        if joined and joined[-1][1] == first:
            joined[-1][1] = first + n
        else:
            joined.append([first, first + n])
    if joined == [[0, len(places)]]:
        return text
    return "\n".join(text[places[a][0] : places[b - 1][1]] for a, b in joined)


def mixed_documents(
    documents: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", length: str | None = "n_chars"
) -> DataFrame:
    """The mix as documents: one row per document and pass with the words taken in that pass.

    All columns are kept; `text` holds the words taken, whole texts unchanged, and
    `length` (if the table has it) their code points. Documents not taken are missing, and
    with them null and word-less texts; an empty table gives no rows. Null ids and sources
    are values like any other. Rows that agree in id, source and text are documents of their
    own, of which each takes its other columns from the first of them by a hash of the row.
    """
    mixed = mix(documents, text, doc_id, source)
    span = F.struct("first_word", "n_words")
    passes = mixed.pieces.filter("pass is not null").groupBy("source_no", "start", "doc_id", "digest", "pass")
    spans = passes.agg(F.sort_array(F.collect_list(span)).alias("spans"))
    schema = T.StructType([T.StructField("source_no", T.IntegerType()), T.StructField("name", T.StringType())])
    names = local_table(documents.sparkSession, [(s.number, s.name) for s in mixed.sources], schema)
    taken = spans.join(names, "source_no").select("doc_id", "name", "digest", "spans")

    def cuts(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([cut(t, [(s["first_word"], s["n_words"]) for s in p]) for t, p in zip(texts, spans)], dtype=object)

    make = F.pandas_udf(cuts, T.StringType()).asNondeterministic()  # so that it runs once for text and length
    single = documents.select(
        F.struct("*").alias("row"), F.col(doc_id).alias("id"), F.col(source).alias("origin"), F.xxhash64(F.col(text)).alias("hash")
    )
    if not mixed.sized.groupBy("doc_id", "source", "digest").agg(F.count("*").alias("rows")).filter("rows > 1").isEmpty():
        single = single.groupBy("id", "origin", "hash").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    same = (
        single["id"].eqNullSafe(taken["doc_id"])
        & single["origin"].eqNullSafe(taken["name"])
        & (single["hash"] == taken["digest"])
    )
    rows = single.join(taken, same).select("row", make(F.col(f"row.{text}"), "spans").alias("taken"))
    values = {text: F.col("taken")} | ({length: F.length("taken").cast("bigint")} if length in documents.columns else {})
    return rows.select(*(values.get(c, F.col(f"row.{c}")).alias(c) for c in documents.columns))
