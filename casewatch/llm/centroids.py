"""Centroid clustering of vectors by popcounts over bit planes.

Components become integers. Bit b of all 64 components of a vector makes one 64-bit
number, its plane b; the highest plane has a negative weight, as in two's complement.
The dot product of a vector and a centroid is then the sum over pairs of planes of
weight times the number of bits that both planes have set, which is exact, and so are
the squared distances. Vectors are packed once; a round sends the centroids to the
tasks and gets one row of sums per centroid and task back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from casewatch.llm.common import checkpoint

WIDTH, SCALE = 64, 256
CENTROIDS, ROUNDS, SEED = 40, 5, 2
#: Integers below this in size; squared distances then stay below 2^60.
LARGEST = 1 << 26
_ROWS_AT_ONCE = 2048
_SUMS = [f"s{i}" for i in range(WIDTH)]


@dataclass(frozen=True)
class Clustering:
    """assigned: vec_id, cluster, distance of every vector kept. centroids: their integers, by number."""

    assigned: DataFrame
    centroids: list[list[int]]


def integers(embedding: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component; NULL for vectors that are not kept."""
    values = embedding.cast("array<double>")
    fits = F.forall(values, lambda x: x.isNotNull() & (F.abs(x) < LARGEST // scale))  # NaN counts as larger
    return F.when((F.size(values) == WIDTH) & fits, F.transform(values, lambda x: F.floor(x * scale)))


def planes_of(vectors: np.ndarray) -> np.ndarray:
    """(n, planes) numbers from (n, 64) integers: as many planes as the largest needs, with its sign."""
    largest = max(int(vectors.max(initial=0)), ~int(vectors.min(initial=0)))
    bits = [((vectors >> b) & 1).astype(np.uint8) for b in range(largest.bit_length() + 1)]
    return np.stack([np.packbits(x, axis=1, bitorder="little").view("<u8")[:, 0] for x in bits], axis=1)


def weights_of(planes: np.ndarray) -> np.ndarray:
    weights = np.int64(1) << np.arange(planes.shape[1], dtype=np.int64)
    weights[-1] = -weights[-1]
    return weights


def dots(planes: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Exact dot products of all vectors with one, both given as planes."""
    weights, total = weights_of(planes), np.zeros(len(planes), dtype=np.int64)
    for weight, plane in zip(weights_of(other[None]).tolist(), other):
        total += weight * (np.bitwise_count(planes & plane) @ weights)
    return total


def unpacked(planes: np.ndarray) -> np.ndarray:
    """(n, 64) integers from their planes."""
    result = np.zeros((len(planes), WIDTH), dtype=np.int64)
    for b, weight in enumerate(weights_of(planes).tolist()):
        bits = np.unpackbits(planes[:, b : b + 1].copy().view(np.uint8), axis=1, bitorder="little")
        result += weight * bits.astype(np.int64)
    return result


def nearest(planes: np.ndarray, norms: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Number of and squared distance to the nearest centroid; of equal ones the smaller number."""
    best, cluster = np.full(len(planes), np.iinfo(np.int64).max), np.zeros(len(planes), dtype=np.int32)
    for number, centroid in enumerate(centroids):
        other = planes_of(np.array([centroid], dtype=np.int64))[0]
        distance = norms - 2 * dots(planes, other) + sum(x * x for x in centroid)
        closer = distance < best
        best[closer], cluster[closer] = distance[closer], number
    return cluster, best


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """(planes, norms, vec_id) of rows with equally many planes, some thousand at a time."""
    packed = batch.column("planes").to_pylist()
    lengths = np.array([len(p) for p in packed])
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        for at in range(0, len(places), _ROWS_AT_ONCE):
            some = places[at : at + _ROWS_AT_ONCE]
            planes = np.frombuffer(b"".join(packed[i] for i in some), dtype="<u8").reshape(len(some), -1)
            rows = pa.array(some)
            yield planes, batch.column("norm").take(rows).to_numpy(), batch.column("vec_id").take(rows)


def _packed(vectors: DataFrame) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("q").flatten().to_numpy().reshape(-1, WIDTH)
            planes = planes_of(rows)
            flat, step = planes.tobytes(), planes.shape[1] * 8
            binary = pa.array([flat[i * step : (i + 1) * step] for i in range(len(rows))], pa.binary())
            norms = pa.array((rows * rows).sum(axis=1))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), binary, norms], ["vec_id", "planes", "norm"])

    return vectors.mapInArrow(pack, "vec_id bigint, planes binary, norm bigint")


def _sums(packed: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """cluster, n and s0..s63: the sums of the vectors nearest to each centroid."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(centroids), dtype=np.int64)
        totals = np.zeros((len(centroids), WIDTH), dtype=np.int64)
        for batch in batches:
            for planes, norms, _ in _blocks(batch):
                cluster, _ = nearest(planes, norms, centroids)
                counts += np.bincount(cluster, minlength=len(centroids))
                np.add.at(totals, cluster, unpacked(planes))
        met = np.flatnonzero(counts)
        columns = [pa.array(met.astype(np.int32)), pa.array(counts[met]), *(pa.array(t) for t in totals[met].T)]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", *_SUMS])

    partial = packed.mapInArrow(add, "cluster int, n bigint, " + ", ".join(f"{s} bigint" for s in _SUMS))
    return partial.groupBy("cluster").agg(*(F.sum(c).alias(c) for c in ["n", *_SUMS]))


def cluster(
    embeddings: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: int = SEED,
) -> Clustering:
    """Vectors of 64 components in clusters around centroids that are their members' means, rounded down.

    Vectors that are null, have another length or null or non-finite components are left
    out, as are those with a component of 2^18 or more in size, whose squared distances
    might not fit a bigint. The first centroids are the vectors with the smallest SHA-256
    of `seed:vec_id`, of equal ids (rows may be repeated) the smallest vectors; vectors
    without an id come last. Fewer vectors than `centroids` give as many centroids, an
    empty table none and no rows. Rows are kept as they are, repeated and null ids
    included. Only the named columns are read.
    """
    kept = embeddings.select(F.col(vec_id).cast("bigint").alias("vec_id"), integers(F.col(embedding)).alias("q"))
    kept = kept.filter("q is not null")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).asc_nulls_last()
    current = [list(r["q"]) for r in kept.orderBy(order, "q").limit(centroids).collect()]
    packed = checkpoint(_packed(kept))
    for _ in range(rounds if current else 0):
        for row in _sums(packed, current).collect():  # at most one row per centroid
            current[row["cluster"]] = [row[s] // row["n"] for s in _SUMS]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for planes, norms, ids in _blocks(batch):
                number, distance = nearest(planes, norms, current)
                columns = [ids, pa.array(number), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    assigned = checkpoint(packed.mapInArrow(assign, "vec_id bigint, cluster int, distance bigint"))
    return Clustering(assigned, current)


def described(found: Clustering) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Inertias are sums of distances; beyond a bigint they are NULL.
    """
    exact = F.col("distance").cast("decimal(38,0)")
    per_cluster = found.assigned.groupBy("cluster").agg(F.sum(exact).alias("own"))
    total = per_cluster.agg(F.sum("own")).first()[0]
    spark = found.assigned.sparkSession
    texts = [(k, ",".join(map(str, c))) for k, c in enumerate(found.centroids)]
    digests = spark.createDataFrame(texts, "cluster int, text string")
    known = digests.join(per_cluster, "cluster").select(
        "cluster",
        F.col("own").try_cast("bigint").alias("cluster_inertia"),
        F.lit(total).try_cast("bigint").alias("inertia"),
        F.sha2("text", 256).alias("centroid_sha256"),
    )
    return found.assigned.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", *known.columns[1:])
