"""Embedding near-duplicates with an inverted multi-index.

Unit vectors are cut into halves. Each half has a codebook of its own, learned on a
bounded sample; a vector's cell is the pair of its nearest codewords, so the two small
codebooks make a large grid of cells. A vector visits cells in the order of their summed
distance until the target recall is reached, and only vectors in visited cells are
verified by their full cosine.

How far to go is calibrated on the sample: its linked pairs are found by brute force, and
the limit on the distance beyond the vector's own cell is set so that the wanted share of
them is met from either side. It is no less than what partners at exactly the threshold's
cosine need, in random directions and towards each vector's nearest neighbour.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from casewatch.llm.common import checkpoint
from casewatch.llm.components import components

THRESHOLD, RECALL = 0.9, 0.999
CODEWORDS, SAMPLE_ROWS, ITERATIONS = 64, 20_000, 12
MEMBER_BLOCK, PROBE_BLOCK = 2048, 16_384
#: Calibration: sample vectors that are compared with the whole sample, and linked pairs of each that count.
QUERIES, PAIRS_PER_QUERY, _QUERY_BLOCK = 4000, 64, 128
_SEED = 11


def unit(vectors, width: int) -> np.ndarray:
    """Rows of length one in double precision, padded with zeros to `width`."""
    out = np.zeros((len(vectors), width))
    for row, vector in zip(out, vectors):
        row[: len(vector)] = vector
    out /= np.abs(out).max(axis=1, keepdims=True)  # no square can overflow or vanish
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def _distances(points: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Squared distances of points to codewords."""
    return (points**2).sum(axis=1)[:, None] - 2 * points @ words.T + (words**2).sum(axis=1)


def _codebook(points: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    """Codewords by Lloyd's iterations; one without points moves to a random point."""
    words = points[rng.choice(len(points), min(size, len(points)), replace=False)]
    for _ in range(ITERATIONS):
        nearest = _distances(points, words).argmin(axis=1)
        counts = np.bincount(nearest, minlength=len(words))
        sums = np.zeros_like(words)
        np.add.at(sums, nearest, points)
        lone = points[rng.integers(len(points), size=len(words))]
        words = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], lone)
    return words


@dataclass(frozen=True)
class Index:
    """Codebooks of both halves and the limit up to which cells are visited."""

    width: int
    first: np.ndarray
    second: np.ndarray
    limit: float

    @property
    def half(self) -> int:
        return self.width // 2

    def beyond(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per half, how much farther than the nearest one each codeword is."""
        halves = (_distances(units[:, : self.half], self.first), _distances(units[:, self.half :], self.second))
        return tuple(d - d.min(axis=1, keepdims=True) for d in halves)

    def visited_firsts(self, beyond: tuple[np.ndarray, np.ndarray]) -> list[list[int]]:
        """First codewords of the visited cells, nearest first.

        The cells of a first codeword are visited up to the second codewords that the
        limit leaves room for; the nearest second one adds nothing, so that a first
        codeword is visited at all if it is within the limit itself.
        """
        order = np.argsort(beyond[0], axis=1, kind="stable")
        return [[int(k) for k in row if near[k] <= self.limit] for row, near in zip(order, beyond[0])]


def fit(vectors: list, width: int, codewords: int = CODEWORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> Index:
    """Learns an index on sample vectors, at least one."""
    rng = np.random.default_rng(_SEED)
    units = unit(vectors, width)
    half = width // 2
    index = Index(width, _codebook(units[:, :half], codewords, rng), _codebook(units[:, half:], codewords, rng), 0.0)
    rows = np.arange(len(units))

    def needed(here: tuple, there: tuple, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The limit at which a of here and b of there meet, from either side."""

        def reach(of: tuple, i: np.ndarray, to: tuple, j: np.ndarray) -> np.ndarray:
            return of[0][i, to[0].argmin(axis=1)[j]] + of[1][i, to[1].argmin(axis=1)[j]]

        return np.minimum(reach(here, a, there, b), reach(there, b, here, a))

    def partners(units: np.ndarray, away: np.ndarray) -> np.ndarray:
        away = away - (away * units).sum(axis=1, keepdims=True) * units
        away /= np.maximum(np.sqrt((away * away).sum(axis=1, keepdims=True)), 1e-300)
        return threshold * units + np.sqrt(1 - threshold**2) * away

    here = index.beyond(units)
    limits = [needed(here, index.beyond(partners(units, rng.normal(size=units.shape))), rows, rows)]
    asked = rng.choice(len(units), min(QUERIES, len(units)), replace=False)
    nearest, pairs = _neighbours(units, asked, threshold, rng)
    limits.append(needed(here, here, *pairs))
    other = nearest >= 0
    towards = partners(units[asked[other]], units[nearest[other]])
    limits.append(needed(here, index.beyond(towards), asked[other], np.arange(len(towards))))
    limit = max(float(np.quantile(found, recall, method="higher")) for found in limits if len(found))
    return Index(width, index.first, index.second, limit)


def _neighbours(units: np.ndarray, asked: np.ndarray, threshold: float, rng: np.random.Generator) -> tuple:
    """By brute force, for the rows `asked`: the nearest other row that is no copy, -1 if
    there is none, and (a, b) of their linked pairs, at most PAIRS_PER_QUERY of each row by chance.
    """
    nearest, left, right = np.full(len(asked), -1), [], []
    for at in range(0, len(asked), _QUERY_BLOCK):
        some = asked[at : at + _QUERY_BLOCK]
        cosines = units[some] @ units.T
        cosines[cosines > 1 - 1e-9] = -2  # itself and copies
        best = cosines.argmax(axis=1)
        nearest[at : at + len(some)] = np.where(cosines[np.arange(len(some)), best] > -1, best, -1)
        for row, found in zip(some, cosines >= threshold):
            near = np.flatnonzero(found)
            if len(near) > PAIRS_PER_QUERY:
                near = rng.choice(near, PAIRS_PER_QUERY, replace=False)
            left.append(np.full(len(near), row))
            right.append(near)
    return nearest, (np.concatenate(left).astype(int), np.concatenate(right).astype(int))


def _labels(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id that links reach, for the rows and columns of a link matrix."""
    while True:
        new_left = np.minimum(left, np.where(links, right, np.iinfo(np.int64).max).min(axis=1))
        new_right = np.minimum(right, np.where(links, new_left[:, None], np.iinfo(np.int64).max).min(axis=0))
        if (new_left == left).all() and (new_right == right).all():
            return left, right
        left, right = new_left, new_right


class _Group:
    """Members of one block, to be compared with probes as they come."""

    def __init__(self, index: Index, rows: pd.DataFrame) -> None:
        self._index = index
        self._rows = rows
        self._units = unit(rows["embedding"], index.width)
        self._beyond = index.beyond(self._units)
        self._ids, self._weights = rows["id"].to_numpy(), rows["weight"].to_numpy()
        self._sizes = rows["embedding"].map(len).to_numpy()
        self._cell = (rows["first"].to_numpy(), rows["second"].to_numpy())

    def links(self, probes: pd.DataFrame, threshold: float) -> list[tuple]:
        """(a, b, n): n links more for a, or with b a step between two linked vectors.

        A link found from both sides is counted by each side for its probe; one that only
        the probe's visits find is counted for the member here too.
        """
        index = self._index
        units = unit(probes["embedding"], index.width)
        beyond = index.beyond(units)
        ids, weights = probes["id"].to_numpy(), probes["weight"].to_numpy()
        sizes, first, second = probes["embedding"].map(len).to_numpy(), probes["first"].to_numpy(), probes["second"].to_numpy()
        found = np.zeros((len(ids), len(self._ids)), dtype=bool)
        own_first = int(self._cell[0][0])  # the same for all members
        for word in np.unique(self._cell[1]):
            visitors = np.flatnonzero(beyond[0][:, own_first] + beyond[1][:, word] <= index.limit)
            members = np.flatnonzero(self._cell[1] == word)
            if len(visitors):
                close = units[visitors] @ self._units[members].T >= threshold
                found[np.ix_(visitors, members)] = close
        found &= (ids[:, None] != self._ids) & (sizes[:, None] == self._sizes)
        p, m = np.flatnonzero(found.any(axis=1)), np.flatnonzero(found.any(axis=0))
        if not len(p):
            return []
        found = found[np.ix_(p, m)]
        back = self._beyond[0][m][:, first[p]] + self._beyond[1][m][:, second[p]] <= index.limit
        alone = found & ~back.T
        out = [(int(i), None, int(n)) for i, n in zip(ids[p], found @ self._weights[m])]
        out += [(int(i), None, int(n)) for i, n in zip(self._ids[m], weights[p] @ alone) if n]
        low_p, low_m = _labels(found, ids[p], self._ids[m])
        steps = {(int(i), int(k)) for i, k in [*zip(ids[p], low_p), *zip(self._ids[m], low_m)] if i != k}
        return out + [(a, b, 0) for a, b in sorted(steps)]


def _verified(index: Index, threshold: float):
    """Maps rows sorted by (cell, member block, probe block, kind), members first, to links."""

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, members, group = None, [], None
        for batch in batches:
            out: list[tuple] = []
            for (cell, mb, pb, kind), rows in batch.groupby(["cell", "mb", "pb", "kind"], sort=True):
                if key != (cell, mb, pb):
                    key, members, group = (cell, mb, pb), [], None
                if kind == 0:
                    members.append(rows)
                elif members:
                    group = group or _Group(index, pd.concat(members, ignore_index=True))
                    for at in range(0, len(rows), MEMBER_BLOCK):
                        out += group.links(rows.iloc[at : at + MEMBER_BLOCK], threshold)
            table = pd.DataFrame(out, columns=["a", "b", "n"])
            yield table.astype({"a": "int64", "b": "Int64", "n": "int64"})

    return verify


def near_duplicates(
    embeddings: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    codewords: int = CODEWORDS,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors link at a cosine of `threshold` or more; no link below it is made. Equal
    vectors are indexed once and their rows counted as links of each other. Vectors that
    are null, empty, zero, or have a null or non-finite component link with nothing, nor
    do vectors of different lengths. component_id is the smallest vec_id that links
    reach, and null ids are no candidates for it. Repeated rows are vectors of their own.
    kept is whether vec_id is component_id. Only the two named columns are read. An empty
    table gives no rows.

    Cells with many members are split into blocks, and so are their visitors. A pair of
    blocks returns sums and at most one step per vector, not its linked pairs.
    """
    value = F.col(embedding)
    sound = F.forall(value, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists(value, lambda x: x != 0)
    rows = embeddings.select(
        F.col(vec_id).alias("vec_id"), F.when(F.coalesce(sound, F.lit(False)), value).alias("embedding")
    )
    classes = rows.filter("embedding is not null").groupBy("embedding")
    counted = classes.agg(F.min("vec_id").alias("low"), F.count("*").alias("weight"))
    known = checkpoint(counted.withColumn("id", F.monotonically_increasing_id()))
    width = known.agg(F.max(F.size("embedding"))).first()[0]
    if width is None:
        return _result(rows.withColumns({"n_links": F.lit(0).cast("bigint"), "low": F.col("vec_id")}))
    sample = known.orderBy(F.xxhash64("embedding"), "id").limit(SAMPLE_ROWS).select("embedding").collect()
    index = fit([r.embedding for r in sample], width + width % 2, codewords, threshold, recall)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            beyond = index.beyond(unit(batch["embedding"], index.width))
            yield batch.assign(
                first=beyond[0].argmin(axis=1), second=beyond[1].argmin(axis=1), visits=index.visited_firsts(beyond)
            )

    kind = dict(known.dtypes)["embedding"]
    placed = checkpoint(
        known.select("id", "weight", "embedding").mapInPandas(
            assign, f"id bigint, weight bigint, embedding {kind}, first int, second int, visits array<int>"
        )
    )
    dealt = _dealt(placed, len(index.first))
    links = checkpoint(dealt.mapInPandas(_verified(index, threshold), "a bigint, b bigint, n bigint"))
    more = links.groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("more"))
    steps = components(links.filter("b is not null").select("a", "b")).withColumnRenamed("node", "id")
    described = known.join(more, "id", "left").join(steps, "id", "left").select(
        "embedding",
        "low",
        (F.col("weight") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"),
        F.coalesce("root", "id").alias("root"),
    )
    described = checkpoint(described)
    lowest = described.groupBy("root", (F.col("root") < 0).alias("sign")).agg(F.min("low").alias("lowest"))
    complete = described.join(lowest, "root").select("embedding", "n_links", F.col("lowest").alias("low"))
    good = rows.filter("embedding is not null").join(complete, "embedding")
    bad = rows.filter("embedding is null").withColumns({"n_links": F.lit(0).cast("bigint"), "low": F.col("vec_id")})
    return _result(good.select(bad.columns).union(bad))


def _dealt(placed: DataFrame, codewords: int) -> DataFrame:
    """Members and visitors of each first codeword in pairs of blocks, sorted for comparison.

    The counts that set the numbers of blocks have one row per codeword.
    """
    members = dict(placed.groupBy("first").count().collect())
    visitors = dict(placed.select(F.explode("visits").alias("v")).groupBy("v").count().collect())
    member_blocks = F.lit([-(-members.get(k, 0) // MEMBER_BLOCK) or 1 for k in range(codewords)])
    probe_blocks = F.lit([-(-visitors.get(k, 0) // PROBE_BLOCK) or 1 for k in range(codewords)])
    chance = F.xxhash64("id")
    columns = ["id", "weight", "embedding", "first", "second"]

    def all_of(blocks):
        return F.explode(F.sequence(F.lit(0), blocks - 1))

    own = placed.withColumn("cell", F.col("first")).withColumn("pb", all_of(F.get(probe_blocks, F.col("cell"))))
    own = own.select(
        "cell", F.pmod(chance, F.get(member_blocks, F.col("cell"))).cast("int").alias("mb"), "pb", F.lit(0).alias("kind"), *columns
    )
    visits = placed.withColumn("cell", F.explode("visits")).withColumn("mb", all_of(F.get(member_blocks, F.col("cell"))))
    visits = visits.select(
        "cell", "mb", F.pmod(chance, F.get(probe_blocks, F.col("cell"))).cast("int").alias("pb"), F.lit(1).alias("kind"), *columns
    )
    key = ["cell", "mb", "pb"]
    return own.union(visits).repartition(*key).sortWithinPartitions(*key, "kind")


def _result(rows: DataFrame) -> DataFrame:
    return rows.select(
        "vec_id", "n_links", F.col("low").alias("component_id"), F.col("vec_id").eqNullSafe(F.col("low")).alias("kept")
    )
