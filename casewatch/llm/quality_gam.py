"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into bins and has a table with one number per bin; some pairs of
features have a table over both. A document's log-odds are the sum of the numbers that
its bins select. Tables are learned by cyclic boosting: round after round, each feature
in turn gets a shallow tree fitted to what all tables together leave unexplained.

The model is fitted on a sample of labelled documents of at most `max_rows` rows; every
document is scored on its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from casewatch.llm.quality_rules import STOP_WORDS

MAX_ROWS = 20_000
BINS, ROUNDS, RATE, SHRINK, LEAF_ROWS = 32, 150, 0.15, 5.0, 10
PAIRS, PAIR_BINS, PAIR_ROUNDS = 6, 8, 60

FEATURES = (
    "log_words", "bytes_per_word", "upper_share", "digit_share", "symbol_share", "mark_share", "bang_share",
    "bar_share", "stop_share", "distinct_share", "repeat_share", "dup_line_share", "caps_word_share",
    "log_line_words",
)

_STOP = frozenset(w.encode() for w in STOP_WORDS)


def _classes() -> np.ndarray:
    """Rows that pick classes of bytes from a histogram of all 256."""
    groups = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>@^~_=+\\{}[]", b".,;:()\"'-", b"!?", b"|")
    rows = np.zeros((len(groups), 256))
    for row, group in zip(rows, groups):
        row[list(group)] = 1
    return rows


_CLASSES = _classes()


def features(text: str | None) -> list[float]:
    """The values of FEATURES for a whole text; null is the empty text, all zeros."""
    data = (text or "").encode()
    found = data.split()
    n = len(found)
    if not n:
        return [0.0] * len(FEATURES)
    shares = (_CLASSES @ np.bincount(np.frombuffer(data, np.uint8), minlength=256)) / len(data)
    lines = [line for line in data.split(b"\n") if line.strip()]
    stop = sum(map(_STOP.__contains__, data.lower().split()))
    return [
        float(np.log1p(n)),
        sum(map(len, found)) / n,
        *shares.tolist(),
        stop / n,
        len(set(found)) / n,
        sum(map(eq, found, found[1:])) / n,
        1 - len(set(lines)) / len(lines),
        sum(map(bytes.isupper, found)) / n,
        float(np.log1p(n / len(lines))),
    ]


def _best_cut(sums: np.ndarray, weights: np.ndarray, rows: np.ndarray) -> tuple[float, int]:
    """(gain, bin) of the cut behind a bin that explains most; gain 0 if none is allowed."""
    if len(sums) < 2:
        return 0.0, 0
    s, w, r = np.cumsum(sums), np.cumsum(weights), np.cumsum(rows)
    score = s[:-1] ** 2 / (w[:-1] + SHRINK) + (s[-1] - s[:-1]) ** 2 / (w[-1] - w[:-1] + SHRINK) - s[-1] ** 2 / (w[-1] + SHRINK)
    allowed = (r[:-1] >= LEAF_ROWS) & (r[-1] - r[:-1] >= LEAF_ROWS)
    score = np.where(allowed, score, 0.0)
    at = int(score.argmax())
    return float(score[at]), at + 1


def _tree(sums: np.ndarray, weights: np.ndarray, rows: np.ndarray, leaves: int = 3) -> np.ndarray:
    """One number per bin from a tree of at most `leaves` leaves over ordered bins."""
    spans = [(0, len(sums))]
    while len(spans) < leaves:
        cuts = [_best_cut(sums[a:b], weights[a:b], rows[a:b]) for a, b in spans]
        k = max(range(len(spans)), key=lambda i: cuts[i][0])
        if cuts[k][0] <= 0:
            break
        (a, b), at = spans[k], cuts[k][1]
        spans[k : k + 1] = [(a, a + at), (a + at, b)]
    out = np.zeros(len(sums))
    for a, b in spans:
        out[a:b] = sums[a:b].sum() / (weights[a:b].sum() + SHRINK)
    return out


def _pair_tree(sums: np.ndarray, weights: np.ndarray, rows: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, table) of a tree that cuts one feature, then either side by the other."""
    best, table = 0.0, np.zeros_like(sums)
    for flip in (False, True):
        s, w, r = (x.T if flip else x for x in (sums, weights, rows))
        for at in range(1, len(s)):
            out, gain = np.zeros_like(s), 0.0
            for part in (slice(None, at), slice(at, None)):
                a, b, c = (x[part].sum(axis=0) for x in (s, w, r))
                line = _tree(a, b, c, leaves=2)
                out[part] = line
                gain += float((2 * line * a - line**2 * (b + SHRINK)).sum())
            if gain > best:
                best, table = gain, (out.T if flip else out)
    return best, table


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Sums of the selected numbers for rows of feature values."""
        total = np.full(len(x), self.base)
        for k, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, k], "right")]
        if self.pairs:
            coarse = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.pair_edges)]
            for (i, j), table in zip(self.pairs, self.pair_tables):
                total += table[coarse[i], coarse[j]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.log_odds(x))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Distinct quantiles; a value belongs to the bin above the edges that it reaches."""
    return np.unique(np.quantile(values, np.arange(1, bins) / bins)) if len(values) else np.array([])


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Fits on rows of feature values and labels 0 or 1. Without rows every score is 0.5."""
    columns = range(x.shape[1])
    positive = float(y.sum())
    base = float(np.log((positive + 1) / (len(y) - positive + 1)))
    model = Model(base, [_edges(x[:, k], BINS) for k in columns], [])
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    if not 0 < positive < len(y):
        return model
    bins = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(model.edges)]
    rows = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, model.tables)]
    total = np.full(len(y), base)
    for _ in range(ROUNDS):
        for k in columns:
            p = _sigmoid(total)
            table, size = model.tables[k], len(model.tables[k])
            step = RATE * _tree(np.bincount(bins[k], y - p, size), np.bincount(bins[k], p * (1 - p), size), rows[k])
            table += step
            total += step[bins[k]]
    _fit_pairs(model, x, y, total)
    return model


def _fit_pairs(model: Model, x: np.ndarray, y: np.ndarray, total: np.ndarray) -> None:
    """Adds tables for the pairs of features whose tree explains most of what is left."""
    model.pair_edges = [_edges(x[:, k], PAIR_BINS) for k in range(x.shape[1])]
    coarse = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(model.pair_edges)]
    widths = [len(e) + 1 for e in model.pair_edges]

    def tree(i: int, j: int) -> tuple[float, np.ndarray]:
        p, cell, shape = _sigmoid(total), coarse[i] * widths[j] + coarse[j], (widths[i], widths[j])
        size = shape[0] * shape[1]
        grids = (np.bincount(cell, w, size).reshape(shape) for w in (y - p, p * (1 - p), np.ones(len(y))))
        return _pair_tree(*grids)

    gains = {pair: tree(*pair)[0] for pair in combinations(range(x.shape[1]), 2)}
    model.pairs = sorted(gains, key=lambda pair: (-gains[pair], pair))[:PAIRS]
    model.pair_tables = [np.zeros((widths[i], widths[j])) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(model.pairs, model.pair_tables):
            step = RATE * tree(i, j)[1]
            table += step
            total += step[coarse[i], coarse[j]]


def held_out(doc_id: Column) -> Column:
    """Whether labels of a document are kept from learning; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(
    documents: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "quality",
    max_rows: int = MAX_ROWS,
) -> Model:
    """Fits on labelled documents that are not held out, the first max_rows by a hash of the id.

    A document labelled several times counts as 1 if at least half of its labels are;
    null labels and ids count for nothing. max_rows bounds the ids that are broadcast and
    the feature rows that come to the driver. The text is the only input of a feature.
    """
    known = labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(doc_id)))
    agreed = known.groupBy(F.col(doc_id).alias("doc_id")).agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    sample = agreed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = pd.Series([features(t) for t in batch["text"]], dtype=object)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "values": values})

    labelled = texts.join(F.broadcast(sample), "doc_id")
    found = labelled.mapInPandas(rows_of, "doc_id bigint, label int, values array<double>")
    unique = found.groupBy("doc_id").agg(F.min(F.struct("values", "label")).alias("first"))
    rows = unique.select("first.*", "doc_id").orderBy("doc_id").toPandas()
    x = np.array(rows["values"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    return fit(x, rows["label"].to_numpy(dtype=float))


def score(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """(row, score, predicted) per document: the input's columns, the chance of label 1, 0 or 1.

    Null and empty texts are scored like any other, with all features zero. Repeated
    rows get equal scores.
    """

    def scores_of(texts: pd.Series) -> pd.Series:
        values = np.array([features(t) for t in texts], dtype=float).reshape(-1, len(FEATURES))
        return pd.Series(model.score(values))

    made = F.pandas_udf(scores_of, T.DoubleType()).asNondeterministic()  # so that it runs once for its two uses
    scored = documents.select(F.struct("*").alias("row"), made(F.col(text)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents that are predicted as label 1, with their own columns."""
    return score(documents, model, text).filter("predicted = 1").select("row.*")
