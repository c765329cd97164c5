import numpy as np
import pytest

from casewatch.llm import embeddings

from .helpers import tuples

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, first string, cell string"


def table(spark, vectors):
    rows = [(i, v, 0, "e", "e", "e") for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA)


def plain(vectors, threshold=0.9):
    def good(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    units = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if good(v) else None for _, v in vectors]
    n, links, group = len(vectors), [0] * len(vectors), list(range(len(vectors)))
    for i in range(n):
        for j in range(n):
            if i != j and units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]):
                if float(units[i] @ units[j]) >= threshold:
                    links[i] += 1
                    for k in range(n):
                        low, high = sorted((group[i], group[j]))
                        group = [low if g == high else g for g in group] if low != high else group
    lows = {}
    for (vec_id, _), g in zip(vectors, group):
        if vec_id is not None:
            lows[g] = min(lows.get(g, vec_id), vec_id)
    out = []
    for (vec_id, _), g, n in zip(vectors, group, links):
        out.append((vec_id, n, lows.get(g), vec_id == lows.get(g)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(3)
    rows = []
    for centre in rng.normal(size=(40, 16)):
        for _ in range(rng.integers(1, 9)):
            rows.append((centre + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.35])).astype(np.float32).tolist())
    return list(enumerate(rows))


def test_links_equal_brute_force(spark, clustered):
    found = tuples(embeddings.near_duplicates(table(spark, clustered), codewords=8))
    assert found == plain(clustered)


def test_hot_groups_in_several_blocks(spark, clustered, monkeypatch):
    monkeypatch.setattr(embeddings, "MEMBER_BLOCK", 16)
    monkeypatch.setattr(embeddings, "PROBE_BLOCK", 16)
    assert tuples(embeddings.near_duplicates(table(spark, clustered), codewords=4)) == plain(clustered)


def test_recall_at_the_threshold_itself():
    rng = np.random.default_rng(5)
    sample = rng.normal(size=(3000, 32))
    index = embeddings.fit(sample.tolist(), 32, codewords=32, recall=0.95)
    units = embeddings.unit(rng.normal(size=(2000, 32)).tolist(), 32)
    away = rng.normal(size=units.shape)
    away -= (away * units).sum(axis=1, keepdims=True) * units
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    partners = 0.9 * units + np.sqrt(0.19) * away
    here, there, rows = index.beyond(units), index.beyond(partners), np.arange(2000)

    def met(of, to):
        return of[0][rows, to[0].argmin(axis=1)] + of[1][rows, to[1].argmin(axis=1)] <= index.limit

    assert (met(here, there) | met(there, here)).mean() >= 0.9


@pytest.mark.parametrize("dimension", [4, 8, 16])
def test_recall_of_real_pairs_near_a_subspace(dimension):
    rng = np.random.default_rng(dimension)
    inner = rng.normal(size=(4000, dimension))
    inner[2000:] = inner[:2000] + rng.normal(size=(2000, dimension)) * 0.4 * np.linalg.norm(inner[:2000], axis=1, keepdims=True) / dimension**0.5
    vectors = inner @ rng.normal(size=(dimension, 64)) + rng.normal(size=(4000, 64)) * 0.01
    index = embeddings.fit(vectors.tolist(), 64)
    units = embeddings.unit(vectors.tolist(), 64)
    a, b = np.nonzero(np.triu(units @ units.T >= 0.9, 1))
    beyond = index.beyond(units)
    first, second = beyond[0].argmin(axis=1), beyond[1].argmin(axis=1)

    def met(i, j):
        return beyond[0][i, first[j]] + beyond[1][i, second[j]] <= index.limit

    assert len(a) > 500 and (met(a, b) | met(b, a)).mean() >= 0.998


def test_awkward_vectors(spark):
    vectors = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [None, 1.0]),
        (7, [1.0, 0.0]), (8, [1.0, 0.0]), (8, [1.0, 0.0]), (None, [2.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [1e30, 1e29]),
        (11, [1e-30, 0.0]), (12, [-1.0, 0.0]), (None, None), (13, [0.5]), (14, [-0.0, 1.0]), (15, [0.0, 1.0]),
    ]
    found = {(r[0], r[1], r[2]) for r in tuples(embeddings.near_duplicates(table(spark, vectors)))}
    expected = {(r[0], r[1], r[2] if r[2] is not None else None) for r in plain(vectors)}
    assert found == expected


def test_empty_table(spark):
    assert tuples(embeddings.near_duplicates(table(spark, []))) == []
    assert tuples(embeddings.near_duplicates(table(spark, [(1, None)]))) == [(1, 0, 1, True)]
