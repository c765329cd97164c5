import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from casewatch.llm import mixing

from .helpers import awkward_documents, documents, prose, tuples


def big(n=300):
    return [(i, prose(i, 30 + i * 7 % 400), "en", ["hot", "hot", "b", "c", None][i % 5], 1) for i in range(n)]


def plain_targets(sizes, weights):
    """Water-filling by bisection of the level."""
    low, high = 0.0, 1e12
    for _ in range(300):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(3 * s, level * w) for s, w in zip(sizes, weights)) < sum(sizes) else (low, level)
    return [min(3 * s, high * w) for s, w in zip(sizes, weights)]


@given(st.lists(st.tuples(st.integers(0, 10_000), st.integers(1, 3)), min_size=1, max_size=12))
@settings(max_examples=200, deadline=None)
def test_targets_equal_bisection(pairs):
    sizes, weights = [p[0] for p in pairs], [float(p[1]) for p in pairs]
    found = mixing.targets(sizes, weights)
    assert np.allclose(found, plain_targets(sizes, weights), rtol=1e-6, atol=1e-3)
    assert abs(sum(found) - sum(sizes)) <= 1e-6 * max(1, sum(sizes))


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutations(n):
    for key in (0, 5, 77):
        found = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, key))
        assert sorted(found.tolist()) == list(range(n))
    if n > 100:
        one, two = (mixing.permuted(np.arange(n), np.full(n, n), np.full(n, k)) for k in (1, 2))
        assert (one != two).mean() > 0.9 and abs(np.corrcoef(one, np.arange(n))[0, 1]) < 0.2


def test_draws_add_up_to_their_mean():
    expected = np.array([10.3, 0.0, 5.2, 100.5])
    drawn = np.array([mixing.draw(expected, np.random.default_rng([1, k])) for k in range(2000)])
    assert (drawn.sum(axis=1) == 116).all()
    assert np.allclose(drawn.mean(axis=0), expected, atol=0.1)


def test_sources_come_near_their_targets(spark):
    rows = big()
    found = mixing.taken_words(mixing.mix(documents(spark, rows))).collect()
    sizes = {i: len(t.split()) for i, t, *_ in rows}
    assert sorted((r.doc_id, r["size"]) for r in found) == sorted(sizes.items())
    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    source_of = {r[0]: r[3] for r in rows}
    totals = [sum(sizes[r[0]] for r in rows if r[3] == s) for s in names]
    wanted = plain_targets(totals, [1.0, 2.0, 3.0, 1.0][: len(names)])
    for s, total, target in zip(names, totals, wanted):
        own = [r for r in found if source_of[r.doc_id] == s]
        assert {r.source_size for r in own} == {total}
        assert all(abs(r.target - target) < 1e-3 for r in own)
        assert abs(sum(r.taken for r in own) - target) <= max(0.02 * target, 2 * mixing.BLOCK_WORDS)
    assert all(0 <= r.taken <= 3 * r["size"] for r in found)


def test_reruns_agree_in_any_order(spark):
    rows = awkward_documents()
    one = mixing.taken_words(mixing.mix(documents(spark, rows, ("size", "source_no", "block", "digest", "pass"))))
    two = mixing.taken_words(mixing.mix(documents(spark, rows[::-1]).repartition(7)))
    assert tuples(one) == tuples(two)
    assert one.count() == len(rows)
    assert all(r.taken <= 3 * r["size"] for r in one.collect())


def test_tables_without_rows_or_words(spark):
    assert tuples(mixing.taken_words(mixing.mix(documents(spark, [])))) == []
    found = tuples(mixing.taken_words(mixing.mix(documents(spark, [(1, None, None, None, None), (2, " ", "x", "s", 0)]))))
    assert found == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_mixed_documents_hold_the_words_taken(spark):
    rows = big(120) + [(None, prose(5, 90), None, "b", None), (7, prose(7, 300), "en", "hot", 1), (7, prose(7, 300), "en", "hot", 1)]
    frame = documents(spark, rows, ("row", "pass", "spans", "taken", "hash"))
    taken = {}
    for r in mixing.taken_words(mixing.mix(frame)).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    out = mixing.mixed_documents(frame)
    assert out.columns == frame.columns
    words = {}
    texts = {(r[0], w) for r in rows for w in r[1].split()}
    for r in out.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
        assert r.n_chars == len(r.text)
        assert all((r.doc_id, w) in texts for w in r.text.split())
    assert words == {i: n for i, n in taken.items() if n}


def test_one_id_and_text_in_two_sources_are_two_documents(spark):
    text = prose(3, 500)
    rows = [(1, text, "en", "a", 1), (1, text, "de", "b", 1), (2, prose(4, 500), "fr", None, 1), (2, prose(4, 500), "fr", None, 1)]
    mixed = mixing.mix(documents(spark, rows))
    wanted = {}
    for r in mixed.pieces.filter("pass is not null").select("source_no", "start", "pass", "n_words").collect():
        key = (["a", "b", None][r.source_no], r["pass"])
        wanted[key] = wanted.get(key, 0) + r.n_words
    out = mixing.mixed_documents(documents(spark, rows)).collect()
    per_source = {}
    for r in out:
        assert (r.source, r.lang) in {("a", "en"), ("b", "de"), (None, "fr")}
        per_source[r.source] = per_source.get(r.source, 0) + len(r.text.split())
    for name in ("a", "b", None):
        assert per_source.get(name, 0) == sum(n for (s, _), n in wanted.items() if s == name)
    assert per_source["b"] > 0


def test_mixed_documents_of_an_empty_table(spark):
    assert mixing.mixed_documents(documents(spark, [])).count() == 0


def test_taken_words_by_hand(spark):
    """`taken` from the slots alone: blocks are cut from each source's stream of words."""
    frame = documents(spark, big(60))
    mixed = mixing.mix(frame)
    slots = {}
    for r in mixing._slots(frame, mixed.sources, 7).collect():
        slots[r.source_no, r.block] = slots.get((r.source_no, r.block), 0) + 1
    places = mixed.pieces.select("source_no", "doc_id", "start", "size").distinct().collect()
    wanted = {}
    for r in places:
        n = sum(slots.get((r.source_no, w // mixing.BLOCK_WORDS), 0) for w in range(r.start, r.start + r.size))
        wanted[r.doc_id] = wanted.get(r.doc_id, 0) + n
    found = {}
    for r in mixing.taken_words(mixed).collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + r.taken
    assert found == wanted


def test_cut_keeps_white_space_and_joins_neighbours():
    text = "  a b\n\nc  d e "
    assert mixing.cut(text, [(0, 5)]) == text
    assert mixing.cut(text, [(0, 1), (1, 2), (4, 1)]) == "a b\n\nc\ne"
    assert mixing.cut(None, []) is None
    assert re.split(r"\s+", mixing.cut(text, [(1, 3)])) == ["b", "c", "d"]
