import hashlib

import numpy as np
import pytest
import xxhash

from casewatch.llm import simhash
from casewatch.llm.components import components

from .helpers import awkward_documents, documents, prose, tuples

EXTRA = ("fp", "key", "component_id", "root", "nth", "row", "keep", "group")


def plain_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split() if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, distance=4):
    prints = [plain_fingerprint(text) for _, text in rows]
    group = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (prints[i] ^ prints[j]).bit_count() <= distance and group[i] != group[j]:
                    group[i] = group[j] = min(group[i], group[j])
                    changed = True
    low = {}
    for (doc_id, _), g in zip(rows, group):
        if doc_id is not None:
            low[g] = min(low.get(g, doc_id), doc_id)
    return [(i, format(p, "016x"), low.get(g)) for (i, _), p, g in zip(rows, prints, group)]


def test_equals_brute_force_on_awkward_rows(spark):
    rows = awkward_documents()
    found = simhash.simhash_components(documents(spark, rows, EXTRA))
    expected = sorted(plain_components([r[:2] for r in rows]), key=repr)
    assert tuples(found, "doc_id", "fingerprint", "component_id") == expected


@pytest.mark.parametrize("distance,segments", [(4, 3), (3, 2), (2, 4), (6, 3)])
def test_every_link_of_random_fingerprints_is_found(spark, distance, segments):
    rng = np.random.default_rng(distance)
    seeds = rng.integers(0, 2**63, 40, dtype=np.int64)
    prints = {int(s) for s in seeds}
    for s in seeds:
        for n in range(1, 7):  # chains of partners at growing distance
            bits = rng.choice(63, n, replace=False)
            prints.add(int(s) ^ int(sum(1 << int(b) for b in bits)))
    prints |= {-1, 0, 1, -(2**63), 2**63 - 1}
    ordered = sorted(prints)
    found = dict(
        tuples(simhash.near_links(spark.createDataFrame([(p,) for p in ordered], "fp bigint"), distance, segments), "fp", "root")
    )
    group = {p: p for p in ordered}

    def top(p):
        while group[p] != p:
            p = group[p]
        return p

    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if ((a ^ b) % 2**64).bit_count() <= distance:
                x, y = sorted((top(a), top(b)))
                group[y] = x
    assert {p: top(p) for p in ordered} == {p: found.get(p, p) for p in ordered}


def test_radii_leave_no_room():
    for distance in range(1, 9):
        for segments in range(1, 7):
            assert sum(r + 1 for r in simhash.radii(distance, segments)) == distance + 1


def test_empty_table(spark):
    assert tuples(simhash.simhash_components(documents(spark, []))) == []
    assert tuples(simhash.keep_one(documents(spark, []))) == []


def test_one_document_of_each_group_stays(spark):
    rows = awkward_documents()
    frame = documents(spark, rows, EXTRA)
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    prints = {r[1]: simhash.fingerprint(r[1]) for r in rows}
    groups = []  # of texts, by links between fingerprints
    for text, print_ in prints.items():
        near = [g for g in groups if any((prints[t] ^ print_).bit_count() <= simhash.DISTANCE for t in g)]
        groups = [g for g in groups if g not in near] + [{text}.union(*near)]

    def first(group):
        own = [r for r in rows if r[1] in group]
        return min(own, key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest()))[:2]

    assert tuples(kept, "doc_id", "text") == sorted((first(g) for g in groups), key=repr)


def test_rows_of_one_id_with_other_texts_stay_as_documents_of_their_own(spark):
    rows = [(1, prose(1, 60), "a", "s", 1), (1, prose(2, 60), "b", "s", 1), (2, prose(2, 60), "c", "s", 1), (1, prose(1, 60), "d", "s", 1)]
    kept = tuples(simhash.keep_one(documents(spark, rows)), "doc_id", "text")
    assert kept == sorted({(1, prose(1, 60)), (1, prose(2, 60))}, key=repr)


def test_rows_without_any_id_keep_one_per_group(spark):
    rows = [(None, prose(1, 60), None, None, None)] * 3 + [(None, prose(2, 60), "x", None, None), (1, prose(3, 60), "x", "s", 1)]
    kept = tuples(simhash.keep_one(documents(spark, rows)), "doc_id", "text")
    assert kept == sorted({(r[0], r[1]) for r in rows}, key=repr)


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5, 5), (None, 3)]
    found = dict(tuples(components(spark.createDataFrame(edges, "a bigint, b bigint"))))
    assert found == {**{i: 0 for i in range(201)}, **{1000 + k: 1000 for k in range(300)}}


def test_dense_group_is_linked_without_all_its_pairs(spark):
    centre = 0x0123456789ABCDEF
    prints = sorted({centre ^ (1 << a) ^ (1 << b) for a in range(63) for b in range(a)})
    found = tuples(simhash.near_links(spark.createDataFrame([(p,) for p in prints], "fp bigint")), "root")
    assert set(found) == {(prints[0],)} and len(found) == len(prints)
