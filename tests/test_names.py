"""The index of drug names gives what a scan of all names gives."""

import random
import re

import pytest
from frames import plan, rows, strings

from casewatch.operators import names, profile
from casewatch.plans import layers
from casewatch.sources import buckets, tables

RANDOM = random.Random(5)
NAMES = ["".join(RANDOM.choices("abcé ", k=RANDOM.randint(0, 12))) for _ in range(400)]
DRUGS = [(n, RANDOM.choice(["X", "y", None]), RANDOM.choice(["PS", "C"])) for n in NAMES * 2]
DRUGS += [(None, "abc", "PS"), ("", None, "C"), ("aaaa", None, None), ("AAAA", None, None), ("aaaa", None, None), ("𝒳abc", "z", "C")]


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    layout = layers.Layout(str(tmp_path_factory.mktemp("names")), 16)
    drug = strings(spark, names.SPELLING, DRUGS)
    layers.store_names(spark, layout, drug)
    return layout, drug


@pytest.mark.parametrize("fragments", [["abc"], ["ABCA", "é b"], ["aaa"], ["aaaaa"], ["zzz", "bab"], ["ab"], ["", "abc"], ["c", "abc"], ["𝒳AB"], [" a "]])
def test_same_rows_as_a_scan(spark, indexed, fragments):
    layout, drug = indexed
    assert rows(layers.search_names(spark, layout, fragments)) == rows(profile.name_search(drug, fragments))


def test_an_index_of_no_names_finds_nothing(spark, tmp_path):
    layout = layers.Layout(str(tmp_path), 4)
    layers.store_names(spark, layout, strings(spark, names.SPELLING, [(None, "a", "b"), ("ab", "a", "b")]))
    assert rows(layers.search_names(spark, layout, ["abc"])) == []
    assert rows(layers.search_names(spark, layout, ["B"])) == [("ab", "a", "b")]


def test_a_gram_is_listed_once_a_name(spark, indexed):
    layout, _ = indexed
    posted = tables.read_version(spark, layout.gold("name_postings"))
    assert posted.count() == posted.distinct().count() == len({(n.upper(), g) for n in [*NAMES, "aaaa", "𝒳abc"] for g in names.grams(n)})


def test_only_the_buckets_of_grams_and_candidates_are_read(spark, indexed):
    layout, _ = indexed
    path, known = layout.gold("name_postings"), buckets.manifest(spark, layout.gold("name_postings"))
    only = buckets.buckets_with(strings(spark, ["gram"], [("𝒳AB",)]), known.key, known.buckets)
    found = names.candidates(buckets.read(spark, path, known, only), ["𝒳ab"])
    assert len(only) == 1 and found.count() == 1
    assert re.search(r"PushedFilters: \[[^]]*gram", plan(found))
    searched = layers.search_names(spark, layout, ["𝒳ab"])
    assert len({f.rsplit("/", 2)[1] for f in searched.inputFiles()}) == 1
