"""Counts carried on equal counts made again, and row-level changes equal plain sets."""

import os
import random

import pytest
from frames import rows
from pyspark.sql import functions as F

from casewatch.operators import incremental, signals
from casewatch.sources import buckets, compare, tables

DRUG, REAC = "primaryid string, drugname string, role_cod string", "primaryid string, pt string"


def reports(spark, seed, ids):
    rng = random.Random(seed)
    drug = [(str(i), rng.choice(["A", "B", "C", None]), rng.choice(["PS", "PS", "C"])) for i in ids for _ in range(rng.randrange(4))]
    reac = [(str(i), rng.choice("xyz")) for i in ids for _ in range(rng.randrange(4))]
    return spark.createDataFrame(drug, DRUG), spark.createDataFrame(reac, REAC)


@pytest.mark.parametrize("seed", [1, 2])
def test_carried_on_counts_equal_a_recount(spark, seed):
    old = reports(spark, seed, range(80))
    kept = [df.filter("cast(primaryid as int) >= 25") for df in old]
    new = reports(spark, seed + 100, [*range(10, 25), *range(80, 110)])  # 0-9 are lost, 10-24 replaced
    now = [a.unionByName(b) for a, b in zip(kept, new)]
    touched = spark.createDataFrame([(str(i),) for i in [*range(30), *range(80, 110), 999]], "primaryid string")
    before, after = ([incremental.of_reports(df, touched) for df in side] for side in (old, now))
    stored = incremental.report_counts(*old)
    found = incremental.carried_on(stored, incremental.report_counts(*before), incremental.report_counts(*after))
    assert rows(found) == rows(incremental.report_counts(*now))
    names = ["drugname", "pt", "a", "b", "c", "d", "N", "PRR", "ROR", "chi2", "is_signal"]
    assert rows(incremental.scored(found), *names) == rows(signals.disproportionality(*now), *names)


def test_all_reports_lost_and_none_before(spark):
    old, none = reports(spark, 3, range(20)), reports(spark, 3, [])
    counts, nothing = incremental.report_counts(*old), incremental.report_counts(*none)
    assert rows(incremental.carried_on(counts, counts, nothing)) == [] == rows(nothing)
    assert rows(incremental.carried_on(nothing, nothing, counts)) == rows(counts)


def pairs(spark, data):
    return spark.createDataFrame(data, "k string, v string, n int")


BEFORE = [("a", "1", 1), ("b", "1", 1), ("c", "1", None), ("c", "1", None), ("d", "x", 1), (None, "n", 1), ("e", "p", 1), ("e", "q", 1)]
AFTER = [("a", "1", 1), ("b", "2", 1), ("c", "1", None), ("f", "1", 1), (None, "n", 2), ("e", "q", 1), ("e", "p", 1)]
CHANGES = [("b", "changed", 1, 1), ("c", "changed", 2, 1), ("d", "lost", 1, 0), ("f", "added", 0, 1), (None, "changed", 1, 1)]


@pytest.mark.parametrize("parts", [1, 4, 256])
def test_changed_keys(spark, parts):
    found = compare.changed_keys(pairs(spark, BEFORE), pairs(spark, AFTER), "k", parts)
    assert sorted(rows(found), key=repr) == sorted(CHANGES, key=repr)
    assert compare.changed_keys(pairs(spark, BEFORE), pairs(spark, BEFORE), "k", parts).count() == 0
    more = pairs(spark, BEFORE).withColumn("w", F.lit(None).cast("int"))
    assert compare.changed_keys(pairs(spark, BEFORE), more.withColumn("w", F.when(F.col("k") == "a", 1)), "k").collect()[0][:2] == ("a", "changed")


def test_equal_buckets_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    whole = pairs(spark, [(f"k{i}", "v", i) for i in range(300)])
    buckets.write(whole, path, "k", 32)
    known = buckets.manifest(spark, path)
    only = buckets.buckets_with(pairs(spark, [("k5", "", 0)]), "k", 32)
    changed = buckets.read(spark, path, known, only).withColumn("v", F.when(F.col("k") == "k5", "w").otherwise(F.col("v")))
    buckets.write(changed, path, "k", only=only)
    assert rows(compare.changed_rows(spark, path, "k", 1, 2)) == [("k5", "changed", 1, 1)]
    for folder in buckets.folders(path, known):  # a comparison that read them would fail
        if not any(folder.endswith(f"_bucket={b}") for b in only):
            for file in os.scandir(folder.removeprefix("file:")):
                if file.name.endswith(".parquet"):
                    os.truncate(file.path, 0)
    assert rows(compare.changed_rows(spark, path, "k", 1, 2)) == [("k5", "changed", 1, 1)]


def test_versions_without_buckets_are_compared_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    for data in (BEFORE, AFTER):
        tables.write_version(pairs(spark, data), path)
    assert sorted(rows(compare.changed_rows(spark, path, "k", 1, 2)), key=repr) == sorted(CHANGES, key=repr)
