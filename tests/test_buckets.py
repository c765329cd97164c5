"""Tables in buckets: untouched ones keep their files, versions stay readable."""

import os

import pytest
from frames import rows
from pyspark.sql import functions as F

from casewatch.operators import merge
from casewatch.plans import layers
from casewatch.schema import CHILDREN, TABLES
from casewatch.sources import buckets, tables


def table(spark, keys, value="a"):
    return spark.createDataFrame([(k, f"{value}{n}") for n, k in enumerate(keys)], "k string, v string")


def data_files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_rewriting_some_buckets_keeps_the_files_of_others(spark, tmp_path):
    path = str(tmp_path / "t")
    keys = [f"k{i}" for i in range(200)] + [None]
    assert buckets.write(table(spark, keys), path, "k", 16) == 1
    before, known = data_files(path), buckets.manifest(spark, path)
    only = buckets.buckets_with(table(spark, ["k3", "k9"]), "k", 16)
    touched = buckets.read(spark, path, known, only)
    assert buckets.write(touched.filter("k <> 'k3'").withColumn("more", F.lit(1)), path, "k", only=only) == 2
    after = data_files(path)
    assert before.items() <= after.items()
    new = {f for f in after if f not in before}
    assert new and all(any(f"_bucket={b}/" in f for b in only) for f in new)
    now = buckets.manifest(spark, path)
    assert {b for b in now.held if now.held[b] == 2} <= set(only) and now.rows == 200
    assert {k for (k,) in tables.read_version(spark, path).select("k").collect()} == set(keys) - {"k3"}
    assert tables.read_version(spark, path).filter("more = 1").count() == touched.count() - 1
    assert tables.read_version(spark, path, 1).count() == 201
    scanned = buckets.read(spark, path, now, only).inputFiles()
    assert scanned and all("version=2" in f for f in scanned)


def test_emptied_buckets_unfinished_writes_and_pruning(spark, tmp_path):
    path = str(tmp_path / "t")
    buckets.write(table(spark, ["a", "b", "c", "d"]), path, "k", 4)
    known = buckets.manifest(spark, path)
    gone = buckets.buckets_with(table(spark, ["a"]), "k", 4)
    left = buckets.read(spark, path, known, gone).filter("k <> 'a'")
    buckets.write(left, path, "k", only=gone)
    assert rows(tables.read_version(spark, path), "k") == [("b",), ("c",), ("d",)]
    os.makedirs(f"{path}/version=3/data")  # a write that was lost
    assert tables.versions(spark, path) == [1, 2]
    assert buckets.write(tables.read_version(spark, path), path, "k", 4) == 4
    removed = buckets.prune(spark, path, 1)
    assert removed and tables.versions(spark, path) == [4]
    assert rows(tables.read_version(spark, path), "k") == [("b",), ("c",), ("d",)]


def test_empty_tables_and_changed_types(spark, tmp_path):
    path = str(tmp_path / "t")
    buckets.write(table(spark, []).limit(0), path, "k")
    assert tables.read_version(spark, path).count() == 0 and buckets.manifest(spark, path).rows == 0
    with pytest.raises(ValueError):
        buckets.write(table(spark, ["a"]).withColumn("v", F.lit(1)), path, "k", only=[0])


def child_rows(reports, table_name):
    return [(r, f"{table_name}{r}") for r in reports]


def test_a_small_batch_touches_its_own_buckets_only(spark, tmp_path):
    layout = layers.Layout(str(tmp_path), buckets=32)
    demo_columns = "primaryid string, caseid string, caseversion int, fda_dt string"
    stored = [(f"{c}1", str(c), 1, "20240101") for c in range(100, 300)]
    batch = [("1002", "100", 2, "20240401"), ("1011", "101", 1, "20240401"), ("9001", "900", 1, "20240401"), ("1020", "102", 0, "x")]
    frame = spark.createDataFrame(stored, demo_columns)
    buckets.write(frame, layout.silver("demo"), "caseid", layout.buckets)
    kids = {t: spark.createDataFrame(child_rows([p for p, *_ in stored], t), "primaryid string, v string") for t in CHILDREN}
    for t in CHILDREN:
        buckets.write(kids[t], layout.silver(t), "primaryid", layout.buckets)
    before = {t: data_files(layout.silver(t)) for t in TABLES}
    new = spark.createDataFrame(batch, demo_columns)
    stats, changed = layers._merge_demo(spark, layout, new, one_per_case=True)
    assert (stats["inserted"], stats["updated"], stats["unchanged"]) == (1, 1, 2)
    assert rows(changed) == [("1001", True, False), ("1002", False, True), ("1011", False, True), ("1020", False, False), ("9001", False, True)]
    reports = spark.createDataFrame(child_rows([p for p, *_ in batch] * 2, "new"), "primaryid string, v string")
    merged_demo = merge.merge_demo(frame, new)
    for t in CHILDREN:
        counts = layers.merge_child_table(spark, layout, t, reports, changed)
        wanted = merge.refresh_child(kids[t], reports, merged_demo)
        assert rows(tables.read_version(spark, layout.silver(t))) == rows(wanted)
        assert counts == {"before": 200, "written": 6, "after": wanted.count()}
        after = data_files(layout.silver(t))
        fresh = {f for f in after if f not in before[t]}
        assert before[t].items() <= after.items() and 0 < len({f.split("_bucket=")[1].split("/")[0] for f in fresh}) <= 4
    assert rows(tables.read_version(spark, layout.silver("demo"))) == rows(merged_demo)
    fresh = {f for f in data_files(layout.silver("demo")) if f not in before["demo"]}
    assert len({f.split("_bucket=")[1].split("/")[0] for f in fresh}) <= 2
    again = layers._merge_demo(spark, layout, new, one_per_case=True)[0]
    assert again["unchanged"] == 4 and tables.versions(spark, layout.silver("demo")) == [1, 2]
