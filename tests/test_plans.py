"""Plan shapes that matter at scale."""

import re

import pytest
from frames import plan

from casewatch.operators import merge, quality, signals, silver
from casewatch.plans.catalog import Reports
from casewatch.schema import CHILDREN, raw_schema

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Silver tables on disk, so that scans are seen."""
    root = str(tmp_path_factory.mktemp("silver"))
    loaded = Reports(spark, SF).loaded
    for t in ("demo", *CHILDREN):
        loaded[t].write.parquet(f"{root}/{t}")
    return {t: spark.read.parquet(f"{root}/{t}") for t in ("demo", *CHILDREN)}


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_latest_version_limits_before_the_exchange(spark, stored):
    text = plan(silver.latest_version(stored["demo"]))
    limits = [m.start() for m in re.finditer("WindowGroupLimit", text)]
    assert len(limits) == 2 and limits[0] < text.index("Exchange") < limits[1]
    assert text.count("Exchange") == 1


def test_cleaning_children_does_not_shuffle(spark):
    for t in CHILDREN:
        assert "Exchange" not in plan(silver.clean_child(t, spark.createDataFrame([], raw_schema(t))))


def test_suspects_are_pushed_into_the_scan(spark, stored):
    text = plan(signals.drug_event_pairs(stored["drug"], stored["reac"]))
    assert "EqualTo(role_cod,PS)" in text
    assert "ReadSchema: struct<primaryid:string,role_cod:string,drugname:string>" in text
    assert "ReadSchema: struct<primaryid:string,pt:string>" in text


def test_known_names_are_pushed_into_the_scan(spark, stored):
    scored = signals.disproportionality(stored["drug"], stored["reac"])
    text = plan(signals.known_pairs(scored, [("A", "X"), ("B", "Y")]))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert any("upper(drugname" in line for line in scans) and any("upper(pt" in line for line in scans)


def test_counts_share_their_exchanges(spark, stored, no_broadcast):
    counts = signals.count_reports(stored["drug"], stored["reac"])
    counts.collect()
    final = plan(counts)
    assert final.count("ReusedExchange [primaryid") >= 4
    # Pairs are counted where they are joined: nothing is shuffled on all three columns.
    assert not re.search(r"hashpartitioning\(primaryid#\d+, drugname#\d+, pt", final)


@pytest.fixture()
def small_partitions(spark):
    """Partitions of a few KB already count as skewed."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        # a partition is split by the map tasks that it comes from, so several are needed
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k in settings:
        spark.conf.unset(k)


def hot_rows(spark, n, *columns):
    """n rows, a third of them of one report."""
    key = "if(id % 3 = 0, 'hot', cast(id % 1000 as string)) primaryid"
    return spark.range(0, n, 1, 8).selectExpr(key, *columns)


def test_orphan_filter_splits_a_hot_report(spark, no_broadcast, small_partitions):
    """The child and DEMO both hold a report with a third of their rows."""
    child = hot_rows(spark, 30000, "concat('row ', id) x")
    demo = child.select("primaryid")
    kept = silver.keep_valid(child, demo)
    assert len(kept.collect()) == 30000
    assert "SortMergeJoin(skew=true) [primaryid" in plan(kept)
    refreshed = merge.refresh_child(child, child.filter("primaryid <> 'hot'"), demo)
    assert len(refreshed.collect()) == 30000
    assert "SortMergeJoin(skew=true) [primaryid" in plan(refreshed)


@pytest.mark.parametrize("n_drugs,n_events", [(30000, 60), (60, 30000)])
def test_hot_report_is_split(spark, no_broadcast, small_partitions, n_drugs, n_events):
    """Pairs, the totals of the hot side and deaths split a report with very many rows."""
    drug = hot_rows(spark, n_drugs, "'PS' role_cod", "concat('drug ', id) drugname")
    reac = hot_rows(spark, n_events, "concat('event ', id) pt")
    outc = spark.createDataFrame([("hot", "DE"), ("1", "DE"), ("x", "DE")], "primaryid string, outc_cod string")
    counts = signals.count_reports(drug, reac)
    assert counts.count() == counts.select("drugname", "pt").distinct().count()
    counts.collect()
    joins = re.findall(r"SortMergeJoin(?:\(skew=true\))? \[primaryid[^\n]*", plan(counts))
    assert sum("skew=true" in j for j in joins) >= 2 and any("skew=true" in j and "LeftSemi" in j for j in joins)
    deaths = signals.death_reports(drug, reac, outc)
    deaths.collect()
    text = plan(deaths).split("Initial Plan")[0]  # the final plan; it has no subqueries
    joins = re.findall(r"SortMergeJoin(?:\(skew=true\))? \[primaryid[^\n]*", text)
    assert len(joins) == 2 and "skew=true" in joins[0]
    assert n_drugs < n_events or "skew=true" in joins[1]
    assert "REPARTITION" not in text


def test_stored_rows_move_once_in_an_upsert(spark, stored, no_broadcast):
    text = plan(merge.refresh_child(stored["drug"], stored["drug"], stored["demo"]))
    initial = text.split("Initial Plan")[-1]
    joins = re.findall(r"SortMergeJoin[^\n]*", initial)
    assert len(joins) == 2 and all("LeftSemi" in j for j in joins)
    # Both inputs of each join are a sort over an exchange, the shape AQE can split.
    for block in initial.split("SortMergeJoin")[1:]:
        assert re.findall(r"\+- Exchange hashpartitioning\(primaryid#\d+, \d+\)", block)


def test_demo_upsert_joins_two_columns_of_the_target(spark, stored, no_broadcast):
    text = plan(merge.demo_actions(stored["demo"], stored["demo"]))
    assert "ReadSchema: struct<caseid:string,caseversion:int>" in text


def test_quality_scans_each_table_few_times(spark, stored):
    text = plan(quality.run_checks(stored))
    assert text.count("FileScan") == 7 and text.count("Exchange hashpartitioning") == 1
    assert "Join" not in text


def test_top_lists_do_not_sort_everything(spark, stored):
    scored = signals.disproportionality(stored["drug"], stored["reac"])
    for df in (signals.top_signals(scored), signals.signals_per_drug(scored)):
        assert "TakeOrderedAndProject" in plan(df)


@pytest.mark.parametrize("name, most", [("fatal_signals", 30), ("signals_per_drug", 30), ("merge_child", 15)])
def test_scans_are_not_planned_over_and_over(spark, name, most):
    from casewatch.plans.catalog import queries

    assert plan(queries()[name](spark, SF)).count("FileScan") < most
