"""Two quarters through all layers, checked against the one-frame operators."""

import datetime as dt
import time

import pytest
from frames import rows
from pyspark.sql import functions as F

from casewatch.operators import merge, quality, signals, silver
from casewatch.plans import catalog, layers
from casewatch.plans.adapter import raw_tables
from casewatch.schema import CHILDREN, TABLES
from casewatch.sources import buckets, files, raw, tables

SF = "/root/testdata/sf0.001"
AS_OF = dt.date(2024, 12, 31)
TEXTS = {"reac": "pt", "outc": "outc_cod"}


@pytest.fixture(scope="module")
def project(spark, tmp_path_factory):
    layout = layers.Layout(str(tmp_path_factory.mktemp("project")))
    source = raw_tables(spark, SF)
    for quarter in ("Q1", "Q2"):
        rows_ = {t: tables.of_quarter(source[t], "2024", quarter) for t in TABLES}
        layers.write_raw(rows_, layout, "2024", quarter)
        assert all(layers.ingest(spark, layout, "2024", quarter).values())
    return layout


def expected_merge(spark):
    source = raw_tables(spark, SF)
    q1, q2 = (
        silver.clean_all({t: tables.of_quarter(source[t], "2024", q) for t in TABLES}, AS_OF) for q in ("Q1", "Q2")
    )
    demo = merge.merge_demo(q1["demo"], q2["demo"])
    return demo, {t: merge.refresh_child(q1[t], q2[t], demo) for t in CHILDREN}


def test_two_quarters(spark, project):
    written = layers.load_silver(spark, project, "2024", "Q1", AS_OF)
    assert written == {t: 1 for t in TABLES}
    stats = layers.upsert_quarter(spark, project, "2024", "Q2", AS_OF)
    demo, children = expected_merge(spark)
    stored = layers.read_silver(spark, project)
    assert rows(stored["demo"], *demo.columns) == rows(demo)
    for t in CHILDREN:
        # Blank text comes back from the files as NULL.
        kept = children[t].select(*(F.nullif(c, F.lit("")).alias(c) if k == "string" else c for c, k in children[t].dtypes))
        assert rows(stored[t], *kept.columns) == rows(kept)
    assert stats["demo"]["source_rows"] == sum(stats["demo"][k] for k in ("inserted", "updated", "unchanged"))
    assert stats["drug"]["after"] == stored["drug"].count()
    assert quality.post_checks(stored).filter("result <> 'PASS'").isEmpty()

    again = layers.upsert_quarter(spark, project, "2024", "Q2", AS_OF)
    assert (again["demo"]["inserted"], again["demo"]["updated"]) == (0, 0)
    assert rows(layers.read_silver(spark, project)["demo"]) == rows(stored["demo"])
    assert again["drug"]["after"] == stats["drug"]["after"]

    for t in CHILDREN:
        planted = stored[t].limit(3).withColumn("primaryid", F.lit("no such report"))
        tables.write_version(stored[t].unionByName(planted), project.silver(t))
    removed = layers.drop_orphans(spark, project)
    assert {t: s["removed"] for t, s in removed.items()} == {t: 3 for t in CHILDREN}
    stored = layers.read_silver(spark, project)

    layers.build_gold(spark, project, "run 1")
    gold = tables.read_version(spark, project.gold("drug_event_contingency"))
    direct = signals.gold_columns(signals.disproportionality(stored["drug"], stored["reac"]))
    assert rows(gold.drop("_computed_ts", "_run_label")) == rows(direct)
    flagged = tables.read_version(spark, project.gold("safety_signals"))
    assert rows(flagged, "drugname", "pt") == rows(gold.filter("is_signal"), "drugname", "pt")

    for label in ("run 1", "run 2"):
        assert layers.log_quality(spark, project, label).count() == 30
    assert tables.run_labels(spark, project.gold("data_quality_log")).count() == 2


def test_first_merge_into_nothing(spark, project, tmp_path):
    empty = layers.Layout(str(tmp_path))
    batch = silver.clean_all(layers.read_quarter(spark, project, "2024", "Q1"), AS_OF)
    stats = layers.merge_demo_table(spark, empty, batch["demo"])
    assert stats["inserted"] == stats["source_rows"] == tables.read_version(spark, empty.silver("demo")).count()
    child = layers.merge_child_table(spark, empty, "reac", batch["reac"])
    assert child["before"] == 0 and child["written"] == child["after"] > 0


def test_merge_of_an_empty_batch(spark, project):
    before = layers.read_silver(spark, project)["reac"]
    stats = layers.merge_child_table(spark, project, "reac", before.limit(0))
    assert stats == {"before": before.count(), "written": 0, "after": before.count()}
    assert layers.merge_demo_table(spark, project, layers.read_silver(spark, project)["demo"].limit(0))["inserted"] == 0


def test_tables_that_were_never_ingested_are_empty(spark, tmp_path):
    layout = layers.Layout(str(tmp_path))
    source = raw_tables(spark, SF)
    layers.write_raw({t: source[t] for t in ("demo", "reac")}, layout, "2024", "Q1")
    layers.ingest(spark, layout, "2024", "Q1")
    assert layers.load_silver(spark, layout, "2024", "Q1", AS_OF) == {t: 1 for t in TABLES}
    layers.build_gold(spark, layout, "r")
    assert layers.log_quality(spark, layout, "r").count() == 30
    assert tables.read_version(spark, layout.gold("drug_event_contingency")).count() == 0
    assert set(layers.upsert_quarter(spark, layout, "2024", "Q1", AS_OF)) == set(TABLES)


class _Unset:
    """A session without a shared folder."""

    class conf:
        @staticmethod
        def get(key, default):
            return default

    class sparkContext:
        @staticmethod
        def getCheckpointDir():
            return None


def test_an_unset_shared_folder_is_refused():
    with pytest.raises(ValueError):
        layers.scratch_folder(_Unset)


def test_scratch_and_checkpoints_follow_the_cluster_setting(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert layers.scratch_folder(spark).startswith(f"{shared}/")
    layers.shared_checkpoints(spark, str(tmp_path))
    assert shared in spark.sparkContext.getCheckpointDir()


def test_a_child_batch_is_made_once_in_an_upsert(spark, tmp_path):
    """Which stored reports go is read from the batch's rows as stored, not from the joins that made them."""
    layout = layers.Layout(str(tmp_path), 4)
    stored = spark.range(40).selectExpr("cast(id as string) primaryid", "'old' pt")
    buckets.write(stored, layout.silver("reac"), "primaryid", layout.buckets)
    made = spark.sparkContext.accumulator(0)

    def key(k):
        made.add(1)
        return str(k)

    named = F.udf(key, "string").asNondeterministic()
    batch = spark.range(20, 50).select(named("id").alias("primaryid"), F.lit("new").alias("pt"))
    changed = spark.range(15, 60).selectExpr("cast(id as string) primaryid", "id < 40 was_stored", "id between 20 and 44 present")
    counts = layers.merge_child_table(spark, layout, "reac", batch, changed)
    assert counts == {"before": 40, "written": 25, "after": 40}
    kept = [(str(k), "old") for k in range(15)] + [(str(k), "new") for k in range(20, 45)]
    assert rows(tables.read_version(spark, layout.silver("reac"))) == sorted(kept, key=repr)
    assert made.value == 30


def test_other_tables_stay_when_some_are_ingested(spark, tmp_path):
    layout = layers.Layout(str(tmp_path))
    one = {t: spark.createDataFrame([("1", t)], f"primaryid string, {TEXTS[t]} string") for t in TEXTS}
    layers.write_raw(one, layout, "2024", "Q1", all_columns=True)
    assert layers.ingest(spark, layout, "2024", "Q1", ["reac"]) == {"reac": 1}
    layers.remove_raw(spark, layout, "2024", "Q1", "reac")
    assert layers.ingest(spark, layout, "2024", "Q1", ["outc"]) == {"outc": 1}
    for t in TEXTS:
        assert rows(tables.read_bronze(spark, f"{layout.bronze}/{t}"), TEXTS[t]) == [(t,)]
    assert files.names(spark, layout.raw("2024", "Q1")) == ["OUTC24Q1.txt"]
    assert layers.ingest(spark, layout, "2024", "Q1")["reac"] == 0


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum("shuffle_" in found.apply(k).getName() for k in range(found.size()))


def test_shuffle_files_go_once_tables_are_written(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "RELEASE_EVERY", 0.0)
    df = spark.range(0, 1000, 1, 8).selectExpr("cast(id as string) primaryid", "'x' pt").repartition(4, "primaryid")
    before = shuffle_files(spark)
    for n in range(6):  # each leaves 8 tasks' files; the last one's plan may still be in use when it is released
        tables.write_version(df, str(tmp_path / "t"))
    until, most = time.monotonic() + 10, before + 3 * 8 * 2
    while shuffle_files(spark) > most and time.monotonic() < until:  # the cleaner works beside the driver
        time.sleep(0.1)
    assert shuffle_files(spark) <= most


def test_every_write_of_a_table_releases(spark, tmp_path, monkeypatch):
    asked, path = [], str(tmp_path)
    monkeypatch.setattr(files, "release_shuffles", lambda spark: asked.append(1))
    df = spark.createDataFrame([("1", "x")], "primaryid string, pt string")
    tables.write_version(df, f"{path}/a")
    buckets.write(df, f"{path}/b", "primaryid", 4)
    tables.append_log(df, f"{path}/c")
    raw.write_delimited(df, f"{path}/d")
    raw.write_bronze(df, f"{path}/e", "2024", "Q1")
    assert len(asked) == 5


def test_releases_are_not_asked_for_too_often(spark, monkeypatch):
    asked = []

    class Session:
        class _jvm:
            class System:
                gc = staticmethod(lambda: asked.append(1))

    monkeypatch.setattr(files, "_released", [float("-inf")])
    for _ in range(3):
        files.release_shuffles(Session)
    assert asked == [1]


def test_stored_runs_hold_little_text_and_few_wide_tables(spark, tmp_path, monkeypatch):
    """Text goes once ingested; of all tables a few at a time have text, or rows under way to Silver."""
    held, busy, most = [], set(), []
    ingest, write, merged = layers.ingest, buckets.write, layers.merge_child_table

    def watched_ingest(spark, layout, year, quarter, only=TABLES):
        text = [n for q in ("Q1", "Q2") for n in files.names(spark, layout.raw("2024", q))]
        held.append(len(text))
        return ingest(spark, layout, year, quarter, only)

    def counted(work):
        def run(*args, **kwargs):
            busy.add(key := object())
            most.append(len(busy))
            try:
                return work(*args, **kwargs)
            finally:
                busy.discard(key)

        return run

    monkeypatch.setattr(layers, "ingest", watched_ingest)
    layout = catalog.ingested(catalog.Reports(spark, SF))
    assert len(held) == 14 and max(held) <= catalog.TEXTS_AT_ONCE
    assert not any(files.names(spark, layout.raw("2024", q)) for q in ("Q1", "Q2"))
    monkeypatch.setattr(buckets, "write", counted(write))
    layers.load_silver(spark, layout, "2024", "Q1", AS_OF)
    monkeypatch.setattr(buckets, "write", write)
    monkeypatch.setattr(layers, "merge_child_table", counted(merged))
    layers.upsert_quarter(spark, layout, "2024", "Q2", AS_OF)
    assert len(most) == 13 and max(most) <= layers.WIDE_AT_ONCE
    files.delete(spark, layout.root)
