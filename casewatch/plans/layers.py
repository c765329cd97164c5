"""Layer runs: Bronze to Silver, a new quarter into Silver, Silver to Gold.

`silver_dir` and `gold_dir` hold one versioned table directory per table.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from casewatch.functions.statistics import Thresholds
from casewatch.lazy import side_by_side
from casewatch.operators import incremental, merge, names, quality, signals
from casewatch.operators.silver import clean_child, clean_demo, keep_valid
from casewatch.schema import CHILDREN, COLUMNS, TABLES, data_columns
from casewatch.sources import buckets, files, raw, tables

WIDE_AT_ONCE = 2  # tables whose rows are shuffled at a time; DRUG takes as long as all others


@dataclass(frozen=True)
class Layout:
    """Where the layers of one project live, and in how many buckets Silver tables lie."""

    root: str
    buckets: int = buckets.BUCKETS

    def raw(self, year: str, quarter: str) -> str:
        return f"{self.root}/raw/{year}{quarter.lower()}"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    def silver(self, table: str) -> str:
        return f"{self.root}/silver/{table}"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"


def read_quarter(spark: SparkSession, layout: Layout, year: str, quarter: str) -> dict[str, DataFrame]:
    """Bronze rows of one quarter; a table that was never ingested has none."""
    return {
        t: tables.of_quarter(tables.read_bronze_or_empty(spark, f"{layout.bronze}/{t}", t), year, quarter)
        for t in TABLES
    }


def read_silver(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    return {
        t: tables.read_version(spark, layout.silver(t))
        for t in TABLES
        if tables.versions(spark, layout.silver(t))
    }


def load_silver(
    spark: SparkSession, layout: Layout, year: str, quarter: str, as_of: dt.date | None = None
) -> dict[str, int]:
    """First load of a quarter; returns the version written per table.

    DEMO is written before the children and read back, so its version pick runs
    once and not once per child table.
    """
    bronze = read_quarter(spark, layout, year, quarter)
    written = {"demo": buckets.write(clean_demo(bronze["demo"], as_of), layout.silver("demo"), "caseid", layout.buckets)}
    demo = tables.read_version(spark, layout.silver("demo"))

    def load(table: str) -> int:
        child = keep_valid(clean_child(table, bronze[table], as_of), demo)
        return buckets.write(child, layout.silver(table), "primaryid", layout.buckets)

    return written | side_by_side(CHILDREN, load, WIDE_AT_ONCE)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in the cluster's shared folder, which must be set."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return f"{shared}/casewatch-{uuid.uuid4()}"


def write_raw(
    bronze: Mapping[str, DataFrame], layout: Layout, year: str, quarter: str, all_columns: bool = False
) -> None:
    """Writes the tables of one quarter as delimited text, each a folder of part files.

    The known columns are written, or with all_columns what the frames hold but lineage.
    """

    def write(table: str) -> None:
        names = data_columns(bronze[table].columns) if all_columns else COLUMNS[table]
        name = f"{table.upper()}{year[-2:]}{quarter}.txt"
        raw.write_delimited(bronze[table].select(names), f"{layout.raw(year, quarter)}/{name}")

    side_by_side(bronze, write)


def ingest(
    spark: SparkSession, layout: Layout, year: str, quarter: str, only: Iterable[str] = TABLES
) -> dict[str, int]:
    return raw.ingest_quarter(spark, layout.raw(year, quarter), layout.bronze, year, quarter, only=only)


def remove_raw(spark: SparkSession, layout: Layout, year: str, quarter: str, table: str) -> None:
    """Removes a table's text of a quarter. Only while it is not ingested again does Bronze keep its rows."""
    for path in raw.table_files(spark, layout.raw(year, quarter), table):
        files.delete(spark, path)


def shared_checkpoints(spark: SparkSession, fallback: str) -> None:
    """Uses the cluster's checkpoint folder; `fallback` only where none is set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or fallback)


def merge_demo_table(
    spark: SparkSession, layout: Layout, batch: DataFrame, one_per_case: bool = False
) -> dict[str, int]:
    """Upserts a cleaned DEMO batch and returns the row counts of the merge."""
    return _merge_demo(spark, layout, batch, one_per_case)[0]


def _merge_demo(
    spark: SparkSession, layout: Layout, batch: DataFrame, one_per_case: bool
) -> tuple[dict[str, int], DataFrame | None]:
    """Counts of the merge, and the reports that it may have touched; None for a first load.

    Which case gets which action is checkpointed as two narrow columns: they feed the
    counts, the replaced ids and the written rows, and survive the loss of an executor.
    Of a table in buckets, those of the batch's cases are read and those of changed cases
    written; if there are none, no version is.
    """
    path = layout.silver("demo")
    if not tables.versions(spark, path):
        buckets.write(batch if one_per_case else merge.latest_version(batch), path, "caseid", layout.buckets)
        rows = buckets.manifest(spark, path).rows
        return {"source_rows": rows, "inserted": rows, "matched": 0, "updated": 0, "unchanged": 0}, None
    shared_checkpoints(spark, f"{layout.root}/checkpoints")
    source = batch if one_per_case else merge.latest_version(batch)
    known, target = buckets.manifest(spark, path), tables.read_version(spark, path)
    if known:
        target = buckets.read(spark, path, known, buckets.buckets_with(source, known.key, known.buckets))
    actions = merge.demo_actions(target, source, one_per_case=True)
    decided = actions.select("caseid", "_action").checkpoint()
    stats = merge.demo_merge_stats(decided).first().asDict()
    updated = decided.filter(F.col("_action") == merge.UPDATED).select("caseid")
    replaced = target.select("primaryid", "caseid").join(updated, "caseid", "left_semi").checkpoint()
    if stats["inserted"] or stats["updated"]:
        only = None
        if known:
            only = buckets.buckets_with(decided.filter(F.col("_action") != merge.UNCHANGED), known.key, known.buckets)
            target = buckets.read(spark, path, known, only)
        acted = source.join(decided, source["caseid"].eqNullSafe(decided["caseid"]))
        acted = acted.select(*(source[c] for c in source.columns), "_action")
        buckets.write(merge.apply_demo_actions(target, acted), path, "caseid", layout.buckets, only)
    merged = tables.read_version(spark, path)
    return stats, merge.changed_reports(source, replaced, merged).checkpoint()


def merge_child_table(
    spark: SparkSession, layout: Layout, table: str, batch: DataFrame, changed: DataFrame | None = None
) -> dict[str, int]:
    """Replaces the batch's reports in a child table and drops orphaned rows.

    With the reports that a DEMO merge touched, and a table in buckets, only the buckets of
    replaced and lost reports are read and written; rows that were orphans before stay for
    `drop_orphans`. Otherwise the table is rewritten.
    """
    path = layout.silver(table)
    known = buckets.manifest(spark, path) if tables.versions(spark, path) else None
    if changed is not None and known:
        shared_checkpoints(spark, f"{layout.root}/checkpoints")
        valid = merge.replacing_rows(batch, changed).checkpoint()
        files.release_shuffles(spark)
        ids = merge.replaced_reports(valid, changed).checkpoint()
        only = buckets.buckets_with(ids, known.key, known.buckets)
        if only:
            rows = merge.replace_reports(buckets.read(spark, path, known, only), valid, ids)
            buckets.write(rows, path, "primaryid", only=only)
        return {"before": known.rows, "written": valid.count(), "after": buckets.manifest(spark, path).rows}
    demo = tables.read_version(spark, layout.silver("demo"))
    stored = tables.read_version(spark, path) if tables.versions(spark, path) else None
    written = Observation()
    buckets.write(merge.refresh_child(stored, batch, demo, written), path, "primaryid", layout.buckets)
    return {
        "before": stored.count() if stored is not None else 0,
        "written": written.get["rows"],
        "after": buckets.manifest(spark, path).rows,
    }


def upsert_quarter(
    spark: SparkSession, layout: Layout, year: str, quarter: str, as_of: dt.date | None = None
) -> dict[str, dict[str, int]]:
    """Cleans one quarter of Bronze and merges all its tables into Silver."""
    return upsert_reports(spark, layout, year, quarter, as_of)[0]


def upsert_reports(
    spark: SparkSession, layout: Layout, year: str, quarter: str, as_of: dt.date | None = None
) -> tuple[dict[str, dict[str, int]], DataFrame | None]:
    """`upsert_quarter`, and the ids of the reports that it may have touched (None for a first load).

    The cleaned DEMO batch is checkpointed, as it also filters every child table.
    """
    bronze = read_quarter(spark, layout, year, quarter)
    shared_checkpoints(spark, f"{layout.root}/checkpoints")
    demo = clean_demo(bronze["demo"], as_of).checkpoint()
    files.release_shuffles(spark)
    merged, changed = _merge_demo(spark, layout, demo, one_per_case=True)
    batches = {t: keep_valid(clean_child(t, bronze[t], as_of), demo) for t in CHILDREN}
    children = side_by_side(
        CHILDREN, lambda t: merge_child_table(spark, layout, t, batches[t], changed), WIDE_AT_ONCE
    )
    return {"demo": merged} | children, changed


def drop_orphans(spark: SparkSession, layout: Layout) -> dict[str, dict[str, int]]:
    """Rewrites each stored child table without rows that lost their report."""
    demo = tables.read_version(spark, layout.silver("demo"))

    def drop(table: str) -> dict[str, int]:
        path = layout.silver(table)
        stored = tables.read_version(spark, path)
        buckets.write(keep_valid(stored, demo), path, "primaryid", layout.buckets)
        before, after = stored.count(), buckets.manifest(spark, path).rows
        return {"before": before, "after": after, "removed": before - after}

    return side_by_side((t for t in CHILDREN if tables.versions(spark, layout.silver(t))), drop)


def build_gold(
    spark: SparkSession, layout: Layout, run_label: str, limits: Thresholds = Thresholds()
) -> None:
    """Writes the scored pairs and, read back from them, the signals."""
    silver = read_silver(spark, layout)
    scored = signals.disproportionality(silver["drug"], silver["reac"], limits)
    stored = signals.run_stamp(signals.gold_columns(scored), run_label)
    tables.write_version(stored, layout.gold("drug_event_contingency"))
    contingency = tables.read_version(spark, layout.gold("drug_event_contingency"))
    tables.write_version(signals.signals(contingency), layout.gold("safety_signals"))


def store_counts(spark: SparkSession, layout: Layout) -> None:
    """Counts all reports of Silver and stores the counts, with the versions that they are of."""
    silver = read_silver(spark, layout)
    _write_counts(spark, layout, incremental.report_counts(silver["drug"], silver["reac"]))


def _write_counts(spark: SparkSession, layout: Layout, counts: DataFrame) -> None:
    of = {f"{t}_version": F.lit(tables.versions(spark, layout.silver(t))[-1]) for t in ("drug", "reac")}
    tables.write_version(counts.withColumns(of), layout.gold("report_counts"))


def update_counts(spark: SparkSession, layout: Layout, reports: DataFrame) -> None:
    """Carries the stored counts on to Silver's latest versions.

    `reports` are the ids touched since the counts were stored, more do no harm. Of DRUG and
    REAC, only their buckets are read, as they were then and as they are now.
    """
    stored = tables.read_version(spark, layout.gold("report_counts"))
    then = stored.select("drug_version", "reac_version").first()

    def rows(table: str, version: int | None) -> DataFrame:
        path = layout.silver(table)
        known = buckets.manifest(spark, path, version)
        if not known:
            return incremental.of_reports(tables.read_version(spark, path, version), reports)
        only = buckets.buckets_with(reports, known.key, known.buckets)
        return incremental.of_reports(buckets.read(spark, path, known, only), reports)

    now = incremental.report_counts(rows("drug", None), rows("reac", None))
    if then:  # without counts there were no reports
        before = incremental.report_counts(rows("drug", then["drug_version"]), rows("reac", then["reac_version"]))
        counts = stored.drop("drug_version", "reac_version")
        now = incremental.carried_on(counts, before, now)
    _write_counts(spark, layout, now)


def read_counts(spark: SparkSession, layout: Layout) -> DataFrame:
    return tables.read_version(spark, layout.gold("report_counts")).drop("drug_version", "reac_version")


def store_names(spark: SparkSession, layout: Layout, drug: DataFrame | None = None) -> None:
    """Indexes the names of DRUG, by default those of Silver's latest version, for `search_names`.

    Postings lie in buckets of the gram, spellings in buckets of the name.
    """
    drug = tables.read_version(spark, layout.silver("drug")) if drug is None else drug
    buckets.write(names.spellings(drug), layout.gold("drug_names"), "name_id", layout.buckets)
    spelled = tables.read_version(spark, layout.gold("drug_names"))
    buckets.write(names.postings(spelled), layout.gold("name_postings"), "gram", layout.buckets)


def search_names(spark: SparkSession, layout: Layout, fragments: list[str]) -> DataFrame:
    """The indexed spellings that contain any of the fragments, as `profile.name_search` on DRUG.

    Of the postings the buckets of the fragments' grams are read, of the spellings those of
    the candidates. A fragment of fewer than three characters has no grams; then all
    spellings are compared.
    """
    path = layout.gold("drug_names")
    if not names.is_indexed(fragments):
        return names.verified(tables.read_version(spark, path), None, fragments)
    shared_checkpoints(spark, f"{layout.root}/checkpoints")
    posted = buckets.manifest(spark, layout.gold("name_postings"))
    grams = sorted(set().union(*map(names.grams, fragments)))
    asked = spark.createDataFrame([(g,) for g in grams], "gram string")
    only = buckets.buckets_with(asked, posted.key, posted.buckets)
    found = names.candidates(buckets.read(spark, layout.gold("name_postings"), posted, only), fragments).checkpoint()
    known = buckets.manifest(spark, path)
    held = buckets.read(spark, path, known, buckets.buckets_with(found, known.key, known.buckets))
    return names.verified(held, found, fragments)


def log_quality(spark: SparkSession, layout: Layout, run_label: str) -> DataFrame:
    """Runs the checks on Silver, appends them to the log and returns this run's rows."""
    path = layout.gold("data_quality_log")
    tables.append_log(quality.run_checks(read_silver(spark, layout), run_label), path)
    return spark.read.parquet(path).filter(F.col("run_label") == run_label)
