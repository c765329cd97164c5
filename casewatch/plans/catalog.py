"""The registered queries: every operator on the adapted report tables.

Score queries take all reports (many signals); Silver and upsert queries take
the latest version of each case, with Q1 as stored data and Q2 as the new batch.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, cached_property, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from casewatch.functions.statistics import Thresholds
from casewatch.lazy import LazyTables, side_by_side
from casewatch.operators import incremental, merge, profile, quality, signals, silver, sketches
from casewatch.operators.census import as_rows, census, total
from casewatch.plans import layers
from casewatch.plans.adapter import raw_tables
from casewatch.schema import CHILDREN, COLUMNS, FILE_LINEAGE, PRIMARY_SUSPECT
from casewatch.sources import compare, files, raw
from casewatch.sources.tables import of_quarter, read_bronze, read_version, versions, write_version

# Parameters of registered queries, shared with their oracles.
KNOWN = [
    ("LARGE WIDGET BRAND#14", "LARGE WIDGET PROMO"),
    ("HOT ANVIL BRAND#11", "HOT ANVIL STANDARD"),
    ("OLD GEAR BRAND#24", "OLD GEAR STANDARD"),
    ("NO SUCH DRUG", "NO SUCH EVENT"),
]
NAME_FRAGMENTS = ["widget", "anvil"]
STRICT = Thresholds(prr=3.0, chi2=6.63, reports=5)
YEAR, OLD_QUARTER, NEW_QUARTER = "2024", "Q1", "Q2"
RUN_LABEL = "all_quarters"
STORED_BUCKETS = 8  # of Silver tables in stored runs
TEXTS_AT_ONCE = 2  # tables whose text a stored run holds at a time


class Reports:
    """Lazy frames over one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.raw = raw_tables(spark, sf_dir)

    def child(self, table: str) -> DataFrame:
        """Silver rows of all reports, orphans of superseded versions included."""
        return silver.clean_child(table, self.raw[table])

    @cached_property
    def versions(self) -> DataFrame:
        return silver.typed_versions(self.raw["demo"])

    @cached_property
    def loaded(self) -> LazyTables:
        return silver.clean_all(self.raw)

    @cached_property
    def unfiltered(self) -> dict[str, DataFrame]:
        """All DEMO versions and all child rows, cleaned."""
        return {"demo": silver.finish_demo(self.versions)} | {t: self.child(t) for t in CHILDREN}

    def raw_quarter(self, quarter: str) -> LazyTables:
        return LazyTables(self.raw, lambda t: of_quarter(self.raw[t], YEAR, quarter))

    def quarter(self, quarter: str) -> LazyTables:
        """A quarter's cleaned tables; DEMO's versions are picked once and not in every branch of a merge."""
        bronze = self.raw_quarter(quarter)
        demo = cache(lambda: silver.clean_demo(bronze["demo"]).checkpoint())
        return LazyTables(
            COLUMNS, lambda t: demo() if t == "demo" else silver.keep_valid(silver.clean_child(t, bronze[t]), demo())
        )

    @cached_property
    def stored(self) -> LazyTables:
        return self.quarter(OLD_QUARTER)

    @cached_property
    def batch(self) -> LazyTables:
        return self.quarter(NEW_QUARTER)

    @cached_property
    def actions(self) -> DataFrame:
        return merge.demo_actions(self.stored["demo"], self.batch["demo"])

    @cached_property
    def merged_demo(self) -> DataFrame:
        return merge.apply_demo_actions(self.stored["demo"], self.actions)

    def merged_child(self, table: str) -> DataFrame:
        return merge.refresh_child(self.stored[table], self.batch[table], self.merged_demo)

    @cached_property
    def scored(self) -> DataFrame:
        return signals.disproportionality(self.child("drug"), self.child("reac"))

    @cached_property
    def pairs(self) -> DataFrame:
        return signals.drug_event_pairs(self.child("drug"), self.child("reac"))

    @cached_property
    def deaths(self) -> DataFrame:
        return signals.death_reports(self.child("drug"), self.child("reac"), self.child("outc"))

    @cached_property
    def dq(self) -> DataFrame:
        return quality.run_checks(self.loaded, RUN_LABEL).drop("timestamp")

    @cached_property
    def dq_dirty(self) -> DataFrame:
        return quality.run_checks(dirty(self), RUN_LABEL).drop("timestamp")

    @cached_property
    def dq_unfiltered(self) -> DataFrame:
        return quality.run_checks(self.unfiltered, RUN_LABEL).drop("timestamp")


def valid_children(r: Reports) -> DataFrame:
    """Rows per table and report after orphan removal."""
    counts = [
        r.loaded[t].groupBy("primaryid").agg(F.count("*").alias("rows")).withColumn("table_name", F.lit(t))
        for t in CHILDREN
    ]
    return reduce(DataFrame.unionByName, counts)


def merge_child_counts(r: Reports) -> DataFrame:
    """Rows stored, in the batch and after the refresh per child table.

    One census over report ids answers for all tables: of a report that DEMO keeps, the
    batch's rows are there if it has any, else the stored ones.
    """
    quarters = {"old": r.raw_quarter(OLD_QUARTER), "new": r.raw_quarter(NEW_QUARTER)}
    frames = {f"{q}_{t}": silver.clean_child(t, bronze[t]) for q, bronze in quarters.items() for t in CHILDREN}
    demos = {"stored": r.stored["demo"], "batch": r.batch["demo"], "merged": r.merged_demo}
    seen = census(frames | demos, "primaryid")
    counts = {}
    for t in CHILDREN:
        before = F.when(F.col("stored") > 0, F.col(f"old_{t}")).otherwise(0)
        batch = F.when(F.col("batch") > 0, F.col(f"new_{t}")).otherwise(0)
        after = F.when(F.col("merged") > 0, F.when(batch > 0, batch).otherwise(before))
        counts |= {f"before_{t}": total(before), f"batch_{t}": total(batch), f"after_{t}": total(after)}
    one = seen.agg(*(c.alias(n) for n, c in counts.items()))
    names = ["before", "batch", "after"]
    records = [(F.lit(t), *(F.col(f"{n}_{t}") for n in names)) for t in CHILDREN]
    return one.select(as_rows(["table_name", *names], records))


def case_version_summary(r: Reports) -> DataFrame:
    cases = r.versions.select("caseid").distinct().agg(F.count("*").alias("n"))
    several = profile.case_versions(r.versions).agg(F.count("*").alias("multi_version_cases"))
    return several.withColumn("cases", cases.scalar())


def sample_export(r: Reports) -> DataFrame:
    sample = profile.sample_reports({t: r.raw[t] for t in ("demo", "drug", "reac")})
    counts = [
        df.groupBy("primaryid").agg(F.count("*").alias("rows")).withColumn("table_name", F.lit(t))
        for t, df in sample.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _kept(r: Reports, layout: layers.Layout, result: DataFrame) -> DataFrame:
    """The result in the checkpoint folder; the project that it was read from is removed."""
    kept = result.checkpoint()
    files.delete(r.spark, layout.root)
    return kept


def bronze_ingest(r: Reports) -> DataFrame:
    """Both quarters as text files, ingested, then profiled as stored."""
    layout = ingested(r)
    stored = {t: read_bronze(r.spark, f"{layout.bronze}/{t}") for t in r.raw}
    return _kept(r, layout, profile.layer_profile(stored))


def bronze_rows(table: str) -> Callable[[Reports], DataFrame]:
    """All rows of a table after the way through text files and Bronze."""

    def query(r: Reports) -> DataFrame:
        layout = ingested(r, [table])
        stored = read_bronze(r.spark, f"{layout.bronze}/{table}").drop(*FILE_LINEAGE)
        return _kept(r, layout, stored)

    return query


def partition_scan(r: Reports) -> DataFrame:
    """One quarter of a stored Bronze table, of which only that partition is read."""
    layout = ingested(r, ["drug"])
    quarter = of_quarter(read_bronze(r.spark, f"{layout.bronze}/drug"), YEAR, NEW_QUARTER)
    return _kept(r, layout, quarter.drop(*FILE_LINEAGE))


def loaded_and_merged(r: Reports) -> layers.Layout:
    layout = ingested(r)
    layers.load_silver(r.spark, layout, YEAR, OLD_QUARTER)
    layers.upsert_quarter(r.spark, layout, YEAR, NEW_QUARTER)
    return layout


def layer_run(r: Reports) -> DataFrame:
    """Text files to Gold through all stored layers, Q2 merged into Q1."""
    layout = loaded_and_merged(r)
    layers.build_gold(r.spark, layout, RUN_LABEL)
    gold = read_version(r.spark, layout.gold("drug_event_contingency")).drop("_computed_ts")
    return _kept(r, layout, gold)


def quality_log(r: Reports) -> DataFrame:
    """Two logged quality runs, before and after the merge, read back from the log."""
    layout = ingested(r)
    layers.load_silver(r.spark, layout, YEAR, OLD_QUARTER)
    layers.log_quality(r.spark, layout, OLD_QUARTER)
    layers.upsert_quarter(r.spark, layout, YEAR, NEW_QUARTER)
    layers.log_quality(r.spark, layout, RUN_LABEL)
    log = r.spark.read.parquet(layout.gold("data_quality_log")).drop("timestamp")
    return _kept(r, layout, log)


def stored_snapshot_diff(r: Reports) -> DataFrame:
    """The first and the last stored version of DEMO compared."""
    layout = loaded_and_merged(r)
    first, *_, last = versions(r.spark, layout.silver("demo"))
    before, after = (read_version(r.spark, layout.silver("demo"), v) for v in (first, last))
    return _kept(r, layout, merge.snapshot_diff(before, after))


def stored_row_changes(r: Reports) -> DataFrame:
    """The cases of DEMO that were added, lost or changed between its first and its last version."""
    layout = loaded_and_merged(r)
    path = layout.silver("demo")
    first, *_, last = versions(r.spark, path)
    return _kept(r, layout, compare.changed_rows(r.spark, path, "caseid", first, last))


def stored_silver(table: str) -> Callable[[Reports], DataFrame]:
    """A Silver table as stored after the merge of the second quarter."""

    def query(r: Reports) -> DataFrame:
        layout = loaded_and_merged(r)
        return _kept(r, layout, read_version(r.spark, layout.silver(table)))

    return query


def contingency_carried_on(r: Reports) -> DataFrame:
    """Scores after the second quarter, from the first one's counts and the reports touched since."""
    layout = ingested(r)
    layers.load_silver(r.spark, layout, YEAR, OLD_QUARTER)
    layers.store_counts(r.spark, layout)
    _, reports = layers.upsert_reports(r.spark, layout, YEAR, NEW_QUARTER)
    layers.update_counts(r.spark, layout, reports)
    counts = layers.read_counts(r.spark, layout)
    return _kept(r, layout, signals.gold_columns(incremental.scored(counts)))


def with_line_breaks(drug: DataFrame) -> DataFrame:
    """DRUG with several lines of ingredients in the rows of every third report."""
    lines = F.concat_ws("\n", "prod_ai", F.concat(F.lit(" $"), F.trim("route")), F.lit(""))
    some = F.when(F.col("primaryid").cast("bigint") % 3 == 0, lines).otherwise(F.col("prod_ai"))
    return drug.withColumn("prod_ai", some)


def bronze_line_breaks(r: Reports) -> DataFrame:
    """DRUG with line breaks in its ingredients, after the way through text files and Bronze."""
    layout = layers.Layout(layers.scratch_folder(r.spark), STORED_BUCKETS)
    quarters = (OLD_QUARTER, NEW_QUARTER)
    drug = {quarter: {"drug": with_line_breaks(r.raw_quarter(quarter)["drug"])} for quarter in quarters}
    side_by_side(quarters, lambda quarter: layers.write_raw(drug[quarter], layout, YEAR, quarter))
    for quarter in quarters:
        layers.ingest(r.spark, layout, YEAR, quarter)
    stored = read_bronze(r.spark, f"{layout.bronze}/drug")
    named = F.col("_source_file").isNotNull() & F.col("_ingestion_ts").isNotNull()
    return _kept(r, layout, stored.withColumn("has_lineage", named).drop(*FILE_LINEAGE))


def bronze_second_ingest(r: Reports) -> DataFrame:
    """DRUG after both quarters were ingested again, one of them from other text; and which were written again."""
    layout = ingested(r, ["drug"], keep_text=True)
    quarters = (OLD_QUARTER, NEW_QUARTER)
    folders = {q: raw.quarter_folder(f"{layout.bronze}/drug", YEAR, q) for q in quarters}
    before = {q: files.names(r.spark, folder) for q, folder in folders.items()}
    fewer = r.raw_quarter(OLD_QUARTER)["drug"].filter(F.col("primaryid").cast("bigint") % 3 != 0)
    layers.write_raw({"drug": fewer}, layout, YEAR, OLD_QUARTER)
    for quarter in quarters:
        layers.ingest(r.spark, layout, YEAR, quarter)
    again = [q for q, folder in folders.items() if files.names(r.spark, folder) != before[q]]
    stored = read_bronze(r.spark, f"{layout.bronze}/drug").drop(*FILE_LINEAGE)
    return _kept(r, layout, stored.withColumn("rewritten", F.col("_quarter").isin(again)))


def indexed_name_search(r: Reports) -> DataFrame:
    """`name_search` by a stored index of the names."""
    layout = layers.Layout(layers.scratch_folder(r.spark), STORED_BUCKETS)
    layers.store_names(r.spark, layout, r.child("drug"))
    return _kept(r, layout, layers.search_names(r.spark, layout, NAME_FRAGMENTS))


def merged_sketches(r: Reports) -> DataFrame:
    """Profiles merged from stored sketches of each quarter: exact counts, and whether the estimates are within their errors."""
    layout = layers.Layout(layers.scratch_folder(r.spark), STORED_BUCKETS)
    frames = {"demo": r.raw["demo"].withColumn("age", F.expr("try_cast(age as double)")), "drug": r.raw["drug"], "reac": r.raw["reac"]}
    profiled = {"demo": ["caseid", "age"], "drug": ["drugname"], "reac": ["pt"]}
    for t, columns in profiled.items():
        found = sketches.quarter_sketches(t.upper(), frames[t], columns, {"age"}.intersection(columns))
        found.write.mode("append").parquet(layout.gold("sketches"))
    merged = sketches.merged_profile(r.spark.read.parquet(layout.gold("sketches"))).checkpoint()
    exact = [
        frames[t].agg(F.lit(t.upper()).alias("table_name"), F.lit(c).alias("column_name"), F.count_distinct(c).alias("exact"))
        for t, columns in profiled.items()
        for c in columns
    ]
    median = merged.filter("median is not null").select("median").scalar()
    in_rank = sketches.rank_is_within(frames["demo"], "age", median, sketches.QUANTILES["median"]).scalar()
    compared = merged.join(reduce(DataFrame.unionAll, exact), ["table_name", "column_name"])
    off = F.abs(F.col("distinct_estimate") - F.col("exact"))
    return _kept(r, layout, compared.select(
        "table_name", "column_name", "rows", "null_count", F.col("exact").alias("distinct_values"),
        (off <= F.col("distinct_error")).alias("distinct_within"),
        F.when(F.col("median").isNotNull(), in_rank).alias("median_within"),
    ))


def drop_orphans_counts(r: Reports) -> DataFrame:
    """Orphan removal on stored tables into which all orphans of the quarter were put."""
    layout = ingested(r, quarters=[OLD_QUARTER])
    layers.load_silver(r.spark, layout, YEAR, OLD_QUARTER)
    bronze = layers.read_quarter(r.spark, layout, YEAR, OLD_QUARTER)
    side_by_side(CHILDREN, lambda t: write_version(silver.clean_child(t, bronze[t]), layout.silver(t)))
    stats = layers.drop_orphans(r.spark, layout)
    rows = [(t, s["before"], s["after"], s["removed"]) for t, s in stats.items()]
    files.delete(r.spark, layout.root)
    return r.spark.createDataFrame(rows, "table_name string, before bigint, after bigint, removed bigint")


def changed_columns(r: Reports) -> DataFrame:
    """Two quarters of which the second has one more column and lacks another, upserted."""
    layout = layers.Layout(layers.scratch_folder(r.spark), STORED_BUCKETS)
    old, new = (r.raw_quarter(q) for q in (OLD_QUARTER, NEW_QUARTER))
    changed = {t: new[t] for t in CHILDREN}
    changed["demo"] = new["demo"].withColumn("auth_num", F.concat(F.lit("A"), "primaryid")).drop("occr_country")
    changed["reac"] = new["reac"].withColumn("drug_rec_act", F.lit("X"))
    for quarter, bronze in ((OLD_QUARTER, old), (NEW_QUARTER, changed)):
        layers.write_raw({t: bronze[t] for t in ("demo", "reac")}, layout, YEAR, quarter, all_columns=True)
        layers.ingest(r.spark, layout, YEAR, quarter)
    layers.load_silver(r.spark, layout, YEAR, OLD_QUARTER)
    layers.upsert_quarter(r.spark, layout, YEAR, NEW_QUARTER)
    stored = layers.read_silver(r.spark, layout)
    demo = stored["demo"].select(
        F.lit("demo").alias("table_name"), "primaryid", "occr_country", F.col("auth_num").alias("added")
    )
    reac = stored["reac"].select(
        F.lit("reac"), "primaryid", F.lit(None).cast("string"), F.col("drug_rec_act")
    )
    return _kept(r, layout, demo.unionAll(reac))


def sample_export_text(r: Reports) -> DataFrame:
    """The sampled REAC rows written as delimited text and read back."""
    layout = layers.Layout(layers.scratch_folder(r.spark), STORED_BUCKETS)
    sample = profile.sample_reports({"demo": r.raw["demo"], "reac": r.raw["reac"]})
    raw.write_delimited(sample["reac"].select(COLUMNS["reac"]), f"{layout.root}/REAC.txt")
    return _kept(r, layout, raw.read_file(r.spark, f"{layout.root}/REAC.txt", multi_line=False))


def ingested(
    r: Reports,
    only: list[str] | None = None,
    quarters: tuple[str, ...] | list[str] = (OLD_QUARTER, NEW_QUARTER),
    keep_text: bool = False,
) -> layers.Layout:
    """A new project with quarters written as text and ingested; all tables unless named.

    Text takes several times the disk of the tables that it is made from. So a table's text
    of a quarter goes once it is ingested, before the next quarter's is written, unless
    keep_text; and only a few tables have text at once.
    """
    layout = layers.Layout(layers.scratch_folder(r.spark), STORED_BUCKETS)
    bronze = {quarter: r.raw_quarter(quarter) for quarter in quarters}

    def bring_in(table: str) -> None:
        for quarter in quarters:
            layers.write_raw({table: bronze[quarter][table]}, layout, YEAR, quarter)
            layers.ingest(r.spark, layout, YEAR, quarter, [table])
            if not keep_text:
                layers.remove_raw(r.spark, layout, YEAR, quarter, table)

    side_by_side(only or r.raw, bring_in, TEXTS_AT_ONCE)
    return layout


def pair_samples(r: Reports) -> DataFrame:
    """The first pairs in order. They belong to the lowest ids that have a drug and a
    reaction, so that only those reports' rows are joined."""
    drugs, events = signals.suspect_drugs(r.child("drug")), signals.reactions(r.child("reac"))
    both = drugs.select("primaryid").join(events.select("primaryid"), "primaryid", "left_semi").distinct()
    ids = both.orderBy("primaryid").limit(15)
    few = [df.join(ids, "primaryid", "left_semi") for df in (drugs, events)]
    return profile.sample_rows(few[0].join(few[1], "primaryid"), ["primaryid", "drugname", "pt"], 15)


def dirty(r: Reports) -> dict[str, DataFrame]:
    """DEMO's latest versions and all children before cleaning: every check finds something."""
    demo = silver.latest_version(r.versions)
    broken = F.col("primaryid").cast("bigint") % 100 == 0
    demo = demo.withColumns(
        {
            "age_in_years": F.col("age").try_cast("double"),
            "caseversion": F.when(~broken, F.col("caseversion")),
            "primaryid": F.when(broken, "").otherwise(F.col("primaryid")),
            "caseid": F.when(~broken, F.col("caseid")),
        }
    )
    children = {t: r.raw[t] for t in CHILDREN}
    children["drug"] = children["drug"].withColumns(
        {"drugname": F.when(F.col("dose_amt") != "1", F.col("drugname")), "primaryid": F.nullif("primaryid", F.lit("1"))}
    )
    children["reac"] = children["reac"].withColumn("primaryid", F.nullif("primaryid", F.lit("1")))
    return {"demo": demo} | children


def suspect_samples(r: Reports) -> DataFrame:
    return profile.sample_rows(
        r.child("drug"),
        ["primaryid", "drugname", "prod_ai", "route", "dose_amt", "dose_unit"],
        10,
        F.col("role_cod") == PRIMARY_SUSPECT,
    )


QUERIES: dict[str, Callable[[Reports], DataFrame]] = {
    # Stored layers
    "bronze_ingest": bronze_ingest,
    "layer_run": layer_run,
    **{f"bronze_rows_{t}": bronze_rows(t) for t in COLUMNS},
    "changed_columns": changed_columns,
    "quality_log": quality_log,
    "stored_snapshot_diff": stored_snapshot_diff,
    "stored_row_changes": stored_row_changes,
    **{f"stored_{t}": stored_silver(t) for t in ("demo", "drug")},
    "contingency_carried_on": contingency_carried_on,
    "bronze_line_breaks": bronze_line_breaks,
    "bronze_second_ingest": bronze_second_ingest,
    "merged_sketches": merged_sketches,
    "indexed_name_search": indexed_name_search,
    "drop_orphans_counts": drop_orphans_counts,
    "sample_export_text": sample_export_text,
    # Silver
    "silver_demo": lambda r: r.loaded["demo"],
    "silver_demo_few_columns": lambda r: silver.clean_demo(r.raw["demo"].drop("occr_country", "mfr_sndr", "occp_cod")),
    "silver_drug": lambda r: r.child("drug"),
    "silver_reac": lambda r: r.child("reac"),
    "silver_outc": lambda r: r.child("outc"),
    "silver_rpsr": lambda r: r.child("rpsr"),
    "silver_ther": lambda r: r.child("ther"),
    "silver_indi": lambda r: r.child("indi"),
    "valid_children": valid_children,
    "partition_scan": partition_scan,
    # Upserts
    "merge_demo": lambda r: r.merged_demo,
    "merge_demo_stats": lambda r: merge.demo_merge_stats(r.actions),
    "merge_child": lambda r: r.merged_child("drug"),
    **{f"merge_child_{t}": lambda r, t=t: r.merged_child(t) for t in CHILDREN if t != "drug"},
    "merge_child_with_orphans": lambda r: merge.merge_child(
        r.stored["drug"], r.batch["drug"], r.merged_demo
    ),
    "merge_child_counts": merge_child_counts,
    "case_overlap": lambda r: merge.case_overlap(r.stored["demo"], r.batch["demo"]),
    "snapshot_diff": lambda r: merge.snapshot_diff(r.stored["demo"], r.merged_demo),
    # Signals
    "drug_event_pairs": lambda r: r.pairs,
    "join_sizes": lambda r: signals.join_sizes(r.child("drug"), r.child("reac")),
    "pair_summary": lambda r: signals.pair_summary(r.child("drug"), r.child("reac")),
    "contingency": lambda r: signals.gold_columns(r.scored),
    "contingency_from_pairs": lambda r: signals.gold_columns(signals.score(signals.count_pairs(r.pairs))),
    "contingency_latest_cases": lambda r: signals.gold_columns(
        signals.disproportionality(r.loaded["drug"], r.loaded["reac"])
    ),
    "safety_signals": lambda r: signals.signals(signals.gold_columns(r.scored)),
    "strict_signals": lambda r: signals.signals(
        signals.gold_columns(signals.disproportionality(r.child("drug"), r.child("reac"), STRICT))
    ),
    "top_signals_by_ror": lambda r: signals.top_signals(r.scored),
    "top_signals_by_reports": lambda r: signals.most_reported_signals(signals.gold_columns(r.scored)),
    "signals_per_drug": lambda r: signals.signals_per_drug(r.scored),
    "signal_rate": lambda r: signals.signal_rate(r.scored),
    "death_reports": lambda r: r.deaths,
    "fatal_signals": lambda r: signals.fatal_signals(r.scored, r.deaths, None),
    "fatal_signals_top": lambda r: signals.fatal_signals(r.scored, r.deaths),
    "known_pairs": lambda r: signals.known_pairs(r.scored, KNOWN),
    # Quality
    "dq_checks": lambda r: r.dq,
    "dq_checks_unfiltered": lambda r: r.dq_unfiltered,
    "dq_checks_dirty": lambda r: r.dq_dirty,
    "dq_summary": lambda r: quality.verdict_counts(r.dq_dirty),
    "dq_failures": lambda r: quality.with_result(r.dq_dirty, quality.FAIL),
    "dq_warnings": lambda r: quality.with_result(r.dq_unfiltered, quality.WARN),
    "post_checks_dirty": lambda r: quality.post_checks(dirty(r)),
    "line_break_counts": lambda r: quality.broken_lines({"drug": with_line_breaks(r.raw["drug"]), "reac": r.raw["reac"]}),
    "post_checks": lambda r: quality.post_checks(r.loaded),
    "post_checks_unfiltered": lambda r: quality.post_checks(r.unfiltered),
    # Profiles
    "layer_profile": lambda r: profile.layer_profile(r.raw),
    "layer_profile_typed": lambda r: profile.layer_profile(r.unfiltered),
    "layer_deltas": lambda r: profile.layer_deltas(
        {"demo": r.versions} | {t: r.child(t) for t in CHILDREN}, r.loaded["demo"]
    ),
    "role_counts": lambda r: profile.category_counts(r.raw["drug"], "role_cod"),
    "sex_counts": lambda r: profile.category_counts(r.raw["demo"], "sex"),
    "outcome_counts": lambda r: profile.category_counts(r.raw["outc"], "outc_cod"),
    "country_top": lambda r: profile.category_counts(r.raw["demo"], "reporter_country", 10),
    "reaction_top": lambda r: profile.category_counts(r.raw["reac"], "pt", 20),
    "indication_top": lambda r: profile.category_counts(r.raw["indi"], "indi_pt", 10),
    "case_versions": lambda r: profile.case_versions(r.versions),
    "case_versions_top": lambda r: profile.most_versions(r.versions),
    "case_version_summary": case_version_summary,
    "null_rates": lambda r: profile.null_rates(r.loaded["demo"]),
    "null_rates_raw": lambda r: profile.null_rates(r.raw["demo"], profile.RAW_NULL_RATE_FIELDS),
    "distinct_values": lambda r: profile.distinct_values(
        [("DRUG", r.raw["drug"], "drugname"), ("REAC", r.raw["reac"], "pt")]
    ),
    "drug_name_search": lambda r: profile.name_search(r.child("drug"), NAME_FRAGMENTS),
    "date_samples": lambda r: profile.date_samples(r.loaded["demo"]),
    "age_samples": lambda r: profile.age_samples(r.loaded["demo"]),
    "demo_samples": lambda r: profile.sample_rows(r.raw["demo"], profile.DEMO_SAMPLE_COLUMNS, 10),
    "suspect_samples": suspect_samples,
    "pair_samples": pair_samples,
    "sample_export_rows": sample_export,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Callable[[Reports], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: query(Reports(spark, sf_dir))

    return {name: bind(query) for name, query in QUERIES.items()}
