"""Profiles: sizes, distributions, null rates, samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from casewatch.functions.cleaning import missing
from casewatch.operators.census import as_rows, census, total
from casewatch.operators.silver import keep_valid
from casewatch.schema import CHILDREN, PARTITIONS, data_columns, non_string_columns

# The fields of the null-rate report.
NULL_RATE_FIELDS = [
    "primaryid", "caseid", "event_dt", "age", "age_in_years", "sex",
    "reporter_country", "occr_country", "wt",
]
RAW_NULL_RATE_FIELDS = [
    "primaryid", "caseid", "event_dt", "age", "sex", "reporter_country", "occr_country",
]
DEMO_SAMPLE_COLUMNS = [
    "primaryid", "caseid", "caseversion", "event_dt", "age", "age_cod", "sex",
    "reporter_country", "occr_country",
]


def category_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Rows per value, largest first; NULL is a value. All values unless n is given."""
    counts = df.groupBy(column).agg(F.count("*").alias("count"))
    ordered = counts.orderBy(F.desc("count"), column)
    return ordered if n is None else ordered.limit(n)


def distinct_values(columns: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """Distinct values (NULL counts once) per (table, frame, column)."""
    counts = [
        df.select(column).distinct().agg(
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.count("*").alias("distinct_values"),
        )
        for table, df, column in columns
    ]
    return reduce(DataFrame.unionAll, counts)


def case_versions(demo: DataFrame) -> DataFrame:
    """Cases with several versions. The maximum compares text on Bronze input."""
    return (
        demo.groupBy("caseid")
        .agg(
            F.count_distinct("caseversion").alias("num_versions"),
            F.max("caseversion").alias("max_version"),
        )
        .filter("num_versions > 1")
    )


def most_versions(demo: DataFrame, n: int = 10) -> DataFrame:
    return case_versions(demo).orderBy(F.desc("num_versions"), "caseid").limit(n)


def null_rates(demo: DataFrame, fields: list[str] | None = None, digits: int = 1) -> DataFrame:
    """Missing values per field in one pass, highest rate first."""
    fields = [c for c in fields or NULL_RATE_FIELDS if c in demo.columns]
    counted = demo.agg(F.count("*").alias("_rows"), *(F.count_if(missing(c)).alias(c) for c in fields))
    rate = F.coalesce(F.bround(F.try_divide("n", "_rows") * 100, digits), F.lit(0.0))
    return (
        counted.unpivot("_rows", fields, "field", "n")
        .select("field", F.col("n").alias("null_count"), rate.alias("null_pct"))
        .orderBy(F.desc("null_pct"), "field")
    )


def layer_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table: rows, data columns, those not string, distinct quarters."""
    profiles = [
        df.agg(
            F.lit(name.upper()).alias("table_name"),
            F.count("*").alias("rows"),
            F.lit(len(data_columns(df.columns))).alias("data_columns"),
            F.lit(",".join(non_string_columns(df.schema))).alias("non_string"),
            F.count_distinct(*PARTITIONS).alias("partitions"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, profiles)


def layer_deltas(before: dict[str, DataFrame], demo: DataFrame) -> DataFrame:
    """Rows before and after per table, DEMO by case and children by valid report.

    `before` holds the keyed rows: all DEMO versions and children with orphans.
    One census over report ids answers for all child tables at once.
    """
    children = [c for c in CHILDREN if c in before]
    seen = census({c: before[c] for c in children} | {"valid": demo}, "primaryid")
    valid = F.col("valid") > 0
    child_rows = seen.agg(
        *(total(c).alias(f"{c}_before") for c in children),
        *(total(F.when(valid, F.col(c))).alias(f"{c}_after") for c in children),
    ).select(
        as_rows(
            ["table_name", "rows_before", "rows_after"],
            [(F.lit(c.upper()), F.col(f"{c}_before"), F.col(f"{c}_after")) for c in children],
        )
    )
    kept = demo.agg(F.count("*").alias("n"))
    demo_rows = before["demo"].agg(
        F.lit("DEMO").alias("table_name"),
        F.count("*").alias("rows_before"),
    ).withColumn("rows_after", kept.scalar())
    return demo_rows.unionByName(child_rows).withColumn(
        "dropped", F.col("rows_before") - F.col("rows_after")
    )


def name_search(drug: DataFrame, fragments: list[str]) -> DataFrame:
    """Distinct spellings of the drugs whose name contains any fragment."""
    name = F.upper("drugname")
    hit: Column = reduce(Column.__or__, (name.contains(f.upper()) for f in fragments))
    return drug.filter(hit).select("drugname", "prod_ai", "role_cod").distinct()


def sample_rows(df: DataFrame, columns: list[str], n: int, condition: Column | None = None) -> DataFrame:
    """The first n rows by the shown columns, so that a sample can be repeated."""
    rows = df if condition is None else df.filter(condition)
    return rows.select(*columns).orderBy(*columns).limit(n)


def date_samples(demo: DataFrame, n: int = 9) -> DataFrame:
    """One parsed date per raw text, shortest texts first."""
    parsed = demo.filter(F.col("event_dt").isNotNull()).groupBy("event_dt")
    return (
        parsed.agg(F.min("event_dt_parsed").alias("event_dt_parsed"))
        .orderBy(F.length("event_dt"), "event_dt")
        .limit(n)
    )


def age_samples(demo: DataFrame) -> DataFrame:
    """One conversion per age unit: the lowest age."""
    known = demo.filter(F.col("age").isNotNull() & F.col("age_cod").isNotNull())
    lowest = known.groupBy("age_cod").agg(F.min(F.struct("age", "age_in_years")).alias("s"))
    return lowest.select("s.age", "age_cod", "s.age_in_years").orderBy("age_cod")


def sample_reports(tables: dict[str, DataFrame], n: int = 200) -> dict[str, DataFrame]:
    """All rows of the first n reports of DEMO. AQE broadcasts the ids if they are few."""
    ids = tables["demo"].select("primaryid").distinct().orderBy("primaryid").limit(n)
    return {name: df.join(ids, "primaryid", "left_semi") for name, df in tables.items()}
