"""Layer tables on Parquet.

A table that is replaced is a directory of numbered versions, each a complete
Parquet data set. Readers take the highest version whose write finished, so a
table can be read while its successor is computed from it, and a write that was
lost half-way is never seen.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, types as T

from casewatch.schema import PARTITIONS, raw_schema
from casewatch.sources import buckets, files

_PREFIX, _COLUMNS = "version=", "_columns.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Finished versions, oldest first."""
    found = (int(n[len(_PREFIX) :]) for n in files.names(spark, path) if n.startswith(_PREFIX))
    return sorted(v for v in found if files.exists(spark, f"{path}/{_PREFIX}{v}/_SUCCESS"))


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version of a table, with or without buckets; the latest by default."""
    if version is None:
        version = versions(spark, path)[-1]
    known = buckets.manifest(spark, path, version)
    if known:
        return buckets.read(spark, path, known)
    return spark.read.parquet(f"{path}/{_PREFIX}{version}")


def next_version(spark: SparkSession, path: str) -> int:
    """One more than the highest number taken, by an unfinished write too."""
    taken = [int(n[len(_PREFIX) :]) for n in files.names(spark, path) if n.startswith(_PREFIX)]
    return max(taken, default=0) + 1


def write_version(df: DataFrame, path: str, keep_versions: int | None = None) -> int:
    """Writes df as the table's next version and returns its number.

    df may read the table's current version. Its schema replaces the old one. All
    versions are kept unless keep_versions says how many finished ones stay; frames
    that still read a removed version fail.
    """
    spark = df.sparkSession
    version = next_version(spark, path)
    df.write.mode("errorifexists").parquet(f"{path}/{_PREFIX}{version}")
    files.release_shuffles(spark)
    if keep_versions is not None:
        for old in versions(spark, path)[: -max(1, keep_versions)]:
            files.delete(spark, f"{path}/{_PREFIX}{old}")
    return version


def recorded_columns(spark: SparkSession, path: str) -> dict[str, dict[str, str]]:
    """Column names and types of each quarter of a Bronze table, as recorded at ingest."""
    name = f"{path}/{_COLUMNS}"
    return json.loads(files.read_text(spark, name)) if files.exists(spark, name) else {}


def record_columns(spark: SparkSession, path: str, year: str, quarter: str, rows: DataFrame) -> None:
    """Records the columns of a quarter that is about to be written, in place of its old ones.

    It is done before the rows are, so that a lost write leaves columns without values and
    not values without a column. A table ingested before there was a record keeps the
    columns of all its files. A column's type is the same in all quarters; another one is
    refused.
    """
    known = recorded_columns(spark, path)
    if not known and files.exists(spark, path) and any(n.startswith(PARTITIONS[0]) for n in files.names(spark, path)):
        known["before"] = {n: k for n, k in _merged(spark, path, True).dtypes if n not in PARTITIONS}
    mine = {n: k for n, k in rows.dtypes if n not in PARTITIONS}
    for other, columns in known.items():
        clash = [n for n, k in mine.items() if columns.get(n, k) != k]
        if clash and other != f"{year}/{quarter}":
            raise ValueError(f"columns {clash} have other types in {other}")
    known[f"{year}/{quarter}"] = mine
    files.write_text(spark, f"{path}/{_COLUMNS}", json.dumps(known), replace=True)


def read_bronze(spark: SparkSession, path: str, merge_schema: bool = True) -> DataFrame:
    """A partitioned Bronze table with its year and quarter as text.

    Quarters may differ in their columns: all are found, with NULL where a quarter lacks
    one. They are known from the record of the ingests; only a table without one has the
    footers of all its files read, in a distributed job. Without merge_schema the columns
    of one file are taken. Spark would infer a number for the year, so the schema is stated.
    """
    known = recorded_columns(spark, path) if merge_schema else {}
    if known:
        columns = {n: k for quarter in sorted(known) for n, k in known[quarter].items()}
        schema = ", ".join(f"`{n.replace('`', '``')}` {k}" for n, k in (columns | dict.fromkeys(PARTITIONS, "string")).items())
        return spark.read.schema(schema).parquet(path)
    return _merged(spark, path, merge_schema)


def _merged(spark: SparkSession, path: str, merge_schema: bool) -> DataFrame:
    found = spark.read.option("mergeSchema", merge_schema).parquet(path).schema
    texts = [
        T.StructField(f.name, T.StringType()) if f.name in PARTITIONS else f for f in found.fields
    ]
    return spark.read.schema(T.StructType(texts)).parquet(path)


def read_bronze_or_empty(spark: SparkSession, path: str, table: str) -> DataFrame:
    """`read_bronze`, or no rows of the table's layout where it was never ingested."""
    if files.exists(spark, path):
        return read_bronze(spark, path)
    return spark.createDataFrame([], raw_schema(table))


def of_quarter(bronze: DataFrame, year: str, quarter: str) -> DataFrame:
    """Rows of one quarter; on a Bronze table only its partition is read."""
    return bronze.filter((bronze["_year"] == year) & (bronze["_quarter"] == quarter))


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
    files.release_shuffles(df.sparkSession)


def run_labels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("run_label").distinct()
