"""Versions of a stored table that share what did not change.

Rows lie in hash buckets of a key, each a folder of Parquet files. A version writes the
buckets that it replaces and a manifest, which names for every bucket the version whose
files hold it. So an upsert costs the buckets that its keys fall into, not the history,
and earlier versions stay readable. A version exists once its `_SUCCESS` does, which is
written last.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from casewatch.sources import files, tables

BUCKETS = 64
_COLUMN, _MANIFEST = "_bucket", "_manifest.json"


@dataclass(frozen=True)
class Manifest:
    """key: the column that rows are hashed by. buckets: how many there are. rows: in all of
    them. held: the version that holds each bucket; buckets without rows are missing."""

    key: str
    buckets: int
    rows: int
    schema: T.StructType
    held: dict[int, int]

    def text(self) -> str:
        held = {str(b): v for b, v in sorted(self.held.items())}
        return json.dumps({"key": self.key, "buckets": self.buckets, "rows": self.rows, "schema": self.schema.jsonValue(), "held": held})


def bucket_of(key: str | Column, buckets: int) -> Column:
    """The bucket of a key; NULL is a key."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest | None:
    """The manifest of a version, the latest by default; None for a table without buckets."""
    if version is None:
        version = next(reversed(tables.versions(spark, path)), None)
    name = f"{path}/version={version}/{_MANIFEST}"
    if version is None or not files.exists(spark, name):
        return None
    found = json.loads(files.read_text(spark, name))
    held = {int(b): v for b, v in found["held"].items()}
    return Manifest(found["key"], found["buckets"], found["rows"], T.StructType.fromJson(found["schema"]), held)


def folders(path: str, known: Manifest, only: list[int] | None = None) -> list[str]:
    chosen = sorted(known.held) if only is None else [b for b in sorted(only) if b in known.held]
    return [f"{path}/version={known.held[b]}/data/{_COLUMN}={b}" for b in chosen]


def read(spark: SparkSession, path: str, known: Manifest, only: list[int] | None = None) -> DataFrame:
    """The rows of a version, or of some of its buckets; no footer is read for the schema."""
    found = folders(path, known, only)
    return spark.read.schema(known.schema).parquet(*found) if found else spark.createDataFrame([], known.schema)


def buckets_with(keys: DataFrame, key: str, buckets: int) -> list[int]:
    """The buckets that the keys of `keys` fall into: at most `buckets` numbers."""
    return sorted(r[0] for r in keys.select(bucket_of(key, buckets).alias(_COLUMN)).distinct().collect())


def _joint_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    known = {f.name: f for f in old.fields}
    for f in new.fields:
        if f.name in known and f.dataType != known[f.name].dataType:
            raise ValueError(f"column {f.name} is {known[f.name].dataType.simpleString()} in the table, not {f.dataType.simpleString()}")
    fields = [*old.fields, *(f for f in new.fields if f.name not in known)]
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields])


def write(df: DataFrame, path: str, key: str, buckets: int = BUCKETS, only: list[int] | None = None) -> int:
    """Writes the table's next version and returns its number.

    df holds the whole table, or with `only` all rows of these buckets, whose number and key
    are then those of the table; other buckets keep their files. Columns new to the table
    are NULL in the buckets that stay. A bucket much larger than the others, as of a hot key,
    is written by several tasks.
    """
    spark = df.sparkSession
    old = manifest(spark, path) if only is not None else None
    schema, held, rows = df.schema, {}, 0
    if old:
        key, buckets, schema = old.key, old.buckets, _joint_schema(old.schema, df.schema)
        held = {b: v for b, v in old.held.items() if b not in only}
        rows = old.rows - read(spark, path, old, only).count()
    version = tables.next_version(spark, path)
    target = f"{path}/version={version}"
    (
        df.withColumn(_COLUMN, bucket_of(key, buckets))
        .hint("rebalance", _COLUMN)
        .write.partitionBy(_COLUMN)
        .parquet(f"{target}/data")
    )
    files.release_shuffles(spark)
    names = [n for n in files.names(spark, f"{target}/data") if n.startswith(f"{_COLUMN}=")]
    held |= {int(n.split("=")[1]): version for n in names}
    if names:  # counted from the footers, as an observation of a write without rows has no value
        rows += spark.read.schema(schema).parquet(f"{target}/data").count()
    found = Manifest(key, buckets, rows, schema, held)
    files.write_text(spark, f"{target}/{_MANIFEST}", found.text())
    files.write_text(spark, f"{target}/_SUCCESS", "")
    return version


def prune(spark: SparkSession, path: str, keep_versions: int) -> list[str]:
    """Removes all but the latest versions, and the buckets' folders that these do not name."""
    found = tables.versions(spark, path)
    kept = found[-max(1, keep_versions) :]
    needed = {f for v in kept if (known := manifest(spark, path, v)) for f in folders(path, known)}
    removed = []
    for version in found:
        target = f"{path}/version={version}"
        if version not in kept:
            files.delete(spark, f"{target}/_SUCCESS")
        for name in files.names(spark, f"{target}/data"):
            folder = f"{target}/data/{name}"
            if name.startswith(f"{_COLUMN}=") and folder not in needed:
                files.delete(spark, folder)
                removed.append(folder)
    return removed
