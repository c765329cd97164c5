"""What several operators share: reading tables, words, the shared folder."""

from __future__ import annotations

import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

# The white space that separates words, as a class body and as characters.
SPACE_CLASS = r"\x20\x09-\x0D"
SPACES = " \t\n\x0b\x0c\r"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package's source to the Python workers, once per application.

    Workers may start in any folder, and functions that run there are found by import.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).parent.parent
    archive = Path(SparkFiles.getRootDirectory()) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small table whose size Spark knows, so that it is broadcast only below the session's limit."""
    columns = list(zip(*rows)) or [()] * len(schema)
    arrays = [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, schema)]
    return spark.createDataFrame(pa.table(arrays, names=schema.names))


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below the folder that driver and executors share.

    That is the cluster's checkpoint folder, or the warehouse where none is set.
    """
    context = spark.sparkContext
    top = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    return f"{top or spark.conf.get('spark.sql.warehouse.dir')}/casewatch-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """df computed once and kept in the shared folder, with its lineage cut."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def words(text: Column) -> Column:
    """The words of a text in order: maximal runs of characters outside SPACES."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    split = F.split(bare, f"[{SPACE_CLASS}]+")
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(split)


def let(value: Column, body) -> Column:
    """body(value) with `value` computed once per row, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
