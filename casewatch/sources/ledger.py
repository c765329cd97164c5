"""Which raw files a Bronze quarter holds, so that a quarter whose files are the same is not read again.

A file is known by a digest of its lines, its first line and its length. The digest is made
in one distributed scan of all files of an ingest, in which a file of any size is split, and
does not depend on where it is split: it counts the lines and adds up the halves of their
64-bit hashes. Bronze rows have no order, so neither has the digest; where lines
depend on their neighbours (quoted fields over line ends, odd line ends) the time of the
file's last change counts too.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, Row, SparkSession, functions as F

from casewatch.sources import files

_LEDGER = "_ledger.json"


def digests(spark: SparkSession, paths: Iterable[str], encoding: str, in_order: Column) -> dict[str, str]:
    """A digest for each leaf file below the paths, by its full path.

    in_order: whether a line, `value`, may depend on the lines around it.
    """
    found = [leaf for path in paths for leaf in files.leaves(spark, path)]
    return named(spark, found, examine(spark, found, in_order), encoding)


def examine(spark: SparkSession, found: list[str], in_order: Column, **facts: Column) -> dict[str, Row]:
    """What the lines of files are known by, and other aggregates of them, by plain path; one scan.

    Files without a line are missing.
    """
    if not found:
        return {}
    value = F.xxhash64("value")
    seen = spark.read.option("lineSep", "\n").text(found).groupBy(F.col("_metadata.file_path").alias("path"))
    lines = seen.agg(
        F.count("*").alias("lines"),
        F.try_sum(F.shiftright(value, 32)).alias("high"),
        F.try_sum(value.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
        F.bool_or(in_order).alias("in_order"),
        *(fact.alias(name) for name, fact in facts.items()),
    )
    return {files.plain(r.path): r for r in lines.collect()}  # a row for each file, as listed above


def named(spark: SparkSession, found: list[str], seen: dict[str, Row], encoding: str) -> dict[str, str]:
    """The digest of each examined file."""
    return {leaf: _digest(spark, leaf, seen.get(files.plain(leaf)), encoding) for leaf in found}


def _digest(spark: SparkSession, leaf: str, seen, encoding: str) -> str:
    length, changed = files.length_and_time(spark, leaf)
    parts = [length, files.first_line(spark, leaf, encoding)]
    if seen:
        parts += [seen.lines, seen.high, seen.low]
        if seen.in_order or seen.high is None or seen.low is None:  # a sum beyond 64 bits proves nothing
            parts.append(changed)
    return json.dumps(parts)


def recorded(spark: SparkSession, path: str, quarter: str) -> dict | None:
    """{"rows": n, "way": how it was parsed, "files": digest by path} of a quarter; None if nothing is known."""
    return _all(spark, path).get(quarter)


def record(spark: SparkSession, path: str, quarter: str, entry: dict | None) -> None:
    """Puts a quarter's entry in place of its old one; None forgets it.

    It is forgotten before the quarter's rows are replaced and recorded after, so that a
    lost ingest is done again.
    """
    known = _all(spark, path)
    if entry is None and quarter not in known:
        return
    known.pop(quarter, None)
    files.write_text(spark, f"{path}/{_LEDGER}", json.dumps(known | ({quarter: entry} if entry else {})), replace=True)


def _all(spark: SparkSession, path: str) -> dict[str, dict]:
    name = f"{path}/{_LEDGER}"
    return json.loads(files.read_text(spark, name)) if files.exists(spark, name) else {}
