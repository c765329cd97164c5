"""Row-level comparison of two versions of a stored table.

Buckets that both versions read from the same files are equal and are not read. The rest
is cut into parts by a hash of the key, and a count and an order-free digest of each part's
rows are compared. Only the rows of unequal parts are compared key by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casewatch.sources import buckets, tables

ADDED, LOST, CHANGED = "added", "lost", "changed"
PARTS = 256


def _side(rows: DataFrame, key: str, names: list[str], parts: int, after: bool) -> DataFrame:
    """key, part, hash and side of each row; columns that one version lacks are NULL."""
    columns = [F.col(c) if c in rows.columns else F.lit(None) for c in names]
    return rows.select(
        F.col(key).alias("key"), F.pmod(F.xxhash64(key, F.lit(1)), F.lit(parts)).alias("part"),
        *(F.xxhash64(F.lit(seed), *columns).alias(f"hash{seed}") for seed in (0, 1)), F.lit(after).alias("after"),
    )


def _totals(after: bool) -> list[Column]:
    """Count and order-free digest of one side's rows: sums of two hashes, which repeated rows don't cancel."""
    mine = F.col("after") == after
    sums = [F.sum(F.when(mine, F.col(f"hash{seed}").cast("decimal(38,0)"))) for seed in (0, 1)]
    return [F.count_if(mine).alias(f"rows_{after}"), *(F.coalesce(s, F.lit(0)).alias(f"digest{k}_{after}") for k, s in enumerate(sums))]


def _differ() -> Column:
    return ~(
        (F.col("rows_True") == F.col("rows_False"))
        & (F.col("digest0_True") == F.col("digest0_False"))
        & (F.col("digest1_True") == F.col("digest1_False"))
    )


def changed_keys(before: DataFrame, after: DataFrame, key: str, parts: int = PARTS) -> DataFrame:
    """key, change, rows_before, rows_after of every key whose rows differ; NULL is a key.

    `change` is added, lost or changed. Rows of a key are compared as a multiset. Types
    must agree; a column that one side lacks counts as NULL there.
    """
    names = sorted({*before.columns, *after.columns})
    sides = _side(before, key, names, parts, False).unionAll(_side(after, key, names, parts, True))
    per_part = sides.groupBy("part").agg(*_totals(False), *_totals(True))
    unequal = [r["part"] for r in per_part.filter(_differ()).select("part").collect()]  # at most `parts` numbers
    inside = sides.filter(F.col("part").isin(unequal)) if unequal else sides.limit(0)
    per_key = inside.groupBy("key").agg(*_totals(False), *_totals(True)).filter(_differ())
    change = F.when(F.col("rows_False") == 0, ADDED).when(F.col("rows_True") == 0, LOST).otherwise(CHANGED)
    return per_key.select(
        F.col("key").alias(key), change.alias("change"),
        F.col("rows_False").alias("rows_before"), F.col("rows_True").alias("rows_after"),
    )


def unequal_buckets(old: buckets.Manifest, new: buckets.Manifest) -> list[int]:
    """Buckets whose files differ, where both versions have the same buckets."""
    return sorted(b for b in {*old.held, *new.held} if old.held.get(b) != new.held.get(b))


def changed_rows(spark: SparkSession, path: str, key: str, old: int, new: int, parts: int = PARTS) -> DataFrame:
    """`changed_keys` between two versions of a table; of tables in buckets, only unequal ones are read."""
    before, after = buckets.manifest(spark, path, old), buckets.manifest(spark, path, new)
    if before and after and (before.key, before.buckets) == (after.key, after.buckets):
        only = unequal_buckets(before, after)
        return changed_keys(buckets.read(spark, path, before, only), buckets.read(spark, path, after, only), key, parts)
    return changed_keys(tables.read_version(spark, path, old), tables.read_version(spark, path, new), key, parts)
