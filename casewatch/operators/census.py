"""Key census: how often each key occurs in each of several tables.

One union and one aggregation replace a join per table pair. Partial aggregation
collapses repeated keys before the exchange, so a hot key is a few rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def census(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """One row per key (NULL is a key) with a row-count column per table."""
    tagged = [
        df.select(key, *(F.lit(int(other == name)).cast("long").alias(other) for other in tables))
        for name, df in tables.items()
    ]
    stacked = reduce(DataFrame.unionAll, tagged)
    return stacked.groupBy(key).agg(*(F.sum(name).alias(name) for name in tables))


def membership(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """Distinct non-NULL keys with a flag `in_<table>` per table, to be joined on `key`.

    Grouping by a second column, the key's length, changes no result. But it keeps
    the partitioning from serving the join as it is, so the join gets exchanges
    directly below it on both sides, and AQE can then split a hot key of the other
    side.
    """
    flags = {f"in_{name}": name for name in tables}
    tagged = [
        df.filter(F.col(key).isNotNull()).select(
            key, F.length(key).alias("_width"), *(F.lit(owner == name).alias(f) for f, owner in flags.items())
        )
        for name, df in tables.items()
    ]
    stacked = reduce(DataFrame.unionAll, tagged)
    return stacked.groupBy(key, "_width").agg(*(F.max(f).alias(f) for f in flags)).drop("_width")


def splittable_ids(df: DataFrame, key: str) -> DataFrame:
    """Distinct non-NULL keys as (`key`, `_width`), for joins on either or both columns.

    They are grouped by a third column that the key determines. So joins on the key, and
    joins on key and width, all get exchanges of their own (see `membership`); and rows
    that were joined on both columns are exchanged again for a later join on the key.
    """
    width, head = F.length(key).alias("_width"), F.ascii(key).alias("_head")
    keys = df.filter(F.col(key).isNotNull()).select(key, width, head)
    return keys.distinct().drop("_head")


def total(column: str | Column) -> Column:
    """Sum that is 0, not NULL, over no rows."""
    return F.coalesce(F.sum(column), F.lit(0))


def as_rows(names: list[str], records: list[tuple[Column | str, ...]]) -> Column:
    """Turns one row into several: each record becomes a row with these columns."""
    structs = [F.struct(*(value.alias(n) for n, value in zip(names, r))) for r in records]
    return F.inline(F.array(*structs))
