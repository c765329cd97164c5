"""Compares every registered query with its oracle SQL.

Run as a script: python tests/compare.py [data dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# Spark simple type -> the oracle engine's type name.
TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE",
}


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


took: dict[str, float] = {}


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, query, sql, sf_dir):
    """None when equal, else a short text."""
    df = query(spark, sf_dir)
    start = time.time()
    ours = normal(df.collect(), df.columns)
    took["spark"] = time.time() - start
    # No Python in the plan, no cross join, no rows collected into one task.
    text = df._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "CartesianProduct", "NestedLoopJoin", "CollectLimit "):
        if word in text:
            return f"{word} in the plan"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    theirs = normal(result.fetchall(), names)
    took["oracle"] = time.time() - start - took["spark"]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    wrong = [(c, t, kinds[c]) for c, t in df.dtypes if TYPES.get(t) != kinds[c]]
    if wrong:
        return f"types {wrong}"
    if ours != theirs:
        only_ours = [r for r in ours if r not in theirs][:3] if len(ours) < 5000 else "?"
        diff = next((p for p in zip(ours, theirs) if p[0] != p[1]), None)
        return f"rows {len(ours)} vs {len(theirs)}; first difference {diff}; only ours {only_ours}"
    return None


def main():
    import __spark_entry__ as e
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or [q for q in queries if q in sqls]:
        start = time.time()
        try:
            problem = compare(spark, con, name, queries[name], sqls[name], sf_dir)
        except Exception as ex:  # noqa: BLE001
            problem = f"error {type(ex).__name__}: {str(ex)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {took} {problem or ''}", flush=True)
    print("missing oracles:", sorted(set(queries) - set(sqls)), "extra:", sorted(set(sqls) - set(queries)), "bad:", bad)


if __name__ == "__main__":
    main()
