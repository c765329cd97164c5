"""Small helpers for literal frames."""

from casewatch.schema import COLUMNS


def strings(spark, columns, rows):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))


def bronze(spark, table, rows, year="2024", quarter="Q1"):
    """Bronze rows of a table from dicts; columns not given are NULL."""
    names = COLUMNS[table] + ["_source_file", "_ingestion_ts", "_year", "_quarter"]
    full = [{"_year": year, "_quarter": quarter} | r for r in rows]
    return strings(spark, names, [tuple(r.get(n) for n in names) for r in full])


def rows(df, *columns):
    """Sorted tuples, for order-free comparison."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
