"""Merged sketches of quarters against exact counts over all of them."""

import pytest
from frames import rows
from pyspark.sql import functions as F

from casewatch.operators import sketches


def quarters(spark, n, distinct):
    ids = spark.range(n)
    return ids.select(
        (F.col("id") * 7919 % distinct).cast("string").alias("name"),
        F.when(F.col("id") % 10 != 0, F.pow(F.rand(3), 3)).alias("x"),
        F.lit("2024").alias("_year"),
        F.concat(F.lit("Q"), F.col("id") % 4 + 1).alias("_quarter"),
    )


@pytest.mark.parametrize("distinct", [1, 500, 60_000])
def test_merged_quarters_are_within_their_errors(spark, distinct):
    df = quarters(spark, 200_000, distinct).checkpoint()
    kept = sketches.quarter_sketches("T", df, ["name"], ["x"])
    assert kept.count() == 8
    found = {r.column_name: r for r in sketches.merged_profile(kept).collect()}
    assert abs(found["name"].distinct_estimate - distinct) <= found["name"].distinct_error
    assert (found["name"].rows, found["name"].null_count, found["name"].median) == (200_000, 0, None)
    assert found["x"].null_count == 20_000
    for name, rank in sketches.QUANTILES.items():
        assert sketches.rank_is_within(df, "x", F.lit(found["x"][name]), rank).first().within
        assert not sketches.rank_is_within(df, "x", F.lit(found["x"][name]), rank + 0.05).first().within


def test_a_new_quarter_is_added_to_the_old_ones(spark):
    df = quarters(spark, 50_000, 3_000).checkpoint()
    parts = [sketches.quarter_sketches("T", df.filter(F.col("_quarter") == f"Q{q}"), ["name"]) for q in (1, 2, 3, 4)]
    added = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    for merged in (added, sketches.quarter_sketches("T", df, ["name"])):  # estimates depend on the order of merging
        found = sketches.merged_profile(merged).first()
        assert (found.rows, found.null_count) == (50_000, 0)
        assert abs(found.distinct_estimate - 3_000) <= found.distinct_error


def test_nulls_nans_and_empty_tables(spark):
    df = spark.createDataFrame([(None, float("nan"), "y", "q"), ("a", None, "y", "q")], "name string, x double, _year string, _quarter string")
    found = rows(sketches.merged_profile(sketches.quarter_sketches("T", df, ["name"], ["x"])))
    assert found == [("T", "name", 2, 1, 1, 1, None, None, None), ("T", "x", 2, 1, 1, 1, None, None, None)]
    assert rows(sketches.merged_profile(sketches.quarter_sketches("T", df.limit(0), ["name"], ["x"]))) == []
