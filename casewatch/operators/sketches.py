"""Profiles that are kept per quarter and merged, instead of counted again over all quarters.

One row per table, quarter and column holds counts, a HyperLogLog sketch of the distinct
values and, for numbers, a KLL sketch of the quantiles. A new quarter adds its rows; a
profile of any set of quarters merges theirs and reads no table. The exact path is in
`profile`; these results come with the error that they may have.
"""

from __future__ import annotations

from collections.abc import Iterable
from math import sqrt

from pyspark.sql import Column, DataFrame, functions as F

from casewatch.schema import PARTITIONS

#: 2^LOG_REGISTERS registers of a distinct sketch, and the size of a quantile sketch.
LOG_REGISTERS, QUANTILE_SIZE = 14, 200
#: Three standard errors of a merged distinct sketch, relative to the estimate (Flajolet et al. 2007).
DISTINCT_ERROR = 3 * 1.04 / sqrt(2**LOG_REGISTERS)
#: Normalised rank error of a quantile at QUANTILE_SIZE with 99 % confidence (Karnin, Lang and Liberty 2016).
RANK_ERROR = 0.0166
QUANTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}


def quarter_sketches(table: str, rows: DataFrame, columns: Iterable[str], numbers: Iterable[str] = ()) -> DataFrame:
    """Sketches of the columns, for each quarter in rows; `numbers` also get quantiles.

    One pass with partial aggregation: a task sends one row of sketches for each quarter,
    whose size does not grow with the data. NULL and, among numbers, NaN are no values.
    """
    numbers = list(numbers)

    def sketch(column: str) -> Column:
        number = F.col(column).cast("double") if column in numbers else F.lit(None).cast("double")
        number = F.when(~F.isnan(number), number)
        return F.struct(
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.count("*").alias("rows"),
            F.count(column).alias("values"),
            F.count(number).alias("numbers"),
            F.hll_sketch_agg(F.col(column).cast("string"), LOG_REGISTERS).alias("distinct_sketch"),
            F.kll_sketch_agg_double(number, QUANTILE_SIZE).alias("quantile_sketch"),
        )

    each = rows.groupBy(*PARTITIONS).agg(F.array(*map(sketch, dict.fromkeys([*columns, *numbers]))).alias("s"))
    return each.select(*PARTITIONS, F.explode("s").alias("s")).select(*PARTITIONS, "s.*")


def merged_profile(sketches: DataFrame) -> DataFrame:
    """Per table and column, over all quarters given: rows, nulls, distinct values and quantiles.

    distinct_error is how far distinct_estimate may be off. A quantile's rank among the values may
    be off by RANK_ERROR of their number. Columns without numbers have NULL quantiles.
    """
    merged = sketches.groupBy("table_name", "column_name").agg(
        F.sum("rows").alias("rows"),
        (F.sum("rows") - F.sum("values")).alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_estimate"),
        F.sum("numbers").alias("_numbers"),
        F.kll_merge_agg_double("quantile_sketch").alias("_sketch"),
    )

    def quantile(rank: float) -> Column:
        return F.when(F.col("_numbers") > 0, F.kll_sketch_get_quantile_double("_sketch", F.lit(rank)))

    return merged.select(
        "table_name", "column_name", "rows", "null_count", "distinct_estimate",
        F.ceil(F.col("distinct_estimate") * DISTINCT_ERROR).alias("distinct_error"),
        *(quantile(rank).alias(name) for name, rank in QUANTILES.items()),
    )


def rank_is_within(values: DataFrame, column: str, quantile: Column, rank: float) -> DataFrame:
    """One row, `within`: whether the quantile's rank among the values is within RANK_ERROR of `rank`."""
    v, n = F.col(column).cast("double"), F.count(column)
    below, up_to = F.count_if(v < quantile), F.count_if(v <= quantile)
    return values.agg(((below <= (rank + RANK_ERROR) * n) & (up_to >= (rank - RANK_ERROR) * n)).alias("within"))
