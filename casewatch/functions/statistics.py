"""Disproportionality statistics of a 2x2 table, as column expressions.

a: reports with the drug and the event      b: with the drug, not the event
c: with the event, not the drug             d: with neither         n = a+b+c+d
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, functions as F

# The two-sided 95 % normal quantile and the continuity correction.
Z95 = 1.96
CORRECTION = 0.5


class Thresholds(NamedTuple):
    """A pair is a signal when all three lower bounds are met (Evans 2001)."""

    prr: float = 2.0
    chi2: float = 4.0
    reports: int = 3


class Cells(NamedTuple):
    a: Column
    b: Column
    c: Column
    d: Column

    @classmethod
    def named(cls, suffix: str = "") -> "Cells":
        return cls(*(F.col(x + suffix) for x in "abcd"))


def has_zero_cell(cells: Cells) -> Column:
    a, b, c, d = cells
    return (a == 0) | (b == 0) | (c == 0) | (d == 0)


def corrected(cell: Column, needed: Column) -> Column:
    return F.when(needed, cell + CORRECTION).otherwise(cell)


def prr(cells: Cells) -> Column:
    """Proportional reporting ratio."""
    a, b, c, d = cells
    return (a / (a + b)) / (c / (c + d))


def ror(cells: Cells) -> Column:
    """Reporting odds ratio."""
    a, b, c, d = cells
    return (a * d) / (b * c)


def ror_log_error(cells: Cells) -> Column:
    """Standard error of ln(ROR)."""
    a, b, c, d = cells
    return F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)


def ror_bound(ratio: Column, error: Column, side: int) -> Column:
    """95 % confidence bound of the ROR; side is -1 (lower) or +1 (upper)."""
    log_ratio = F.ln(ratio)
    step = F.lit(Z95) * error
    return F.exp(log_ratio - step if side < 0 else log_ratio + step)


def yates_chi2(cells: Cells, n: Column) -> Column:
    """Yates chi-square on the raw cells, not clamped at small deviations.

    NULL when a margin is empty (the drug or the event covers every report).
    """
    a, b, c, d = cells
    deviation = F.abs(a * d - b * c) - n / 2
    return F.try_divide(n * F.pow(deviation, F.lit(2)), (a + b) * (c + d) * (a + c) * (b + d))


def is_signal(limits: Thresholds, reports: Column, ratio: Column, chi2: Column) -> Column:
    return (ratio >= limits.prr) & (chi2 >= limits.chi2) & (reports >= limits.reports)
