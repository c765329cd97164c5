"""Cleaning expressions: keys, numbers, dates, ages and codes held as text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from casewatch.schema import SEXES

# Age units, as years per unit or units per year.
YEARS_PER_UNIT = {"YR": 1, "DEC": 10}
UNITS_PER_YEAR = {"MON": 12, "WK": 52, "DY": 365.25, "HR": 8766}
AGE_LIMITS = (0, 120)

# Dates before this day are treated as typing errors.
EARLIEST_DATE = dt.date(1900, 1, 1)

# A number with a decimal point; group 1 is the part that an int keeps.
_DECIMAL_TEXT = r"^\s*([+-]?[0-9]*)[.][0-9]*\s*$"


def present(name: str) -> Column:
    """Neither NULL nor the empty string. Blanks count as present."""
    return F.col(name).isNotNull() & (F.col(name) != "")


def missing(name: str) -> Column:
    """NULL or the empty string, for a column of any type."""
    return F.col(name).isNull() | (F.col(name).cast("string") == "")


def outside(name: str, domain: list[str]) -> Column:
    return F.col(name).isNotNull() & ~F.col(name).isin(domain)


def code(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def whole_number(name: str) -> Column:
    """Int from text, dropping decimals; NULL when the text is no int.

    The pattern runs only on values the plain cast refuses.
    """
    text = F.col(name).cast("string")
    head = F.regexp_extract(text, _DECIMAL_TEXT, 1)
    truncated = F.when(
        text.rlike(_DECIMAL_TEXT),
        F.when(head.isin("", "+", "-"), F.lit(0)).otherwise(head.try_cast("int")),
    )
    return F.coalesce(text.try_cast("int"), truncated)


def number(name: str) -> Column:
    return F.col(name).try_cast("double")


def partial_date(name: str, as_of: dt.date | None = None) -> Column:
    """Date from yyyyMMdd, yyyyMM or yyyy text, a missing part being 01.

    NULL for other lengths, for days that do not exist, and outside
    EARLIEST_DATE .. as_of (today when not given).
    """
    text = F.col(name)

    def part(start: int, size: int) -> Column:
        return F.substring(text, start, size)

    first = F.lit("01")
    iso = (
        # The cast would also take a blank-padded day, hence the digit test.
        F.when(
            (F.length(text) == 8) & part(8, 1).between("0", "9"),
            F.concat_ws("-", part(1, 4), part(5, 2), part(7, 2)),
        )
        .when(F.length(text) == 6, F.concat_ws("-", part(1, 4), part(5, 2), first))
        .when(F.length(text) == 4, F.concat_ws("-", text, first, first))
    )
    day = iso.try_cast("date")
    latest = F.current_date() if as_of is None else F.lit(as_of)
    return F.when(day.between(F.lit(EARLIEST_DATE), latest), day)


def age_in_years(age: str = "age", unit: str = "age_cod") -> Column:
    """Age in years to one decimal; NULL for unknown units and beyond the limits."""
    value = F.col(age)
    years = F.when(F.lit(False), F.lit(None).cast("double"))
    for name, factor in YEARS_PER_UNIT.items():
        years = years.when(F.col(unit) == name, value * factor)
    for name, divisor in UNITS_PER_YEAR.items():
        years = years.when(F.col(unit) == name, value / divisor)
    return F.when(years.between(*AGE_LIMITS), F.round(years, 1))


def sex(name: str = "sex") -> Column:
    return F.when(F.col(name).isin(SEXES), F.col(name)).otherwise("UNK")
