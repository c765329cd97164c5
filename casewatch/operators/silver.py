"""Bronze to Silver: typing, normalising, latest case version, orphan removal."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, Window, functions as F

from casewatch.functions import cleaning
from casewatch.lazy import LazyTables
from casewatch.operators.census import membership
from casewatch.schema import FILE_LINEAGE, TABLES


class Rule(NamedTuple):
    """How the columns of one table are cleaned; `optional` ones may be absent."""

    ints: tuple[str, ...] = ()
    doubles: tuple[str, ...] = ()
    codes: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    optional_trims: tuple[str, ...] = ()
    optional_dates: tuple[str, ...] = ()


RULES = {
    "drug": Rule(
        ints=("drug_seq",),
        codes=("drugname", "prod_ai", "role_cod"),
        optional_trims=("route", "dose_form", "dose_freq"),
    ),
    "reac": Rule(codes=("pt",), required=("pt",)),
    "outc": Rule(codes=("outc_cod",)),
    "rpsr": Rule(codes=("rpsr_cod",)),
    "ther": Rule(ints=("dsg_drug_seq",), optional_dates=("start_dt", "end_dt")),
    "indi": Rule(ints=("indi_drug_seq",), codes=("indi_pt",)),
    "demo": Rule(
        doubles=("age", "wt"),
        optional_trims=("reporter_country", "occr_country", "mfr_sndr", "occp_cod"),
    ),
}


def _keyed(bronze: DataFrame, rule: Rule) -> DataFrame:
    df = bronze.drop(*FILE_LINEAGE)
    for name in ("primaryid", *rule.required):
        df = df.filter(cleaning.present(name))
    return df


def _clean_columns(df: DataFrame, rule: Rule, as_of: dt.date | None) -> DataFrame:
    columns = {c: cleaning.whole_number(c) for c in rule.ints}
    columns |= {c: cleaning.number(c) for c in rule.doubles}
    columns |= {c: cleaning.code(c) for c in rule.codes}
    columns |= {c: F.trim(c) for c in rule.optional_trims if c in df.columns}
    columns |= {
        f"{c}_parsed": cleaning.partial_date(c, as_of)
        for c in rule.optional_dates
        if c in df.columns
    }
    return df.withColumns(columns)


def clean_child(table: str, bronze: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Silver rows of one child table, orphans still included. No shuffle."""
    rule = RULES[table]
    return _clean_columns(_keyed(bronze, rule), rule, as_of)


def typed_versions(bronze: DataFrame) -> DataFrame:
    """Keyed DEMO rows with `caseversion` as an int: every version of every case."""
    return _keyed(bronze, RULES["demo"]).withColumn(
        "caseversion", cleaning.whole_number("caseversion")
    )


def latest_version(df: DataFrame) -> DataFrame:
    """One row per caseid: highest caseversion, then fda_dt, then primaryid.

    Spark plans `rank == 1` as a group limit before and after the exchange, so a
    map task sends at most one row per case: a hot caseid (all NULLs, say) costs
    one row per task. The remaining columns break full ties, so a task that is
    run again picks the same row.
    """
    keys = ["caseversion", "fda_dt", "primaryid"]
    rest = [c for c in df.columns if c not in keys and c != "caseid"]
    order = [F.desc(c) for c in keys] + [F.asc(c) for c in rest]
    rank = F.row_number().over(Window.partitionBy("caseid").orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def finish_demo(versions: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """The row-wise part of DEMO cleaning, on rows from `typed_versions`."""
    typed = _clean_columns(versions, RULES["demo"], as_of)
    return typed.withColumns(
        {
            "event_dt_parsed": cleaning.partial_date("event_dt", as_of),
            "age_in_years": cleaning.age_in_years(),
            "sex": cleaning.sex(),
        }
    )


def clean_demo(bronze: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Silver DEMO, one row per case.

    Versions are picked first, so the exchange carries raw columns only and the
    rest of the cleaning runs on surviving rows.
    """
    return finish_demo(latest_version(typed_versions(bronze)), as_of)


def keep_valid(child: DataFrame, demo: DataFrame) -> DataFrame:
    """Child rows whose report is in DEMO, primaryid first.

    A semi-join with DEMO's unique ids. Its inputs are direct exchanges, so AQE can
    split a hot primaryid of the child, or broadcast the ids when their measured
    size allows; an id that DEMO repeats is one row on the other side.
    """
    columns = ["primaryid"] + [c for c in child.columns if c != "primaryid"]
    ids = membership({"demo": demo}, "primaryid").select("primaryid")
    return child.select(columns).join(ids, "primaryid", "left_semi")


def clean_all(bronze: Mapping[str, DataFrame], as_of: dt.date | None = None) -> LazyTables:
    """All Silver tables of a batch, children restricted to its DEMO."""

    def build(table: str) -> DataFrame:
        if table == "demo":
            return clean_demo(bronze["demo"], as_of)
        return keep_valid(clean_child(table, bronze[table], as_of), silver["demo"])

    silver = LazyTables((t for t in TABLES if t in bronze), build)
    return silver
