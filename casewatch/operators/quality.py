"""Data-quality suite: 30 checks over the seven Silver tables.

Each table is scanned once, whatever the number of checks on it: conditions, row
counts, referential integrity and duplicates are all counters of one census over report
and case ids.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from casewatch.functions.cleaning import AGE_LIMITS, missing, outside
from casewatch.operators.census import as_rows, total
from casewatch.schema import CHILDREN, OUTCOMES, ROLES, SEXES

# Checked columns, and the tables whose rows are counted.
CRITICAL = {
    "demo": ["primaryid", "caseid", "caseversion"],
    "drug": ["primaryid", "drugname", "role_cod"],
    "reac": ["primaryid", "pt"],
}
EXPECTED = {"demo": ["sex", "age", "event_dt", "reporter_country"]}
DOMAINS = {
    "demo": {"sex": SEXES},
    "drug": {"role_cod": ROLES},
    "outc": {"outc_cod": OUTCOMES},
}
COUNTED = ["demo", "drug", "reac", "outc", "ther", "indi"]
WARN_BELOW_PCT = 50

PASS, WARN, FAIL = "PASS", "WARN", "FAIL"

# A finding before its verdict: the count, the rows it is a share of (null checks
# only), the words of its metric, and the verdict for a count above zero.
_FINDING = ["check_name", "table_name", "n", "of", "unit", "severity"]


def _finding(check: str, table: str, n: Column, unit: str, severity: str, of: Column | None = None):
    share = F.lit(None).cast("long") if of is None else of
    return (F.lit(check), F.lit(table.upper()), n, share, F.lit(unit), F.lit(severity))


def _measures(table: str) -> list[tuple[str, Column, str, str, bool]]:
    """Row-wise conditions to be counted: check, condition, unit, severity, show as share."""
    found = [(f"null_{c}", missing(c), "nulls", FAIL, True) for c in CRITICAL.get(table, [])]
    found += [(f"null_{c}", missing(c), "nulls", "BY_SHARE", True) for c in EXPECTED.get(table, [])]
    for column, domain in DOMAINS.get(table, {}).items():
        found.append((f"domain_{column}", outside(column, domain), "invalid values", FAIL, False))
    if table == "demo":
        low, high = AGE_LIMITS
        age = F.col("age_in_years")
        odd = (age < low) | (age > high)
        found.append(("range_age_in_years", odd, f"out of range ({low}-{high})", WARN, False))
    return found


def _counted(silver: Mapping[str, DataFrame], conditions: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """One row with everything that is counted about the tables, from one scan of each.

    Every row becomes a key with counters, DEMO rows two, as report and as case. Counters
    are summed per key before and after the only exchange, then over all keys:
    `rows_<table>`, `orphans_<child>`, `duplicate_primaryid`, `duplicate_caseid`, and the
    rows that meet each named condition of a table.
    """
    tables = ["demo", *CHILDREN]
    named = [(t, name) for t in tables for name in conditions.get(t, {})]

    def counters(owner: str, as_case: bool) -> list[Column]:
        rows = [F.lit(int(t == owner and not as_case)).cast("long").alias(f"rows_{t}") for t in tables]
        rows.append(F.lit(int(as_case)).cast("long").alias("cases"))
        for t, name in named:
            met = conditions[t][name] if t == owner and not as_case else F.lit(False)
            rows.append(F.coalesce(met, F.lit(False)).cast("long").alias(name))
        return rows

    def keyed(table: str) -> DataFrame:
        keys = {"primaryid": False} | ({"caseid": True} if table == "demo" else {})
        records = [
            F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("key"), *counters(table, as_case))
            for k, as_case in keys.items()
        ]
        return silver[table].select(F.inline(F.array(*records)))

    stacked = reduce(DataFrame.unionAll, map(keyed, tables))
    sums = [c for c in stacked.columns if c not in ("kind", "key")]
    per_key = stacked.groupBy("kind", "key").agg(*(F.sum(c).alias(c) for c in sums))
    report, demo, cases = F.col("kind") == "primaryid", F.col("rows_demo"), F.col("cases")
    orphaned = {c: report & (demo == 0) & (F.col(f"rows_{c}") > 0) for c in CHILDREN}
    return per_key.agg(
        *(total(c).alias(c) for c in sums if c != "cases"),
        *(F.count_if(met).alias(f"orphans_{c}") for c, met in orphaned.items()),
        total(F.when(demo > 1, demo - 1)).alias("duplicate_primaryid"),
        total(F.when(cases > 1, cases - 1)).alias("duplicate_caseid"),
    )


def _id_records() -> list[tuple]:
    """Findings about report and case ids."""
    records = [
        _finding(f"ref_integrity_{c.upper()}", c, F.col(f"orphans_{c}"), "orphan primaryids", FAIL) for c in CHILDREN
    ]
    for key, severity in (("primaryid", FAIL), ("caseid", WARN)):
        records.append(_finding(f"duplicate_{key}", "demo", F.col(f"duplicate_{key}"), f"duplicate {key}s", severity))
    return records


def _findings(silver: Mapping[str, DataFrame]) -> DataFrame:
    measured = {t: {f"{t}_{check}": (check, *rest) for check, *rest in _measures(t)} for t in ("demo", *CHILDREN)}
    conditions = {t: {name: rest[1] for name, rest in found.items()} for t, found in measured.items()}
    records = [
        _finding(check, t, F.col(name), unit, severity, F.col(f"rows_{t}") if share else None)
        for t, found in measured.items()
        for name, (check, _, unit, severity, share) in found.items()
    ]
    records += [_finding("row_count", t, F.col(f"rows_{t}"), "rows", PASS) for t in COUNTED]
    return _counted(silver, conditions).select(as_rows(_FINDING, records + _id_records()))


def run_checks(silver: dict[str, DataFrame], run_label: str = "unknown") -> DataFrame:
    """The report: check_name, table_name, metric, result, timestamp, run_label.

    `n` and `pct` carry the metric as numbers.
    """
    findings = _findings(silver)

    share = F.bround(F.try_divide("n", "of") * 100, 2)
    pct = F.when(F.col("of").isNotNull(), F.coalesce(share, F.lit(0.0)))
    # An empty table shows a bare 0.
    pct_text = F.when(F.col("of") == 0, "0").otherwise(F.col("pct").cast("string"))
    metric = F.concat(
        F.format_number("n", 0),
        F.lit(" "),
        F.col("unit"),
        F.when(F.col("pct").isNotNull(), F.concat(F.lit(" ("), pct_text, F.lit("%)"))).otherwise(""),
    )
    by_share = F.when(F.col("pct") == 0, PASS).when(F.col("pct") < WARN_BELOW_PCT, WARN).otherwise(FAIL)
    result = (
        F.when(F.col("severity") == "BY_SHARE", by_share)
        .when(F.col("n") == 0, PASS)
        .otherwise(F.col("severity"))
    )
    return findings.withColumn("pct", pct).select(
        "check_name",
        "table_name",
        metric.alias("metric"),
        result.alias("result"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.lit(run_label).alias("run_label"),
        "n",
        "pct",
    )


def verdict_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("result").agg(F.count("*").alias("count")).orderBy("result")


def in_order(report: DataFrame) -> DataFrame:
    return report.orderBy("table_name", "check_name")


def with_result(report: DataFrame, result: str) -> DataFrame:
    """Failures or warnings only, in report order."""
    return in_order(report.filter(F.col("result") == result))


def post_checks(silver: dict[str, DataFrame]) -> DataFrame:
    """Proof after a transform or merge: every `n` should be 0."""
    name = F.col("drugname")
    odd = {"drugname_not_upper": name != F.upper(name), "drugname_not_trimmed": name != F.trim(name)}
    records = [_finding(check, "drug", F.col(check), "rows", FAIL) for check in odd]
    counted = _counted(silver, {"drug": odd}).select(as_rows(_FINDING, records + _id_records()))
    checked = counted.select("check_name", "table_name", "n")
    return checked.withColumn("result", F.when(F.col("n") == 0, PASS).otherwise(FAIL))


def broken_lines(silver: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table with a text field that holds a line break: table_name, n.

    Such fields come from quoted text and are easily split by other readers. It is a
    check beside the report, not a part of it.
    """
    counts = []
    for table, df in silver.items():
        texts = [c for c, kind in df.dtypes if kind == "string"]
        broken = reduce(Column.__or__, (F.coalesce(F.col(c).rlike("[\\r\\n]"), F.lit(False)) for c in texts))
        counts.append(df.agg(F.lit(table.upper()).alias("table_name"), F.count_if(broken).alias("n")))
    return reduce(DataFrame.unionAll, counts)
