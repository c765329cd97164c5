"""Contingency counts that are carried on instead of counted again.

A report adds to four kinds of counts: one for each of its (drug, event) pairs, one for
each of its drugs if it has an event, one for each of its events if it has a drug, and one
for the whole. All are sums over reports, so what a merge changes is the counts of the
touched reports as they are now, less what they were before. Other reports are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from casewatch.functions.statistics import Thresholds
from casewatch.operators import signals

PAIR, DRUG, EVENT, ALL = "pair", "drug", "event", "all"
_KEY = ["kind", "drugname", "pt"]


def _kind(counts: DataFrame, kind: str, n: str) -> DataFrame:
    def name(column: str) -> Column:
        return F.col(column) if column in counts.columns else F.lit(None).cast("string").alias(column)

    return counts.select(F.lit(kind).alias("kind"), name("drugname"), name("pt"), F.col(n).cast("bigint").alias("n"))


def report_counts(drug: DataFrame, reac: DataFrame) -> DataFrame:
    """kind, drugname, pt, n: all four kinds of counts of these reports."""
    drugs, events = signals.suspect_drugs(drug), signals.reactions(reac)
    parts = signals.count_parts(drugs, events)
    kinds = zip((PAIR, DRUG, EVENT, ALL), parts, ("a", "drug_total", "event_total", "N"))
    return reduce(DataFrame.unionAll, (_kind(part, kind, n) for kind, part, n in kinds)).filter("n > 0")


def of_reports(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """The rows of some reports, given as unique ids."""
    return rows.join(reports.select("primaryid"), "primaryid", "left_semi")


def carried_on(stored: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Stored counts less those of the touched reports before, plus theirs after; zeros go."""
    signed = stored.unionByName(before.withColumn("n", -F.col("n"))).unionByName(after)
    return signed.groupBy(_KEY).agg(F.sum("n").alias("n")).filter("n <> 0")


def scored(counts: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """The scores of `signals.disproportionality`, from counts in this form.

    All pairs are scored, since N enters every score; that is one row per pair.
    """

    def of(kind: str, *columns: str, name: str) -> DataFrame:
        return counts.filter(F.col("kind") == kind).select(*columns, F.col("n").alias(name))

    parts = of(PAIR, "drugname", "pt", name="a"), of(DRUG, "drugname", name="drug_total")
    return signals.score(signals.two_by_two(*parts, of(EVENT, "pt", name="event_total"), of(ALL, name="N")), limits)
