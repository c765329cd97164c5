"""Upserts of a new batch into stored Silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from casewatch.operators.census import census, membership, splittable_ids, total
from casewatch.operators.silver import keep_valid, latest_version

INSERTED, UPDATED, UNCHANGED = "inserted", "updated", "unchanged"


def demo_actions(target: DataFrame, batch: DataFrame, one_per_case: bool = False) -> DataFrame:
    """The batch, one row per case, with what a merge does to it in `_action`.

    A caller whose batch has one row per case already, such as cleaned DEMO, says so
    with one_per_case and saves its window.

    A stored case is updated by a strictly newer version only. A NULL version
    on either side leaves it unchanged, and a NULL caseid matches nothing.
    Only two columns of the target take part in the join.
    """
    source = batch if one_per_case else latest_version(batch)
    stored = target.select("caseid", F.col("caseversion").alias("_stored_version")).withColumn(
        "_stored", F.lit(True)
    )
    action = (
        F.when(F.col("_stored").isNull(), INSERTED)
        .when(F.col("caseversion") > F.col("_stored_version"), UPDATED)
        .otherwise(UNCHANGED)
    )
    return (
        source.join(stored, "caseid", "left")
        .select(*source.columns, action.alias("_action"))
    )


def apply_demo_actions(target: DataFrame, actions: DataFrame) -> DataFrame:
    """Target with updated cases replaced and new cases added.

    The target's caseids are unique (NULL apart), which `latest_version` and this
    operator keep true. Its wide rows meet only the ids being replaced, so they
    stay where they are when AQE finds that id list small enough to broadcast.
    Columns that only one side has are kept, with NULL for the other's rows.
    """
    replaced = actions.filter(F.col("_action") == UPDATED).select("caseid")
    written = actions.filter(F.col("_action") != UNCHANGED).drop("_action")
    kept = target.join(replaced, "caseid", "left_anti").select(target.columns)
    return kept.unionByName(written, allowMissingColumns=True)


def merge_demo(target: DataFrame | None, batch: DataFrame) -> DataFrame:
    if target is None:
        return latest_version(batch)
    return apply_demo_actions(target, demo_actions(target, batch))


def demo_merge_stats(actions: DataFrame) -> DataFrame:
    """One row. `matched` counts stored cases in the batch, newer or not."""
    return actions.agg(
        F.count("*").alias("source_rows"),
        F.count_if(F.col("_action") == INSERTED).alias("inserted"),
        F.count_if(F.col("_action") != INSERTED).alias("matched"),
        F.count_if(F.col("_action") == UPDATED).alias("updated"),
        F.count_if(F.col("_action") == UNCHANGED).alias("unchanged"),
    )


def merge_child(target: DataFrame | None, batch: DataFrame, demo: DataFrame) -> DataFrame:
    """Batch rows with a report in the merged DEMO replace that report's rows.

    Replaced reports are those in both the batch and DEMO, a distributed list of
    unique ids; nothing is collected.
    """
    valid = keep_valid(batch, demo)
    if target is None:
        return valid
    replaced = _batch_and_demo(batch, demo).filter("in_batch and in_demo").select("primaryid")
    kept = target.join(replaced, "primaryid", "left_anti")
    return kept.select(target.columns).unionByName(valid, allowMissingColumns=True)


def refresh_child(
    target: DataFrame | None,
    batch: DataFrame,
    demo: DataFrame,
    written: Observation | None = None,
) -> DataFrame:
    """`merge_child` followed by orphan removal, in one pass over the stored rows.

    What stays is exactly the stored rows of DEMO reports that the batch lacks. An
    observation given as `written` counts the batch rows while the result is written.
    """
    valid = keep_valid(batch, demo)
    if written is not None:
        valid = valid.observe(written, F.count("*").alias("rows"))
    if target is None:
        return valid
    staying = _batch_and_demo(batch, demo).filter("in_demo and not in_batch").select("primaryid")
    kept = target.join(staying, "primaryid", "left_semi")
    return kept.select(target.columns).unionByName(valid, allowMissingColumns=True)


def changed_reports(batch: DataFrame, replaced: DataFrame, demo: DataFrame) -> DataFrame:
    """primaryid, was_stored, present: the reports that a DEMO merge may have touched.

    They are the batch's and those of the stored rows that it replaced. `present` tells
    whether the merged DEMO has the report; of that table one column is read.
    """
    flag = F.max("was_stored").alias("was_stored")
    asked = batch.select("primaryid", F.lit(False).alias("was_stored")).unionAll(
        replaced.select("primaryid", F.lit(True))
    )
    asked = asked.filter("primaryid is not null").groupBy("primaryid", F.length("primaryid").alias("_width")).agg(flag)
    there = demo.select("primaryid").join(asked.select("primaryid"), "primaryid", "left_semi").distinct()
    known = asked.drop("_width").join(there.withColumn("present", F.lit(True)), "primaryid", "left")
    return known.select("primaryid", "was_stored", F.coalesce("present", F.lit(False)).alias("present"))


def replacing_rows(batch: DataFrame, changed: DataFrame) -> DataFrame:
    """The batch's child rows whose report the merged DEMO has."""
    return batch.join(changed.filter("present").select("primaryid"), "primaryid", "left_semi")


def replaced_reports(valid: DataFrame, changed: DataFrame) -> DataFrame:
    """The reports whose stored rows go: those of the replacing rows `valid`, and the ones that DEMO lost.

    `valid` should be stored, as it is made by joins of the batch and read here once more.
    """
    gone = changed.filter("was_stored and not present").select("primaryid")
    return splittable_ids(valid.select("primaryid").unionAll(gone), "primaryid").select("primaryid")


def replace_reports(stored: DataFrame, valid: DataFrame, ids: DataFrame) -> DataFrame:
    """Stored child rows without those of the reports `ids`, and the rows that replace them."""
    kept = stored.join(ids, "primaryid", "left_anti")
    return kept.select(stored.columns).unionByName(valid, allowMissingColumns=True)


def _batch_and_demo(batch: DataFrame, demo: DataFrame) -> DataFrame:
    return membership({"batch": batch, "demo": demo}, "primaryid")


def case_overlap(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """One row: cases on either side, in both, and in one only."""
    seen = census({"stored": stored, "batch": batch}, "caseid")
    in_stored, in_batch = F.col("stored") > 0, F.col("batch") > 0
    return seen.agg(
        F.count_if(in_stored).alias("stored_cases"),
        F.count_if(in_batch).alias("batch_cases"),
        F.count_if(in_stored & in_batch).alias("in_both"),
        F.count_if(in_stored & ~in_batch).alias("only_stored"),
        F.count_if(~in_stored & in_batch).alias("only_batch"),
    )


def snapshot_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row comparing two versions of DEMO."""
    seen = census({"before": before, "after": after}, "caseid")
    return seen.agg(
        total("before").alias("rows_before"),
        total("after").alias("rows_after"),
        total(F.col("after") - F.col("before")).alias("net_new_rows"),
        F.count_if(F.col("before") == 0).alias("new_cases"),
        F.count_if(F.col("after") == 0).alias("lost_cases"),
    )
