"""Search for parts of drug names in an index of the distinct spellings.

The postings list, for every three characters in a row (gram) that occur in a name, the names that
have them. A name contains a fragment only if it has all grams of the fragment, so
postings are read for these grams alone; names found in all of them are candidates, which are then
compared with the fragment itself. DRUG is not read by a search.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

GRAM = 3
SPELLING = ["drugname", "prod_ai", "role_cod"]


def spellings(drug: DataFrame) -> DataFrame:
    """Distinct spellings with name_id, a hash of the upper-case name; rows without a name are left out.

    Names of equal hash share their postings, which costs a comparison and no result.
    """
    named = drug.filter("drugname is not null").select(*SPELLING).distinct()
    return named.select(F.xxhash64(F.upper("drugname")).alias("name_id"), *SPELLING)


def postings(spelled: DataFrame) -> DataFrame:
    """gram, name_id: one row for each gram of each name, however often it occurs in it."""
    names = spelled.select("name_id", F.upper("drugname").alias("name")).distinct()
    starts = F.sequence(F.lit(1), F.length("name") - GRAM + 1)
    found = F.array_distinct(F.transform(starts, lambda i: F.col("name").substr(i, F.lit(GRAM))))
    long_enough = names.filter(F.length("name") >= GRAM)
    return long_enough.select(F.explode(found).alias("gram"), "name_id").distinct()


def grams(fragment: str) -> set[str]:
    """The grams of a fragment; none of a shorter one."""
    upper = fragment.upper()
    return {upper[i : i + GRAM] for i in range(len(upper) - GRAM + 1)}


def is_indexed(fragments: Iterable[str]) -> bool:
    """Whether the postings narrow the search: no fragment is shorter than a gram."""
    return all(grams(f) for f in fragments)


def candidates(posted: DataFrame, fragments: list[str]) -> DataFrame:
    """name_id of the names that have all grams of any fragment; for indexed fragments.

    A gram's postings may be as many as there are names; they are counted by name, with
    partial counts before the shuffle.
    """
    wanted = [grams(f) for f in fragments]
    has = {g: F.bool_or(F.col("gram") == g) for g in sorted(set().union(*wanted))}
    complete: Column = reduce(Column.__or__, (reduce(Column.__and__, (has[g] for g in sorted(w))) for w in wanted))
    read = posted.filter(F.col("gram").isin(list(has)))
    return read.groupBy("name_id").agg(complete.alias("complete")).filter("complete").select("name_id")


def verified(spelled: DataFrame, found: DataFrame | None, fragments: list[str]) -> DataFrame:
    """The spellings of the found names, or of all without `found`, that contain any fragment."""
    name = F.upper("drugname")
    hit: Column = reduce(Column.__or__, (name.contains(f.upper()) for f in fragments))
    rows = spelled if found is None else spelled.join(found, "name_id", "left_semi")
    return rows.filter(hit).select(*SPELLING)
