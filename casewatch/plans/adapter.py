"""Projection of order tables onto the seven report tables.

The registered queries run on these. The select lists are plain SQL that means the
same in Spark and in the SQL engine used as an oracle, and hold no operator logic.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casewatch.lazy import LazyTables
from casewatch.schema import COLUMNS, PARTITIONS

_DAY = "replace(cast(cast({} as date) as string), '-', '')"
_PAD = "concat(' ', {}, ' ')"
_ORDER_DAY = _DAY.format("o_orderdate")
_SHIP_DAY = _DAY.format("l_shipdate")
_QUARTER = "case when {} % 2 = 0 then 'Q1' else 'Q2' end"

ORDER_TABLES = {
    "demo": {
        "primaryid": "cast(o_orderkey as string)",
        "caseid": "cast(o_custkey as string)",
        "caseversion": "cast(o_orderkey % 5 + 1 as string)",
        "fda_dt": _ORDER_DAY,
        "event_dt": (
            f"case o_orderkey % 7 when 0 then {_ORDER_DAY} when 1 then left({_ORDER_DAY}, 6) "
            f"when 2 then left({_ORDER_DAY}, 4) when 4 then '18500101' when 5 then '20991231' "
            "when 6 then '20231399' end"
        ),
        "age": "cast(o_custkey % 131 as string)",
        "age_cod": (
            "case o_orderkey % 8 when 0 then 'YR' when 1 then 'DEC' when 2 then 'MON' when 3 then 'WK' "
            "when 4 then 'DY' when 5 then 'HR' when 6 then 'XX' end"
        ),
        "sex": (
            "case o_orderkey % 6 when 0 then 'M' when 1 then 'F' when 2 then 'UNK' when 3 then 'NS' "
            "when 4 then 'm' end"
        ),
        "wt": "case when o_orderkey % 9 = 0 then 'n/a' else cast(o_custkey % 100 as string) end",
        "reporter_country": _PAD.format("n_name"),
        "occr_country": _PAD.format("n_name"),
        "mfr_sndr": _PAD.format("cast(o_custkey as string)"),
        "occp_cod": "cast(null as string)",
    },
    "rpsr": {
        "primaryid": "cast(o_orderkey as string)",
        "rpsr_cod": "lower(substring(o_orderpriority, 3, 3))",
    },
}

LINE_TABLES = {
    "drug": {
        "primaryid": "cast(l_orderkey as string)",
        "drug_seq": "cast(l_linenumber as string)",
        "role_cod": "case l_linenumber when 1 then 'PS' when 2 then ' ss' when 3 then 'I' else 'C' end",
        "drugname": "concat(' ', p_name, ' ', p_brand)",
        "prod_ai": "p_name",
        "route": _PAD.format("p_type"),
        "dose_form": _PAD.format("l_returnflag"),
        "dose_freq": "cast(null as string)",
        "dose_amt": "cast(l_quantity as string)",
        "dose_unit": "'MG'",
    },
    "reac": {
        "primaryid": "cast(l_orderkey as string)",
        "pt": "case when l_linenumber = 7 then '' else concat(p_name, ' ', p_type, ' ') end",
    },
    "outc": {
        "primaryid": "cast(l_orderkey as string)",
        "outc_cod": (
            "case concat(l_returnflag, l_linestatus) when 'AF' then 'DE' when 'AO' then 'HO' "
            "when 'NF' then 'LT' when 'NO' then 'OT' when 'RF' then 'DS' when 'RO' then ' ri' end"
        ),
    },
    "ther": {
        "primaryid": "cast(l_orderkey as string)",
        "dsg_drug_seq": "cast(l_linenumber as string)",
        "start_dt": _SHIP_DAY,
        "end_dt": f"left({_SHIP_DAY}, case when l_linenumber % 2 = 0 then 6 else 4 end)",
    },
    "indi": {
        "primaryid": "cast(l_orderkey as string)",
        "indi_drug_seq": "cast(l_linenumber as string)",
        "indi_pt": _PAD.format("lower(p_type)"),
    },
}


def select_list(table: str) -> dict[str, str]:
    """Column name to SQL text, partition columns included."""
    columns = ORDER_TABLES.get(table) or LINE_TABLES[table]
    key = "o_orderkey" if table in ORDER_TABLES else "l_orderkey"
    return columns | dict(zip(PARTITIONS, ("'2024'", _QUARTER.format(key))))


def _on(left: str, right: str) -> Column:
    return F.col(left) == F.col(right)


def raw_tables(spark: SparkSession, sf_dir: str) -> LazyTables:
    """The seven report tables in Bronze form: every column a string."""
    read = cache(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

    def source(table: str) -> DataFrame:
        if table == "demo":
            people = read("customer").join(read("nation"), _on("c_nationkey", "n_nationkey"))
            return read("orders").join(people, _on("o_custkey", "c_custkey"))
        if table in ORDER_TABLES:
            return read("orders")
        if table in ("outc", "ther"):
            return read("lineitem")
        return read("lineitem").join(read("part"), _on("l_partkey", "p_partkey"))

    def project(table: str) -> DataFrame:
        return source(table).selectExpr(*(f"{sql} as {c}" for c, sql in select_list(table).items()))

    return LazyTables(COLUMNS, project)
