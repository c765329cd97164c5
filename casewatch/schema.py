"""Table layouts and code domains of the adverse-event reports."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of the source files that the operators read.
COLUMNS = {
    "demo": [
        "primaryid", "caseid", "caseversion", "fda_dt", "event_dt", "age", "age_cod",
        "sex", "wt", "reporter_country", "occr_country", "mfr_sndr", "occp_cod",
    ],
    "drug": [
        "primaryid", "drug_seq", "role_cod", "drugname", "prod_ai", "route",
        "dose_form", "dose_freq", "dose_amt", "dose_unit",
    ],
    "reac": ["primaryid", "pt"],
    "outc": ["primaryid", "outc_cod"],
    "rpsr": ["primaryid", "rpsr_cod"],
    "ther": ["primaryid", "dsg_drug_seq", "start_dt", "end_dt"],
    "indi": ["primaryid", "indi_drug_seq", "indi_pt"],
}

# Code domains.
ROLES = ["PS", "SS", "C", "I"]
OUTCOMES = ["DE", "LT", "HO", "DS", "CA", "RI", "OT"]
SEXES = ["M", "F", "UNK", "NS"]

PRIMARY_SUSPECT = "PS"
DEATH = "DE"

TABLES = list(COLUMNS)
CHILDREN = [t for t in TABLES if t != "demo"]

# Lineage columns added on ingest; the last two are also the partition columns.
FILE_LINEAGE = ["_source_file", "_ingestion_ts"]
PARTITIONS = ["_year", "_quarter"]


def raw_schema(table: str) -> T.StructType:
    """The all-string schema of a Bronze table, lineage included."""
    fields = [T.StructField(c, T.StringType()) for c in COLUMNS[table]]
    fields += [
        T.StructField("_source_file", T.StringType()),
        T.StructField("_ingestion_ts", T.TimestampType()),
        T.StructField("_year", T.StringType()),
        T.StructField("_quarter", T.StringType()),
    ]
    return T.StructType(fields)


def non_string_columns(schema: T.StructType) -> list[str]:
    """Data columns (no leading underscore) that are not plain strings."""
    return [
        f.name
        for f in schema.fields
        if not f.name.startswith("_") and not isinstance(f.dataType, T.StringType)
    ]


def data_columns(names: list[str]) -> list[str]:
    return [n for n in names if not n.startswith("_")]
