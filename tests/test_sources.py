import os
import re

import pytest
from frames import bronze, plan, rows, strings
from pyspark.sql import functions as F

from casewatch.operators import profile, quality
from casewatch.schema import COLUMNS, TABLES, non_string_columns, raw_schema
from casewatch.sources import files, raw, tables


def write(path, text, encoding="ISO-8859-1"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return str(path)


PLAIN = "primaryid$pt\n1$Caf\xe9\n2$\n3$b\n"
QUOTED = 'primaryid$pt\n1$"two\nlines"\n2$plain\n'


def test_read_plain(spark, tmp_path):
    path = write(tmp_path / "a.txt", PLAIN)
    df = raw.read_file(spark, path)
    assert rows(df) == [("1", "Caf\xe9"), ("2", None), ("3", "b")]
    assert not raw.needs_whole_file(spark, path)


def test_quoted_line_breaks_are_found(spark, tmp_path):
    path = write(tmp_path / "a.txt", QUOTED)
    assert raw.needs_whole_file(spark, path)
    assert rows(raw.read_file(spark, path)) == [("1", "two\nlines"), ("2", "plain")]
    # Read by lines, the break would end the row.
    assert raw.read_file(spark, path, multi_line=False).count() == 3


@pytest.mark.parametrize(
    "body",
    [
        "1$a\r\n2$b\r\n", "1$a\n\n2$b\n", '1$"a"\n2$"b""c"\n', "1$a\n2$b", '1$a "q" b\n', "1$a$extra\n2\n",
        "1$a\n  \n2$b\n", '1$"a\\"\n2$b\n', "1$a\rb\n2$c\n", '1$"open\n2$b\n', '1$5" pipe\n2$b\n', "\r\n1$a\r\n\r\n",
        '1$"a" tail\n2$b\n', "1$ a \n2$\tb\n",
    ],
)
def test_chosen_parse_equals_whole_file_parse(spark, tmp_path, body):
    for i, end in enumerate(("\n", "\r\n")):
        path = write(tmp_path / f"{i}.txt", f"primaryid$pt{end}{body}")
        assert rows(raw.read_file(spark, path)) == rows(raw.read_file(spark, path, multi_line=True))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_regular_files_are_split(spark, tmp_path, end):
    path = write(tmp_path / "a.txt", end.join(["primaryid$pt", "1$a", '2$"b"', "3$c'd", ""]))
    assert not raw.needs_whole_file(spark, path)
    assert rows(raw.read_file(spark, path)) == [("1", "a"), ("2", "b"), ("3", "c'd")]


def test_quote_option_keeps_unbalanced_quotes(spark, tmp_path):
    path = write(tmp_path / "a.txt", 'primaryid$pt\n1$"open\n2$b\n')
    assert rows(raw.read_file(spark, path, multi_line=False, quote="")) == [("1", '"open'), ("2", "b")]


def test_a_stray_quote_leaves_a_file_splittable(spark, tmp_path):
    body = "".join(f"{i}$drug number {i} {'x' * 80}\n" for i in range(40_000)) + '9$5" pipe\n'
    path = write(tmp_path / "a.txt", "primaryid$drugname\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        df = raw.read_file(spark, path)
        assert not raw.needs_whole_file(spark, path) and df.rdd.getNumPartitions() > 1
        assert rows(df) == rows(raw.read_file(spark, path, multi_line=True))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_are_scanned_together(spark, tmp_path):
    """The plan grows with different headers, not with files."""
    for i in range(6):
        write(tmp_path / f"reac{i}.txt", f"primaryid$pt\n{i}$a\n")
    write(tmp_path / "reac6b.txt", 'PT$primaryid\n"two\nlines"$6\n')
    write(tmp_path / "reac7.txt", "")
    paths = raw.table_files(spark, str(tmp_path), "reac")
    assert len(raw.read_files(spark, paths)) == 2
    df = raw.bronze_rows(spark, paths, "reac", "2024", "Q1")
    assert rows(df, "primaryid", "pt", "_source_file") == [(str(i), "a", f"reac{i}.txt") for i in range(6)] + [
        ("6", "two\nlines", "reac6b.txt")
    ]


def test_an_empty_or_vanished_file_replaces_its_quarter(spark, tmp_path):
    make_raw(tmp_path / "raw", drug_names=("a", "b"))
    out, source = str(tmp_path / "bronze"), str(tmp_path / "raw")
    for quarter in ("Q1", "Q2"):
        raw.ingest_quarter(spark, source, out, "2024", quarter)
    write(tmp_path / "raw" / "DRUG24Q1.txt", "primaryid$drug_seq$role_cod$drugname\n")
    os.remove(tmp_path / "raw" / "drug24q1_more.txt")
    os.remove(tmp_path / "raw" / "DEMO24Q1.txt")
    counts = raw.ingest_quarter(spark, source, out, "2024", "Q1")
    assert counts["drug"] == counts["demo"] == 0
    for table, kept in (("drug", 3), ("demo", 1)):
        stored = tables.read_bronze(spark, f"{out}/{table}")
        assert tables.of_quarter(stored, "2024", "Q1").count() == 0
        assert tables.of_quarter(stored, "2024", "Q2").count() == kept


def test_columns_of_all_quarters_are_read(spark, tmp_path):
    for quarter, text in (("Q1", "primaryid$pt\n1$a\n"), ("Q2", "primaryid$pt$Drug_Rec_Act\n2$b$x\n")):
        write(tmp_path / quarter / "REAC.txt", text)
        raw.ingest_quarter(spark, str(tmp_path / quarter), str(tmp_path / "bronze"), "2024", quarter)
    stored = tables.read_bronze(spark, str(tmp_path / "bronze" / "reac"))
    assert rows(stored, "primaryid", "pt", "drug_rec_act") == [("1", "a", None), ("2", "b", "x")]


def test_old_versions_can_be_removed(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(4):
        tables.write_version(strings(spark, ["a"], [(str(i),)]), path, keep_versions=2)
    assert tables.versions(spark, path) == [3, 4]


def test_table_files_by_prefix(spark, tmp_path):
    for name in ("DEMO24Q1.txt", "demo24q2.TXT", "DEMO.csv", "DRUG24Q1.txt"):
        write(tmp_path / name, PLAIN)
    found = [os.path.basename(p) for p in raw.table_files(spark, str(tmp_path), "demo")]
    assert found == ["DEMO24Q1.txt", "demo24q2.TXT"]
    assert raw.table_files(spark, str(tmp_path / "none"), "demo") == []


def make_raw(root, demo="1", drug_names=("a",)):
    write(root / "DEMO24Q1.txt", f"primaryid$caseid$caseversion$lit_ref\n{demo}$c$1$x\n")
    lines = "".join(f"{demo}${i}$PS${n}\n" for i, n in enumerate(drug_names))
    write(root / "DRUG24Q1.txt", f"primaryid$drug_seq$role_cod$drugname\n{lines}")
    write(root / "drug24q1_more.txt", "PRIMARYID$DRUGNAME\n9$z\n")


def test_ingest_is_repeatable(spark, tmp_path):
    make_raw(tmp_path / "raw", drug_names=("a", "b"))
    out = str(tmp_path / "bronze")
    first = raw.ingest_quarter(spark, str(tmp_path / "raw"), out, "2024", "Q1")
    assert first == {t: 0 for t in TABLES} | {"demo": 1, "drug": 3}
    raw.ingest_quarter(spark, str(tmp_path / "raw"), out, "2024", "Q2")
    again = raw.ingest_quarter(spark, str(tmp_path / "raw"), out, "2024", "Q1")
    assert again == first
    drug = tables.read_bronze(spark, f"{out}/drug")
    assert rows(drug.groupBy("_quarter").count()) == [("Q1", 3), ("Q2", 3)]
    assert rows(tables.of_quarter(drug, "2024", "Q1"), "primaryid", "drugname", "_source_file") == [
        ("1", "a", "DRUG24Q1.txt"), ("1", "b", "DRUG24Q1.txt"), ("9", "z", "drug24q1_more.txt"),
    ]
    assert set(COLUMNS["drug"]) <= set(drug.columns)
    assert "lit_ref" in tables.read_bronze(spark, f"{out}/demo").columns
    assert non_string_columns(drug.schema) == []
    assert dict(drug.dtypes)["_year"] == "string" and dict(drug.dtypes)["_ingestion_ts"] == "timestamp"
    assert re.search(r"PartitionFilters: \[[^]]*_year[^]]*_quarter", plan(tables.of_quarter(drug, "2024", "Q2")))
    profiled = profile.layer_profile({"drug": drug}).first()
    assert (profiled["rows"], profiled.partitions, profiled.non_string) == (6, 2, "")


def test_ingest_without_directory(spark, tmp_path):
    assert raw.ingest_quarter(spark, str(tmp_path / "none"), str(tmp_path / "b"), "2024", "Q1") == {}


def test_partition_filter_reads_one_quarter(spark, tmp_path):
    rows_ = [{"primaryid": "1", "pt": "x"}]
    path = str(tmp_path / "reac")
    raw.write_bronze(bronze(spark, "reac", rows_, quarter="Q1"), path, "2024", "Q1")
    raw.write_bronze(bronze(spark, "reac", rows_ * 2, quarter="Q2"), path, "2024", "Q2")
    q2 = tables.of_quarter(tables.read_bronze(spark, path), "2024", "Q2")
    assert q2.count() == 2
    assert len(q2.inputFiles()) > 0 and "PushedFilters: []" in plan(q2)
    assert raw_schema("reac").fieldNames()[:2] == ["primaryid", "pt"]


def test_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.versions(spark, path) == []
    assert tables.write_version(strings(spark, ["a"], [("1",)]), path) == 1
    # The next version may read the current one and change the schema.
    current = tables.read_version(spark, path)
    assert tables.write_version(current.withColumn("b", F.lit(2)), path) == 2
    assert rows(tables.read_version(spark, path)) == [("1", 2)]
    assert rows(tables.read_version(spark, path, 1)) == [("1",)]
    # A write that did not finish is skipped, and its number is not used again.
    os.makedirs(f"{path}/version=3")
    assert tables.versions(spark, path) == [1, 2]
    assert tables.write_version(current, path) == 4


def test_log_accumulates(spark, tmp_path):
    path = str(tmp_path / "log")
    for label in ("r1", "r2"):
        tables.append_log(strings(spark, ["check_name", "run_label"], [("c", label)]), path)
    assert rows(tables.run_labels(spark, path)) == [("r1",), ("r2",)]
    assert quality.with_result(strings(spark, ["table_name", "check_name", "result"], [("t", "c", "FAIL")]), "FAIL").count() == 1


def test_sample_export_round_trip(spark, tmp_path):
    demo = bronze(spark, "demo", [{"primaryid": str(i), "caseid": ""} for i in range(300)]).select("primaryid", "caseid")
    reac = bronze(spark, "reac", [{"primaryid": str(i % 300), "pt": 'q "x" $ y'} for i in range(900)]).select("primaryid", "pt")
    sample = profile.sample_reports({"demo": demo, "reac": reac}, 200)
    out = str(tmp_path / "REAC_SAMPLE")
    raw.write_delimited(sample["reac"], out)
    assert sample["demo"].count() == 200
    back = spark.read.csv(out, sep="$", header=True, encoding="ISO-8859-1")
    assert back.count() == 600 and back.columns == ["primaryid", "pt"]
    assert rows(back) == rows(sample["reac"])


def test_listing(spark, tmp_path):
    assert files.names(spark, str(tmp_path)) == [] and files.exists(spark, str(tmp_path))


def test_columns_are_known_without_reading_footers(spark, tmp_path):
    target = str(tmp_path / "bronze" / "reac")
    first = bronze(spark, "reac", [{"primaryid": "1", "pt": "a"}])
    raw.write_bronze(first, target, "2024", "Q1")
    raw.write_bronze(first.withColumn("extra", F.lit("x")).drop("pt"), target, "2024", "Q2")
    context = spark.sparkContext
    context.setJobGroup("columns", "no job may run")
    found = tables.read_bronze(spark, target)
    assert not context.statusTracker().getJobIdsForGroup("columns")
    context.setJobGroup("other", "")
    assert rows(found, "_quarter", "pt", "extra") == [("Q1", "a", None), ("Q2", None, "x")]
    assert set(found.columns) == set(tables._merged(spark, target, True).columns)
    raw.write_bronze(first, target, "2024", "Q2")
    assert "extra" not in tables.read_bronze(spark, target).columns
    with pytest.raises(ValueError):
        raw.write_bronze(first.withColumn("pt", F.lit(1)), target, "2024", "Q3")


def test_a_table_ingested_before_the_record_keeps_its_columns(spark, tmp_path):
    target = str(tmp_path / "reac")
    first = bronze(spark, "reac", [{"primaryid": "1", "pt": "a"}])
    raw.write_bronze(first.withColumn("extra", F.lit("x")), target, "2024", "Q1")
    files.delete(spark, f"{target}/_columns.json")
    raw.write_bronze(first, target, "2024", "Q2")
    assert rows(tables.read_bronze(spark, target), "_quarter", "extra") == [("Q1", "x"), ("Q2", None)]
