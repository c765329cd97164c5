"""Which raw files a quarter was ingested from, and what is read again."""

import os

import pytest
from frames import rows
from pyspark.sql import functions as F

from casewatch.sources import files, ledger, raw, tables

LINES = [f"{i}$drug {i}" for i in range(2000)]
HEADER = "primaryid$drugname"


def put(folder, name, lines, header=HEADER):
    os.makedirs(folder, exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n", newline="")


def stored_files(spark, out):
    return files.names(spark, raw.quarter_folder(f"{out}/drug", "2024", "Q1"))


def ingest(spark, tmp_path, **more):
    return raw.ingest_quarter(spark, str(tmp_path / "raw"), str(tmp_path / "bronze"), "2024", "Q1", **more)


def test_a_second_ingest_writes_nothing(spark, tmp_path):
    put(tmp_path / "raw", "DRUG1.txt", LINES)
    put(tmp_path / "raw", "DRUG2.txt", ["9$z"])
    first = ingest(spark, tmp_path)
    before = stored_files(spark, tmp_path / "bronze")
    os.utime(tmp_path / "raw" / "DRUG1.txt", (1, 1))  # copied again, with the same content
    assert ingest(spark, tmp_path) == first and first["drug"] == 2001
    assert stored_files(spark, tmp_path / "bronze") == before


@pytest.mark.parametrize("change", ["line", "more", "header", "gone", "new", "name", "way", "twice"])
def test_any_change_is_ingested(spark, tmp_path, change):
    put(tmp_path / "raw", "DRUG1.txt", LINES)
    put(tmp_path / "raw", "DRUG2.txt", ["9$z"])
    ingest(spark, tmp_path)
    before = stored_files(spark, tmp_path / "bronze")
    more = {}
    if change == "line":
        put(tmp_path / "raw", "DRUG1.txt", [*LINES[:-1], "1999$drug 1998"])
    elif change == "more":
        put(tmp_path / "raw", "DRUG1.txt", [*LINES, "5$new"])
    elif change == "header":
        put(tmp_path / "raw", "DRUG1.txt", LINES, "primaryid$prod_ainm")
    elif change == "gone":
        os.remove(tmp_path / "raw" / "DRUG2.txt")
    elif change == "new":
        put(tmp_path / "raw", "DRUG3.txt", [])
    elif change == "name":
        os.rename(tmp_path / "raw" / "DRUG2.txt", tmp_path / "raw" / "DRUG3.txt")
    elif change == "twice":  # the same lines, one of them twice in another's place: sums tell what a parity would not
        put(tmp_path / "raw", "DRUG1.txt", [*LINES[:-2], LINES[0], LINES[0]])
    else:
        more = {"multi_line": False}
    counts = ingest(spark, tmp_path, **more)
    assert stored_files(spark, tmp_path / "bronze") != before
    stored = tables.read_bronze(spark, str(tmp_path / "bronze" / "drug"))
    expected = raw.bronze_rows(spark, raw.table_files(spark, str(tmp_path / "raw"), "drug"), "drug", "2024", "Q1")
    assert counts["drug"] == expected.count()
    assert rows(stored, "primaryid", "drugname", "_source_file") == rows(expected, "primaryid", "drugname", "_source_file")


def test_order_counts_where_lines_depend_on_their_neighbours(spark, tmp_path):
    for name, lines in (("DRUG1.txt", ['1$"a', 'b"', "2$c"]), ("DRUG2.txt", ["1$a", "2$b"])):
        put(tmp_path, name, lines)

    def digests():
        found = ledger.digests(spark, [str(tmp_path)], "ISO-8859-1", F.col("value").contains('"'))
        return {os.path.basename(path): digest for path, digest in found.items()}

    before = digests()
    put(tmp_path, "DRUG1.txt", ["2$c", '1$"a', 'b"'])
    put(tmp_path, "DRUG2.txt", ["2$b", "1$a"])
    os.utime(tmp_path / "DRUG1.txt", (5, 5))
    after = digests()
    assert after["DRUG1.txt"] != before["DRUG1.txt"] and after["DRUG2.txt"] == before["DRUG2.txt"]


def test_digests_do_not_depend_on_splits(spark, tmp_path):
    put(tmp_path, "DRUG1.txt", LINES)

    def digests():
        return ledger.digests(spark, [str(tmp_path)], "ISO-8859-1", F.lit(False))

    whole = digests()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        assert digests() == whole
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_lost_ingest_is_done_again(spark, tmp_path):
    put(tmp_path / "raw", "DRUG1.txt", LINES)
    ingest(spark, tmp_path)
    path = str(tmp_path / "bronze" / "drug")
    assert ledger.recorded(spark, path, "2024/Q1")["rows"] == 2000
    ledger.record(spark, path, "2024/Q1", None)  # as it is while rows are replaced
    assert ledger.recorded(spark, path, "2024/Q1") is None
    before = stored_files(spark, tmp_path / "bronze")
    assert ingest(spark, tmp_path)["drug"] == 2000
    assert stored_files(spark, tmp_path / "bronze") != before


@pytest.mark.parametrize("way", [None, False])
def test_an_ingest_examines_the_text_once(spark, tmp_path, monkeypatch, way):
    """The scan that makes the digests also tells how files are parsed; quoted line breaks are found by it."""
    put(tmp_path / "raw", "DRUG1.txt", ['1$"a', 'b"', "2$c"])
    put(tmp_path / "raw", "DRUG2.txt", LINES)
    scans = []
    reader = type(spark.read)
    text = reader.text
    monkeypatch.setattr(reader, "text", lambda self, paths, *more, **named: scans.append(paths) or text(self, paths, *more, **named))
    found = ingest(spark, tmp_path, multi_line=way)
    whole = [paths for paths in scans if len(paths) == 2]
    assert len(whole) == 1  # others read only the file with line breaks
    assert found["drug"] == (2002 if way is None else 2003)
