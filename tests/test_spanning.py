import os
import random

import pytest
from frames import plan, rows
from pyspark.sql import functions as F

from casewatch.sources import raw, spanning

TOKENS = ["a", "bc", "$", "$", '"', '$"', '"$', "\n", "\n", '"\n', '\n"', "x", "é", '""', " ", "\\", "\r", "\r\n"]


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of 40 bytes, so that records go over many of them."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for name, value in zip(names, ("40", "0")):
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def written(folder, bodies):
    paths = []
    for k, body in enumerate(bodies):
        path = folder / f"f{k:04}.txt"
        path.write_bytes(("h1$h2$h3" + body).encode("ISO-8859-1"))
        paths.append(f"file:{path}")
    return paths


def by_file(df):
    found = {}
    for row in df.collect():
        found.setdefault(row["name"], []).append(tuple(row)[:3])
    return {k: sorted(v, key=repr) for k, v in found.items()}


def whole_parse(spark, paths):
    return raw._read(spark, paths, True, '"').withColumn("name", F.col("_metadata.file_name"))


@pytest.mark.parametrize("seed", [1, 2])
def test_ranges_give_the_rows_of_a_whole_file_parse(spark, tmp_path, small_ranges, seed):
    rng = random.Random(seed)
    bodies = ["\n" + "".join(rng.choice(TOKENS) for _ in range(rng.randrange(3, 50))) for _ in range(200)]
    bodies += [b.replace("\r", "").replace("\n", "\r\n") for b in bodies[:60]] + ["\r" + b for b in bodies[60:80]]
    paths = written(tmp_path, bodies)
    known = spanning.borders(spark, paths, "$", "ISO-8859-1")
    odd = {os.path.basename(p) for p in known.odd}
    clear = [p for p in paths if os.path.basename(p) not in odd]
    assert len(clear) > 80 and known.opened and known.ended and known.returns
    found = spanning.read_spanning(spark, clear, "$", "ISO-8859-1", ["h1", "h2", "h3"], known, "name")
    assert by_file(found) == by_file(whole_parse(spark, clear))


def test_one_open_quote_leaves_a_file_to_as_many_tasks_as_it_has_ranges(spark, tmp_path, small_ranges):
    lines = "".join(f"{k}$value {k}$end\n" for k in range(400))
    clean, opened = written(tmp_path, ["\n" + lines, "\n" + lines.replace("$value 7$", '$"value 7$', 1).replace("$value 300$", '$value 300"$', 1)])
    known = spanning.borders(spark, [opened], "$", "ISO-8859-1")
    assert not known.odd and len(known.opened) > 100
    tasks = [len(raw._read(spark, [p], False, '"').rdd.glom().collect()) for p in (clean, opened)]
    found = spanning.read_spanning(spark, [opened], "$", "ISO-8859-1", ["h1", "h2", "h3"], known, "name")
    ranges = spanning._lines(spark, [opened], "$", "ISO-8859-1").rdd.getNumPartitions()
    assert ranges >= min(tasks) > 100
    assert rows(found.drop("name")) == rows(whole_parse(spark, [opened]).drop("name"))


def test_files_are_read_with_their_own_headers_and_names(spark, tmp_path):
    for name, text in {
        "REAC1.txt": 'primaryid$pt\n1$"two\nlines"\n2$plain\n', "REAC2.txt": "primaryid$pt\n3$x\n",
        "REAC3.txt": 'pt$primaryid\n"a\n\nb"$4\n', "REAC4.txt": "primaryid$pt\r\n5$\"c\r\nd\"\r\n", "REAC5.txt": "",
        "REAC6.txt": 'primaryid$pt\n6$"odd" \\"tail\n',
    }.items():
        (tmp_path / name).write_bytes(text.encode())
    paths = [f"file:{tmp_path}/{n}" for n in sorted(os.listdir(tmp_path))]
    found = raw.bronze_rows(spark, paths, "reac", "2024", "Q1").select("primaryid", "pt", "_source_file")
    wanted = raw.bronze_rows(spark, paths, "reac", "2024", "Q1", multi_line=True).select("primaryid", "pt", "_source_file")
    assert rows(found) == rows(wanted)
    assert ("1", "two\nlines", "REAC1.txt") in rows(found) and ("5", "c\nd", "REAC4.txt") in rows(found)


def test_header_with_a_line_break_and_empty_first_line_are_left_to_the_whole_parse(spark, tmp_path):
    paths = written(tmp_path, ['$"a\nb"\n1$2$3$4\n'])
    (tmp_path / "empty.txt").write_bytes(b"\nh1$h2\n1$\"x\ny\"\n")
    known = spanning.borders(spark, [*paths, f"file:{tmp_path}/empty.txt"], "$", "ISO-8859-1")
    assert len(known.odd) == 2


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("ranges", ["300", "1m"])
def test_records_go_on_over_arrow_batches(spark, tmp_path, small_batches, ranges):
    rng = random.Random(3)
    bodies = ["\n" + "".join(rng.choice(TOKENS) for _ in range(rng.randrange(50, 400))) for _ in range(60)]
    bodies += ['\n1$"' + "x\n" * 200 + '"$2\n3$4$5\n', '\n1$2$3\n4$"' + "\n" * 50]
    paths = written(tmp_path, bodies)
    names = {"spark.sql.files.maxPartitionBytes": ranges, "spark.sql.files.openCostInBytes": "0"}
    before = {n: spark.conf.get(n) for n in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        odd = {os.path.basename(p) for p in spanning.borders(spark, paths, "$", "ISO-8859-1").odd}
        clear = [p for p in paths if os.path.basename(p) not in odd]
        known = spanning.borders(spark, clear, "$", "ISO-8859-1")
        found = by_file(spanning.read_spanning(spark, clear, "$", "ISO-8859-1", ["h1", "h2", "h3"], known, "name"))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert found == by_file(whole_parse(spark, clear)) and len(clear) > 3


def test_quotes_are_looked_at_once_when_records_are_put_together(spark, tmp_path, small_ranges):
    """Records inside a range need the quotes of its lines; the parts of others are found by line numbers."""
    (path,) = written(tmp_path, ['\n1$"a\nb"$2\n' + "3$4$5\n" * 40 + '6$"' + "c\n" * 30 + '"$7\n'])
    known = spanning.borders(spark, [path], "$", "ISO-8859-1")
    assert known.opened and known.left
    found = spanning.read_spanning(spark, [path], "$", "ISO-8859-1", ["h1", "h2", "h3"], known, "name")
    text = plan(found)
    assert text.count("MapInArrow") == 2
    assert sum("RLIKE" in line for line in text.splitlines() if "Project" in line) == 1
    whole = ["\n" + "1$2$3\n" * 20]
    known = spanning.borders(spark, written(tmp_path, whole), "$", "ISO-8859-1")
    found = spanning.read_spanning(spark, written(tmp_path, whole), "$", "ISO-8859-1", ["h1", "h2", "h3"], known, "name")
    assert plan(found).count("MapInArrow") == 1 and found.count() == 20


def test_files_with_other_headers_are_cut_into_their_own_ranges(spark, tmp_path):
    """Alone, a file is cut into smaller ranges than together with others."""
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        for k, header in enumerate(("primaryid$pt", "primaryid$pt$x", "primaryid$pt$y")):
            (tmp_path / f"REAC{k}.txt").write_text(header + "\n" + "".join(f'{i}$"a\n{i}\nb"\n' for i in range(300)))
        paths = [f"file:{tmp_path}/REAC{k}.txt" for k in range(3)]
        found = raw.bronze_rows(spark, paths, "reac", "2024", "Q1").select("primaryid", "pt", "_source_file")
        wanted = raw.bronze_rows(spark, paths, "reac", "2024", "Q1", multi_line=True).select("primaryid", "pt", "_source_file")
        assert rows(found) == rows(wanted)
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
