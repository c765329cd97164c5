"""Quarterly `$`-delimited text files to the Bronze layer."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F

from casewatch.lazy import side_by_side
from casewatch.schema import COLUMNS, PARTITIONS, TABLES, raw_schema
from casewatch.sources import files, ledger, spanning, tables

# The text format of the source files.
SEPARATOR = "$"
ENCODING = "ISO-8859-1"
EXTENSION = ".txt"


def table_files(spark: SparkSession, raw_dir: str, table: str) -> list[str]:
    """Files of a table: name starts with the table name, any letter case."""
    return [
        f"{raw_dir}/{name}"
        for name in files.names(spark, raw_dir)
        if name.lower().startswith(table.lower()) and name.lower().endswith(EXTENSION)
    ]


def _doubtful_line() -> Column:
    """Whether a line, `value`, alone may make a line-by-line parse differ."""
    line = F.col("value")
    bare = F.replace(line, F.lit("\r"), F.lit(""))
    quoted = line.contains('"')
    returns = F.length(line) - F.length(bare) > F.when(line.endswith("\r"), 1).otherwise(0)
    return (  # few lines need more than the first test of each kind
        (quoted & (line.contains("\\") | ~spanning.is_closed(line, SEPARATOR)))
        | (line.contains("\r") & returns)
        | ((F.ascii(line) <= ord(" ")) & bare.rlike(r"^\s+$"))
    )


def _line_facts() -> dict[str, Column]:
    """What tells, of all lines of a file, whether it is doubtful."""
    return {"doubtful": F.bool_or(_doubtful_line()), "returns": F.count_if(F.col("value").endswith("\r"))}


def _is_doubtful(seen: Row) -> bool:
    return seen.doubtful or seen.returns not in (0, seen.lines)


def doubtful_files(spark: SparkSession, paths: list[str]) -> set[str]:
    """Those of the files that a line-by-line parse might read differently.

    A field that opens with a quote may go on over the line end. Escapes, lone carriage
    returns, mixed line ends and blank lines are read differently too. One distributed
    scan over all files decides, with one row per file as its result.
    """
    lines = spark.read.option("lineSep", "\n").text(paths)
    facts = {"lines": F.count("*")} | _line_facts()
    seen = lines.groupBy(F.col("_metadata.file_path").alias("path")).agg(*(f.alias(n) for n, f in facts.items()))
    return {files.plain(r.path) for r in seen.collect() if _is_doubtful(r)}


def needs_whole_file(spark: SparkSession, path: str) -> bool:
    """Whether records of the file may go on over line ends."""
    return bool(doubtful_files(spark, [path]))


def _read(spark: SparkSession, paths: list[str], multi_line: bool, quote: str) -> DataFrame:
    return spark.read.csv(
        paths,
        sep=SEPARATOR,
        header=True,
        inferSchema=False,
        encoding=ENCODING,
        mode="PERMISSIVE",
        multiLine=multi_line,
        quote=quote,
    )


def read_file(
    spark: SparkSession, path: str, multi_line: bool | None = None, quote: str = '"'
) -> DataFrame:
    """One delimited file, all columns strings, names from its header; as `read_files`."""
    if multi_line is None and quote:
        return reduce(DataFrame.unionByName, read_files(spark, [path]))
    return _read(spark, [path], bool(multi_line), quote)


def read_files(
    spark: SparkSession,
    paths: list[str],
    multi_line: bool | None = None,
    quote: str = '"',
    source: str | None = None,
    doubtful: set[str] | None = None,
) -> list[DataFrame]:
    """Frames that together hold all files: one for each header and way of parsing.

    However many files there are, they are examined by one job, and those that are no
    lines of closed fields by a second one. Files in which quoted fields go on over line
    ends are parsed in byte ranges all the same (`spanning`); only those whose quotes that
    module does not understand are parsed whole, each in one task. multi_line=True parses
    every file so, False every line by itself, and an empty quote takes quotes for text.
    `source` adds a column with the file's name. Files without a line hold nothing. A caller
    that has examined the files passes what `doubtful_files` says of them.
    """
    found = [leaf for path in paths for leaf in files.leaves(spark, path)]
    asks = multi_line is None and quote and found
    if not asks:
        doubtful = set(map(files.plain, found)) if multi_line else set()
    elif doubtful is None:
        doubtful = doubtful_files(spark, found)
    asked = [leaf for leaf in found if files.plain(leaf) in doubtful] if asks else []
    known = spanning.borders(spark, asked, SEPARATOR, ENCODING) if asked else None
    odd = set(map(files.plain, known.odd)) if known else doubtful
    groups: dict[tuple[str, bool, bool], list[str]] = {}
    for leaf in found:
        header = files.first_line(spark, leaf, ENCODING)
        if header is not None:
            groups.setdefault((header, files.plain(leaf) in doubtful, files.plain(leaf) in odd), []).append(leaf)
    frames = []
    for (_, several_lines, whole), group in groups.items():
        if several_lines and not whole:
            columns = _read(spark, group[:1], False, quote).columns
            if len(group) < len(asked):  # fewer files may be cut into other byte ranges
                known = spanning.borders(spark, group, SEPARATOR, ENCODING)
            named = spanning.read_spanning(spark, group, SEPARATOR, ENCODING, columns, known, source or "_source")
            frames.append(named if source else named.drop("_source"))
        else:
            frame = _read(spark, group, whole, quote)
            frames.append(frame.withColumn(source, F.col("_metadata.file_name")) if source else frame)
    return frames


def _with_table_columns(df: DataFrame, table: str) -> DataFrame:
    """The known columns first (NULL when the file lacks one), then any others, in lower case."""
    found = {c.lower(): c for c in df.columns}
    known = [
        F.col(found[c]).alias(c) if c in found else F.lit(None).cast("string").alias(c)
        for c in COLUMNS[table]
    ]
    return df.select(*known, *(F.col(c).alias(low) for low, c in found.items() if low not in COLUMNS[table]))


def bronze_rows(
    spark: SparkSession,
    paths: list[str],
    table: str,
    year: str,
    quarter: str,
    multi_line: bool | None = None,
    doubtful: set[str] | None = None,
) -> DataFrame:
    """All files of one table and quarter, with lineage columns; no files give no rows."""

    found = read_files(spark, paths, multi_line, source="_source_file", doubtful=doubtful)
    frames = [_with_table_columns(df, table) for df in found]
    if not frames:
        return spark.createDataFrame([], raw_schema(table))
    rows = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
    return rows.withColumns(
        {
            "_ingestion_ts": F.current_timestamp(),
            "_year": F.lit(year),
            "_quarter": F.lit(quarter),
        }
    )


def quarter_folder(path: str, year: str, quarter: str) -> str:
    return f"{path}/{PARTITIONS[0]}={year}/{PARTITIONS[1]}={quarter}"


def write_bronze(rows: DataFrame, path: str, year: str, quarter: str) -> int:
    """Replaces one quarter of a Bronze table and returns the row count.

    The quarter's folder is named, not taken from the rows, so that no rows replace the
    old ones too. Other quarters stay. The count is observed during the write, so the
    text is parsed once.
    """
    spark = rows.sparkSession
    ledger.record(spark, path, f"{year}/{quarter}", None)
    tables.record_columns(spark, path, year, quarter, rows)
    written = Observation()
    (
        rows.drop(*PARTITIONS)
        .observe(written, F.count("*").alias("rows"))
        .write.mode("overwrite")
        .parquet(quarter_folder(path, year, quarter))
    )
    files.release_shuffles(spark)
    return written.get["rows"]


def ingest_quarter(
    spark: SparkSession,
    raw_dir: str,
    bronze_dir: str,
    year: str,
    quarter: str,
    multi_line: bool | None = None,
    only: Iterable[str] = TABLES,
) -> dict[str, int]:
    """Rows of the quarter per table; 0 for a table without a file, {} without a directory.

    Tables other than those in `only` are left as they are.

    A table whose files have gone since the last ingest of the quarter loses that
    quarter's rows. A table whose files are all as they were when the quarter was last
    ingested, by name and content, is not written again. One scan of the text makes the
    digests and tells how each file is to be parsed.
    """
    if not files.exists(spark, raw_dir):
        return {}

    def ingest(table: str) -> int:
        paths, target = table_files(spark, raw_dir, table), f"{bronze_dir}/{table}"
        if not paths and not files.exists(spark, quarter_folder(target, year, quarter)):
            return 0
        leaves = [leaf for path in paths for leaf in files.leaves(spark, path)]
        in_order = F.col("value").contains("\r") | _doubtful_line()
        seen = ledger.examine(spark, leaves, in_order, **_line_facts())
        found = {"way": multi_line, "files": ledger.named(spark, leaves, seen, ENCODING)}
        known = ledger.recorded(spark, target, f"{year}/{quarter}")
        stored = files.exists(spark, quarter_folder(target, year, quarter))
        if known and stored and {k: known[k] for k in found} == found:
            return known["rows"]
        doubtful = {path for path, lines in seen.items() if _is_doubtful(lines)}
        parsed = bronze_rows(spark, paths, table, year, quarter, multi_line, doubtful)
        rows = write_bronze(parsed, target, year, quarter)
        ledger.record(spark, target, f"{year}/{quarter}", found | {"rows": rows})
        return rows

    return side_by_side(only, ingest)


def write_delimited(df: DataFrame, path: str) -> None:
    """Text with the separator and header of the source files; NULL is empty, blanks stay."""
    df.write.mode("overwrite").csv(
        path,
        sep=SEPARATOR,
        header=True,
        encoding=ENCODING,
        nullValue="",
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    files.release_shuffles(df.sparkSession)
