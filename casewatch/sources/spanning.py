"""Delimited files whose quoted fields go on over line ends, parsed in parallel.

Such a file cannot be cut at any line: whether a line begins a record depends on the
quotes before it. But what a line does to the quote state is known without that state.
Each line is a function from the state at its start to the state at its end, and the
lines of a byte range compose to one such function. The ranges' functions, one small row
each, give the state in which every range begins; then each range puts its lines together
to records from there. Records over a border between ranges are put together from one
fragment per range. Records are parsed by Spark's own parser.

Lines on which that parser's treatment of quotes is not plain, such as a quote after a
backslash inside a quoted field, lead to a third state, `ODD`: files that reach it are
left to a whole-file parse.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: States at the start of a line: a record begins, a quoted field goes on, unknown.
OUT, IN, ODD = 0, 1, 2

# What a quoted field holds, and its end: quotes, then perhaps text up to the separator.
_INSIDE = r'(?:[^"\\]|\\(?:[\s\S]|\z))*+'
_END = r'"++(?:[^"SEP\s\\][^SEP]*+)?'
_FIELD = rf'(?:"{_INSIDE}{_END}|[^"SEP][^SEP]*+|)'
# A line that begins a record: all its fields are closed, or its last one stays open.
_CLOSED = rf"^{_FIELD}(?:SEP{_FIELD})*+\r?\z"
_OPENED = rf'^(?:{_FIELD}SEP)*+"{_INSIDE}\z'
# A line inside a quoted field: all of it is in the field, or the field ends, and then as above.
_KEPT = rf"^{_INSIDE}\z"
_ENDED = rf"^{_INSIDE}{_END}(?:SEP{_FIELD})*+\r?\z"
_REOPENED = rf'^{_INSIDE}{_END}(?:SEP{_FIELD})*+SEP"{_INSIDE}\z'


@dataclass(frozen=True)
class Borders:
    """What is known of a set of files before their records are put together.

    opened: for each byte range (file, start) that begins inside a quoted field, the start
    of the range in which that record begins, and how many lines of the range it has. left:
    for each byte range that ends inside a quoted field, the number of the line at which that
    record begins, if it does so in the range. ended: last ranges of files that end inside a
    quoted field, after a line end. returns: files whose lines end in "\\r\\n". odd: files left
    to a whole-file parse.
    """

    opened: dict[tuple[str, int], tuple[int, int]] = field(default_factory=dict)
    left: dict[tuple[str, int], int] = field(default_factory=dict)
    ended: set[tuple[str, int]] = field(default_factory=set)
    returns: set[str] = field(default_factory=set)
    odd: set[str] = field(default_factory=set)


def _fits(line: Column, pattern: str, separator: str) -> Column:
    return line.rlike(pattern.replace("SEP", "\\" + separator))


def is_closed(line: Column, separator: str) -> Column:
    """Whether a line that begins a record ends it."""
    return ~line.contains('"') | _fits(line, _CLOSED, separator)


def _ends(line: Column, separator: str) -> tuple[Column, Column]:
    """The state at a line's end, for a line that begins a record and for one inside a field."""

    def fits(pattern: str) -> Column:
        return _fits(line, pattern, separator)

    out = F.when(is_closed(line, separator), OUT).when(fits(_OPENED), IN).otherwise(ODD)
    inside = F.when(~line.contains('"') | fits(_KEPT), IN).when(fits(_ENDED), OUT).when(fits(_REOPENED), IN).otherwise(ODD)
    return out, inside


def _lines(spark: SparkSession, paths: list[str], separator: str, encoding: str) -> DataFrame:
    """path, name, range, size, bytes, out, inside, text: each line with what it does to the quote state.

    `size` is the file's, `bytes` the line's with a line end.
    """
    lines = spark.read.option("lineSep", "\n").text(paths)
    place = {"path": "file_path", "name": "file_name", "range": "file_block_start", "size": "file_size"}
    placed = lines.select(
        *(F.col(f"_metadata.{m}").alias(c) for c, m in place.items()),
        (F.octet_length("value") + 1).cast("bigint").alias("bytes"),
        F.decode(F.col("value").cast("binary"), encoding).alias("text"),
    )
    out, inside = _ends(F.col("text"), separator)
    return placed.select(*place, "bytes", out.alias("out"), inside.alias("inside"), "text")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The batches cut where a byte range ends, each with its (path, start)."""
    for batch in batches:
        path, start = batch.column("path"), batch.column("range")
        moved = [pc.not_equal(c.slice(1), c.slice(0, max(0, len(c) - 1))) for c in (path, start)]
        cuts = [0, *(np.flatnonzero(pc.or_(*moved).to_numpy(zero_copy_only=False)) + 1).tolist(), len(path)]
        for at, end in zip(cuts, cuts[1:]):
            if at < end:
                yield (path[at].as_py(), start[at].as_py()), batch.slice(at, end - at)


def _turns(lines: pa.RecordBatch) -> list[tuple[int, int, int]]:
    """(number, out, inside) of the lines that change a state; the others leave both as they are."""
    out, inside = (lines.column(c).to_numpy() for c in ("out", "inside"))
    at = np.flatnonzero((out != OUT) | (inside != IN))
    return list(zip(at.tolist(), out[at].tolist(), inside[at].tolist()))


def borders(spark: SparkSession, paths: list[str], separator: str, encoding: str) -> Borders:
    """One scan in byte ranges; its result is one row per range, no more than the scan has splits.

    Of a range it is noted, for either state at its start, in which state it ends, after how
    many lines a record first ends, and at which line the last one that stays open begins. Only
    lines that change a state are looked at one by one, and no text leaves the JVM.
    """

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, states, closed, left, first, counts, n = None, [], [], [], {}, [], 0

        def row() -> pa.RecordBatch:
            head = (first["odd_head"], first["returned"], first["out"], first["size"])
            return pa.RecordBatch.from_pylist([dict(zip(names, (*now, *states, *closed, *left, *head, *counts, n)))], arrow)

        for place, lines in _runs(batches):
            if place != now:
                if now:
                    yield row()
                now, states, closed, left, counts, n = place, [OUT, IN], [0, None], [None, None], [0, 0], 0
                first = lines.slice(0, 1).to_pylist()[0]
            counts[0] += pc.sum(lines.column("bytes")).as_py()
            counts[1] += pc.sum(pc.invert(lines.column("returned"))).as_py()
            for at, out, inside in _turns(lines):
                for start, state in enumerate(states):
                    if state == OUT:
                        left[start] = n + at
                    states[start] = (out, inside, ODD)[state]
                    if states[start] == OUT and closed[start] is None:
                        closed[start] = n + at + 1
            n += len(lines)
        if now:
            yield row()

    kinds = {
        "path": "string", "range": "bigint", "from_out": "bigint", "from_in": "bigint",
        "closed_out": "bigint", "closed_in": "bigint", "left_out": "bigint", "left_in": "bigint",
        "odd_head": "boolean", "returned": "boolean", "head_end": "bigint", "size": "bigint", "bytes": "bigint", "bare": "bigint", "lines": "bigint",
    }
    names = list(kinds)
    types = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}
    arrow = pa.schema([(n, types[k]) for n, k in kinds.items()])
    text = F.col("text")
    returned = text.endswith("\r")
    bare = F.when(returned, F.left(text, F.length(text) - 1)).otherwise(text)
    lines = _lines(spark, paths, separator, encoding).select(
        "path", "range", "size", "bytes", "out", "inside",
        returned.alias("returned"), ((bare == "") | bare.contains("\r")).alias("odd_head"),
    )
    composed = lines.mapInArrow(compose, ", ".join(f"{n} {k}" for n, k in kinds.items()))
    found, state, origin, total, bare_lines = Borders(), OUT, 0, 0, 0
    ranges = sorted(composed.collect(), key=lambda r: (r.path, r.range))
    for r, after in zip(ranges, [*ranges[1:], None]):
        if r.range == 0:
            state, origin, total, bare_lines = OUT, 0, 0, 0
            if r.odd_head or r.head_end != OUT:
                found.odd.add(r.path)
            if r.returned:
                found.returns.add(r.path)
        if state == IN:
            found.opened[r.path, r.range] = origin, r.lines if r.closed_in is None else r.closed_in
        left = (r.left_out, r.left_in, None)[state]
        state = (r.from_out, r.from_in, ODD)[state]
        if state == IN and left is not None:
            found.left[r.path, r.range] = left
            origin = r.range
        total, bare_lines = total + r.bytes, bare_lines + r.bare
        last_bare = 0 if total == r.size else 1  # a last line without a line end
        if state == ODD or (r.path in found.returns and bare_lines > last_bare):
            found.odd.add(r.path)
        elif state == IN and total == r.size and (after is None or after.path != r.path):
            found.ended.add((r.path, r.range))
    return found


def _without_returns(text: pa.Array) -> pa.Array:
    return pc.if_else(pc.ends_with(text, "\r"), pc.utf8_slice_codeunits(text, 0, -1), text)


def _whole(lines: DataFrame, known: Borders) -> DataFrame:
    """name, record: the records that begin and end in one byte range.

    Files' first lines, their headers, are left out, and so are empty lines between records.
    """
    opened, left, returns = known.opened, known.left, known.returns

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, name, state, n, held = None, "", OUT, 0, []

        def records(*found: pa.Array) -> pa.RecordBatch:
            """The record that is held, then others."""
            first = [] if held in ([], [""]) else ["\n".join(held)]
            every = pa.concat_arrays([pa.array(first, pa.string()), *found])
            return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(name), len(every)), every], ["name", "record"])

        for place, lines in _runs(batches):
            if place != now:
                if held:
                    yield records()
                now, name, state, n, held = place, lines.column("name")[0].as_py(), OUT, 0, []
            begin = opened[place][1] if place in opened else int(place[1] == 0)
            end = min(n + len(lines), left.get(place, n + len(lines)))
            skipped, n = min(len(lines), max(0, begin - n)), n + len(lines)
            lines = lines.slice(skipped, max(0, end - (n - len(lines)) - skipped))
            text = lines.column("text")
            if place[0] in returns:
                text = _without_returns(text)
            begins, since = np.ones(len(text), bool), 0  # since: the line from which on a field is open
            for at, out, inside in _turns(lines):
                after = inside if state == IN else out
                if state == OUT and after == IN:
                    since = at + 1
                elif state == IN and after == OUT:
                    begins[since : at + 1] = False
                state = after
            if state == IN:
                begins[since:] = False
            starts = np.flatnonzero(begins)
            held += text[: starts[0] if len(starts) else len(text)].to_pylist()
            if len(starts):
                several = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), text)
                found = pc.binary_join(several, "\n")
                found = found.filter(pc.or_(pc.greater(pc.list_value_length(several), 1), pc.not_equal(found, "")))
                yield records(found)
                held = text[starts[-1] :].to_pylist()
        if held:
            yield records()

    return lines.select("path", "name", "range", "out", "inside", "text").mapInArrow(assemble, "name string, record string")


def _fragments(lines: DataFrame, known: Borders) -> DataFrame:
    """path, name, origin, range, record: the parts of records that cross ranges, two of a range at most.

    Which lines they are is known; no line's quotes are looked at again.
    """
    opened, left, returns, ended = known.opened, known.left, known.returns, known.ended

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, name, n, goes_on, stays_open = None, "", 0, [], []

        def parts() -> pa.RecordBatch:
            if now in ended:
                (stays_open if now in left else goes_on).append("")
            held = [(opened[now][0], goes_on)] if now in opened else []
            held += [(now[1], stays_open)] if now in left else []
            rows = [
                {"path": now[0], "name": name, "origin": origin, "range": now[1], "record": "\n".join(part)}
                for origin, part in held
                if part not in ([], [""])
            ]
            return pa.RecordBatch.from_pylist(rows, arrow)

        for place, lines in _runs(batches):
            if place != now:
                if now:
                    yield parts()
                now, name, n, goes_on, stays_open = place, lines.column("name")[0].as_py(), 0, [], []
            before = max(0, opened[place][1] - n) if place in opened else 0
            behind = max(0, left.get(place, n + len(lines)) - n)
            n += len(lines)
            for part, of in ((goes_on, slice(0, before)), (stays_open, slice(behind, None))):
                text = lines.column("text")[of]
                part += (_without_returns(text) if place[0] in returns else text).to_pylist()
        if now:
            yield parts()

    kinds = (("path", pa.string()), ("name", pa.string()), ("origin", pa.int64()), ("range", pa.int64()), ("record", pa.string()))
    arrow = pa.schema(kinds)
    schema = "path string, name string, origin bigint, range bigint, record string"
    return lines.select("path", "name", "range", "text").mapInArrow(cut, schema)


def read_spanning(
    spark: SparkSession, paths: list[str], separator: str, encoding: str, columns: list[str], known: Borders, source: str
) -> DataFrame:
    """The records of files that are not odd, all columns strings; `source` holds the file's name.

    `known` is of exactly these files, as their byte ranges depend on how many there are.

    All byte ranges are parsed side by side. Fragments are put together by a shuffle; there is
    at most one for each range that begins inside a field and one for each that ends so.
    """
    lines = _lines(spark, paths, separator, encoding)
    records = _whole(lines, known)
    if known.opened or known.left:
        parts = F.transform(F.sort_array(F.collect_list(F.struct("range", "record"))), lambda p: p["record"])
        joined = _fragments(lines, known).groupBy("path", "name", "origin").agg(F.array_join(parts, "\n").alias("record"))
        records = records.union(joined.select("name", "record"))
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    parsed = F.from_csv("record", schema, {"sep": separator, "mode": "PERMISSIVE"})
    return records.select(F.col("name").alias(source), parsed.alias("parsed")).select("parsed.*", source)
