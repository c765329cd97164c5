"""WARC archives with a two-level capture index.

Writing: each page becomes a gzip member of a WARC file. Pages with a payload that another page has
too become revisit records. Index: the captures' reversed-host URL keys are sorted into
compressed blocks, and a sparse directory holds the first and last key of each block.
Reading: URLs find their blocks by binary search in the directory, blocks and then
records are read by byte range.

Tasks write files of their own through pyarrow's file systems, named by partition and
attempt. Only the rows that a finished task returns name its files, so what a lost or
repeated attempt leaves behind is never read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from casewatch.llm.common import checkpoint

# The record format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
PAGE_URN = "urn:x-page:"

LINES_PER_BLOCK, LEVEL, FILE_BYTES, READ_BYTES = 3000, 4, 1 << 30, 8 << 20

CAPTURES = "key string, page_id string, file string, offset bigint, length bigint"
BLOCKS = "first_key string, last_key string, file string, offset bigint, length bigint, lines bigint"
RECORDS = (
    "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, "
    "refers_to bigint, payload binary"
)


@dataclass(frozen=True)
class Archive:
    """A folder with WARC files, index blocks and the directory of the blocks."""

    root: str

    @property
    def directory(self) -> str:
        return f"{self.root}/directory.parquet"


def _files(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """A file system and the path in it; `file:/x` is a way that Hadoop writes `file:///x`."""
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def url_key(url: str | None) -> str:
    """Reversed-host key: https://www.example.com:80/a?b gives `com,example,www:80)/a?b`.

    A null URL has the empty key; one without `://` is its own key behind `)`.
    """
    if url is None:
        return ""
    _, found, rest = url.partition("://")
    if not found:
        return ")" + url
    cut = re.search(r"[/?#]|\Z", rest).start()
    host, colon, port = rest[:cut].lower().partition(":")
    return ",".join(reversed(host.split("."))) + colon + port + ")" + rest[cut:]


def _one_line(text: str) -> str:
    """A header value: controls and the percent sign are percent-encoded."""
    return re.sub(r"[\x00-\x1f%\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _unquoted(text: str) -> str:
    return re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), text)


def _urn(page_id: int | None) -> str:
    return f"<{PAGE_URN}{'none' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One uncompressed record; a revisit has the HTTP head of the full payload and no body."""
    head = HTTP_HEAD.format(len(payload)).encode()
    body = head if revisit else head + payload
    lines = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}"]
    lines += ["WARC-Date: 1970-01-01T00:00:00Z"]  # pages have no time of capture
    lines += [f"WARC-Target-URI: {_one_line(url)}"] if url is not None else []
    lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"] if revisit else []
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response"]
    lines += [f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(lines).encode() + body + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of a record. Raises ValueError where length or digest do not fit."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest, revisit = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"] == "revisit"
    whole = revisit or (len(payload) == size and base32_sha1(payload) == digest)
    if version != VERSION or rest[len(body) :] != b"\r\n\r\n" or not whole:
        raise ValueError(f"broken record {fields.get('WARC-Record-ID')}")

    def page(urn: str) -> int | None:
        number = urn.strip("<>").removeprefix(PAGE_URN)
        return None if number == "none" else int(number)

    url = fields.get("WARC-Target-URI")
    return {
        "page_id": page(fields["WARC-Record-ID"]),
        "url": None if url is None else _unquoted(url),
        "record_type": fields["WARC-Type"],
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": page(fields["WARC-Refers-To"]) if revisit else None,
        "payload": None if revisit else payload,
    }


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class _Writer:
    """Appends compressed members to files of one task and tells where each lies."""

    def __init__(self, root: str, kind: str) -> None:
        task = TaskContext.get()
        self._name = f"{kind}-{task.partitionId():06d}-{task.taskAttemptId()}"
        self._fs, self._root = _files(root)
        self._out, self._number, self._at = None, 0, 0

    def put(self, data: bytes) -> tuple[str, int, int]:
        packed = gzip.compress(data, LEVEL, mtime=0)
        if self._out is None or self._at >= FILE_BYTES:
            self.close()
            self._fs.create_dir(self._root, recursive=True)
            self._file = f"{self._name}-{self._number}.gz"
            self._out, self._at, self._number = self._fs.open_output_stream(f"{self._root}/{self._file}", compression=None), 0, self._number + 1
        at = self._at
        self._out.write(packed)
        self._at += len(packed)
        return self._file, at, len(packed)

    def close(self) -> None:
        if self._out is not None:
            self._out.close()
            self._out = None


class _Ranges:
    """Reads compressed members by byte range; keeps the last file open and the last range."""

    def __init__(self, root: str) -> None:
        self._fs, self._root = _files(root)
        self._name = self._open = self._spot = self._data = None

    def get(self, file: str, offset: int, length: int) -> bytes:
        if self._spot != (file, offset):
            if self._name != file:
                if self._open is not None:
                    self._open.close()
                self._open, self._name = self._fs.open_input_file(f"{self._root}/{file}"), file
            self._data = zlib.decompress(self._open.read_at(length, offset), wbits=31)
            self._spot = (file, offset)
        return self._data


def _decided(pages: DataFrame) -> DataFrame:
    """page_id, url, html, and for payloads that repeat the page with the largest id.

    Only digests go through the aggregation, and only repeated ones into the join.
    """
    rows = pages.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    last = F.max(F.struct("page_id", "url"))
    repeated = rows.groupBy("digest", F.length("digest").alias("width")).agg(last.alias("last"), F.count("*").alias("n"))
    return rows.join(repeated.filter("n > 1").drop("width", "n"), "digest", "left").select(
        "page_id",
        "url",
        "html",
        F.col("last.page_id").alias("refers_to"),
        (F.col("last").isNotNull() & ~F.struct("page_id", "url").eqNullSafe(F.col("last"))).alias("revisit"),
    )


def write(pages: DataFrame, root: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> Archive:
    """Writes pages to WARC files and their index below `root`, a folder that all machines share.

    Of pages with equal payloads the one with the largest page_id is the response (of
    equal ids the one with the largest URL), the others are revisits of it; rows repeated
    whole are the same record, written again. A null html is an empty payload, a null
    url has no target URI, a null page_id is the smallest. Only the named columns are read.
    """
    archive = Archive(root)
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"), F.coalesce(html, F.lit("")).alias("html")
    )

    def write_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = _Writer(root, "warc")
        for batch in batches:
            found = []
            for row in batch.itertuples(index=False):
                number = None if row.page_id is None else int(row.page_id)
                refers_to = None if row.refers_to is None else int(row.refers_to)
                payload = row.html.encode()
                data = record(number, row.url, payload, base32_sha1(payload), refers_to, row.revisit)
                found.append((url_key(row.url), row.page_id, *out.put(data)))
            yield _frame(found, ["key", "page_id", "file", "offset", "length"])
        out.close()

    def write_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, held = _Writer(root, "cdx"), []

        def block(rows: list[tuple]) -> tuple:
            lines = "".join("\t".join([_one_line(r[0]), r[1] or "", r[2], str(r[3]), str(r[4])]) + "\n" for r in rows)
            return (rows[0][0], rows[-1][0], *out.put(lines.encode()), len(rows))

        names = ["first_key", "last_key", "file", "offset", "length", "lines"]
        for batch in batches:
            held += [(r.key, r.page_id, r.file, r.offset, r.length) for r in batch.itertuples(index=False)]
            full = len(held) // LINES_PER_BLOCK * LINES_PER_BLOCK
            yield _frame([block(held[i : i + LINES_PER_BLOCK]) for i in range(0, full, LINES_PER_BLOCK)], names)
            held = held[full:]
        yield _frame([block(held)] if held else [], names)
        out.close()

    # ids travel as text: in pandas, numbers with a null among them would become doubles
    texts = {c: F.col(c).cast("string") for c in ("page_id", "refers_to")}
    captures = checkpoint(_decided(rows).withColumns(texts).mapInPandas(write_records, CAPTURES))
    order = ["key", "page_id", "file", "offset"]
    sorted_captures = captures.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = checkpoint(sorted_captures.mapInPandas(write_blocks, BLOCKS))
    blocks.sort("first_key", "last_key", "file", "offset").write.mode("overwrite").parquet(archive.directory)
    return archive


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame({n: pd.Series([r[i] for r in rows], dtype=object) for i, n in enumerate(names)})


def _blocks_of(directory: str):
    """Maps batches of sorted keys to the index blocks that may hold them."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = _files(directory)
        for batch in batches:
            if batch.empty:
                continue
            keys = sorted(batch["key"])
            near = [("last_key", ">=", keys[0]), ("first_key", "<=", keys[-1])]
            part = pq.read_table(path, filesystem=fs, filters=near).to_pandas().sort_values(["first_key", "last_key"])
            firsts, lasts = part["first_key"].tolist(), part["last_key"].tolist()
            low = np.searchsorted(np.array(lasts, dtype=object), np.array(keys, dtype=object), "left")
            high = np.searchsorted(np.array(firsts, dtype=object), np.array(keys, dtype=object), "right")
            place = list(part[["file", "offset", "length"]].itertuples(index=False, name=None))
            found = [(k, *place[i]) for k, a, b in zip(keys, low, high) for i in range(a, b)]
            yield _frame(found, ["key", "file", "offset", "length"])

    return find


def _captures_in(root: str):
    """Maps (key, block) rows, sorted by block, to the captures of these keys."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranges = _Ranges(root)
        for batch in batches:
            found = []
            for (file, offset, length), asked in batch.groupby(["file", "offset", "length"], sort=False)["key"]:
                keys = set(asked)
                for line in ranges.get(file, int(offset), int(length)).decode().removesuffix("\n").split("\n"):  # other line ends may be in a key
                    key, page_id, *place = line.split("\t")
                    if (key := _unquoted(key)) in keys:
                        found.append((key, page_id or None, place[0], int(place[1]), int(place[2])))
            yield _frame(found, ["key", "page_id", "file", "offset", "length"])

    return read


def _records_at(root: str, payloads: bool):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranges = _Ranges(root)
        names = [c.split()[0] for c in RECORDS.split(", ")]
        for batch in batches:
            found = [parse(ranges.get(r.file, int(r.offset), int(r.length))) for r in batch.itertuples(index=False)]
            yield _frame([tuple(f[n] if n != "payload" or payloads else None for n in names) for f in found], names)

    return read


def fetch(archive: Archive, urls: DataFrame, url: str = "url", payloads: bool = True) -> DataFrame:
    """All records of the given URLs: page_id, url, record_type, payload_bytes, payload_digest,
    refers_to, and payload (null for revisits, or if payloads is False).

    A URL counts once however often it is given; null finds pages without a URL. URLs
    that were not captured find nothing. Keys, blocks and records are each read in
    tasks of bounded size, also where one URL has very many captures.
    """
    keys_of = F.pandas_udf(lambda batch: pd.Series([url_key(u) for u in batch], dtype=object), T.StringType())
    keys = urls.select(F.col(url).alias("url")).distinct().select(keys_of("url").alias("key")).distinct()
    sorted_keys = checkpoint(keys).repartitionByRange("key").sortWithinPartitions("key")
    place = "file string, offset bigint, length bigint"
    blocks = sorted_keys.mapInPandas(_blocks_of(archive.directory), f"key string, {place}")
    by_block = blocks.repartition("file", "offset").sortWithinPartitions("file", "offset")
    captures = checkpoint(by_block.mapInPandas(_captures_in(archive.root), CAPTURES))
    # by the bytes to be read, which the rows' own size does not tell
    tasks = max(1, -(-(captures.agg(F.sum("length")).first()[0] or 0) // READ_BYTES))
    by_range = captures.withColumn("stretch", F.floor(F.col("offset") / READ_BYTES)).repartition(tasks, "file", "stretch")
    ordered = by_range.sortWithinPartitions("file", "offset").drop("stretch")
    return ordered.mapInPandas(_records_at(archive.root, payloads), RECORDS)
