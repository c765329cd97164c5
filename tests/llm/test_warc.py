import base64
import gzip
import hashlib
import uuid

import pytest

from casewatch.llm import warc

from .helpers import tuples

COLUMNS = "page_id bigint, url string, html string, key string, file string, digest string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "e", "e", "e") for r in rows], COLUMNS)


def plain(rows):
    out = []
    for page_id, url, html in rows:
        data = (html or "").encode()
        same = [(p if p is not None else -1, u or "") for p, u, h in rows if (h or "") == (html or "")]
        first = (page_id if page_id is not None else -1, url or "") == max(same)
        last = max(same)[0]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, url, "response" if first else "revisit", len(data), digest, None if first or last < 0 else last))
    return sorted(out, key=repr)


def awkward():
    rows = [(i, f"http://Host{i % 5}.example.com/p{i}?q={i}", f"<p>page {i % 17}") for i in range(120)]
    rows += [(200, None, None), (201, None, ""), (None, "http://a.com/", "<p>lone"), (202, "no scheme\r\nX: y", "é" * 70_000)]
    rows += [(203, "http://a.com/%41\t", "a\r\n\r\nb"), (204, "http://a.com/", "WARC/1.1\r\n\r\n"), (205, "http://u:1/", "x"), (205, "http://u:1/", "x")]
    return rows + [(2**60 + 1, "http://big.com/", "z"), (2**60 + 3, "http://big.com/", "z")]


def test_round_trip(spark, tmp_path):
    rows = awkward()
    table = pages(spark, rows)
    archive = warc.write(table, f"{tmp_path}/{uuid.uuid4().hex}")
    found = warc.fetch(archive, table)
    columns = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"]
    assert tuples(found, *columns) == plain(rows)
    payloads = {(r.page_id, r.url): bytes(r.payload) for r in found.collect() if r.payload is not None}
    assert payloads == {(p, u): (h or "").encode() for p, u, h in rows if (p, u) in payloads}


def test_urls_with_line_ends_beyond_ascii(spark, tmp_path):
    rows = [(i, f"http://a.com/x{c}y", f"<p>{i}") for i, c in enumerate("\x85\u2028\u2029\x0b\x1c\n\r\t%")]
    rows += [(100, "http://b\u2028c.com/", "<p>host"), (101, "\u2029", "<p>no scheme")]
    table = pages(spark, rows)
    found = warc.fetch(warc.write(table, str(tmp_path / "l")), table)
    columns = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"]
    assert tuples(found, *columns) == plain(rows)


def test_many_blocks_and_one_hot_url(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "LINES_PER_BLOCK", 7)
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    rows = [(i, "http://hot.com/" if i % 3 else f"http://s{i}.com/", f"text {i}") for i in range(300)]
    archive = warc.write(pages(spark, rows), str(tmp_path / "a"))
    blocks = spark.read.parquet(archive.directory)
    assert blocks.count() > 40 and blocks.filter("lines > 7").count() == 0
    wanted = spark.createDataFrame([("http://hot.com/",), ("http://s3.com/",), ("http://none.com/",), (None,)], "url string")
    found = tuples(warc.fetch(archive, wanted), "page_id")
    assert found == sorted([(r[0],) for r in rows if r[1] == "http://hot.com/" or r[0] == 3], key=repr)


def test_files_are_gzip_members_in_warc_format(spark, tmp_path):
    warc.write(pages(spark, [(1, "http://a.com/", "<p>a"), (2, "http://b.com/", "<p>a")]), str(tmp_path / "w"))
    data = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(tmp_path.glob("w/warc-*.gz")))
    assert data.count(b"WARC/1.1\r\n") == 2 and data.count(b"WARC-Type: revisit") == 1
    assert data.endswith(b"\r\n\r\n") and b"WARC-Refers-To: <urn:x-page:2>" in data


def test_broken_records_are_refused():
    digest = warc.base32_sha1(b"abc")
    data = warc.record(1, "http://a.com/", b"abc", digest, None, False)
    assert warc.parse(data)["payload"] == b"abc"
    for broken in (data[:-1], data.replace(b"abc", b"abd"), data.replace(b"WARC/1.1", b"WARC/1.0")):
        with pytest.raises(ValueError):
            warc.parse(broken)


def test_url_keys():
    assert warc.url_key("https://www.Example.com:80/a?b") == "com,example,www:80)/a?b"
    assert warc.url_key(None) == "" and warc.url_key("x") == ")x" and warc.url_key("http://") == ")"


def test_empty_table(spark, tmp_path):
    archive = warc.write(pages(spark, []), str(tmp_path / "e"))
    assert tuples(warc.fetch(archive, pages(spark, []))) == []
