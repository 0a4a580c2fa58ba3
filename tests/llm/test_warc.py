import gzip
import hashlib
import io
import os

import pytest

from txrisk.llm import warc
from txrisk.llm.common import prepare

SCHEMA = "page_id long, url string, html string, digest string, n int, chunk string, first long, members int"


def expected(rows, least=100):
    first = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= least:
            ids, count = first.get(data, (None, 0))
            first[data] = (min(x for x in (ids, page) if x is not None) if (ids, page) != (None, None) else None, count + 1)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        low = first.get(data, (None, 0))[0]
        refers = low if low is not None and page != low else None
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "response" if refers is None else "revisit", refers))
    return out


def by_page(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, x) for x in r))


ROWS = [
    (3, "http://a/ä\r\nX: y", "é" * 60),
    (1, "http://b", "é" * 60),
    (1, "http://b", "é" * 60),
    (2, None, "x" * 99),
    (4, None, "x" * 99),
    (5, None, None),
    (6, None, ""),
    (7, None, "\r\n\r\nWARC/1.1\r\n" * 20),
    (8, "", "long " * 50_000),
    (9, "", "long " * 50_000),
    (None, "http://c", "é" * 60),
    (None, "http://d", "only without id " * 20),
    (None, "http://d", "only without id " * 20),
]


@pytest.mark.parametrize("chunk_bytes", [7, 1000, 1 << 20])
def test_round_trip(spark, chunk_bytes):
    rows = ROWS if chunk_bytes > 7 else [r for r in ROWS if len(r[2] or "") < 10_000]
    pages = prepare(spark).createDataFrame([(*r, "d", 1, "c", 2, 3) for r in rows], SCHEMA)
    assert by_page(warc.archive_round_trip(pages, chunk_bytes).collect()) == by_page(expected(rows))


def test_whole_table(spark):
    pages = prepare(spark).read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    assert by_page(warc.archive_round_trip(pages).collect()) == by_page(expected(rows))


def test_chunks_carry_running_digests(spark):
    html = "abc" * 1000
    pages = prepare(spark).createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    folder = warc.shared_uri(spark, "warc-test")
    manifest = warc.write_archives(warc.chunk_table(warc.capture_records(pages), 700), folder)
    chunks = sorted(warc.read_archives(manifest, folder, 512).collect(), key=lambda r: r.chunk_no)
    assert [r.chunk_no for r in chunks] == list(range(6))
    assert [r.last for r in chunks] == [False] * 5 + [True]
    data = b""
    for r in chunks:
        assert len(r.chunk) <= 512
        data += bytes(r.chunk)
        assert (r.bytes, r.sha256) == (len(data), hashlib.sha256(data).hexdigest())
    assert data == html.encode()


def test_archives_are_warc_files_of_one_member_per_record(spark):
    pages = prepare(spark).createDataFrame([(i, f"http://x/{i}", "y" * 200) for i in range(3)], "page_id long, url string, html string").coalesce(1)
    folder = warc.shared_uri(spark, "warc-test")
    manifest = warc.write_archives(warc.chunk_table(warc.capture_records(pages)), folder).collect()
    assert sum(r.records for r in manifest) == 3
    heads = []
    for r in manifest:
        assert os.path.getsize(r.path) == r.bytes
        with open(r.path, "rb") as f:
            packed = f.read()
        assert packed.count(b"\x1f\x8b\x08") >= r.records
        text = gzip.decompress(packed)
        heads += [x for x in text.split(b"\r\n") if x.startswith(b"WARC-Type")]
        assert text.endswith(b"\r\n\r\n")
    assert sorted(heads) == [b"WARC-Type: response", b"WARC-Type: revisit", b"WARC-Type: revisit"]


def test_files_that_no_manifest_names_are_not_read(spark):
    pages = prepare(spark).createDataFrame([(1, "u", "z" * 10)], "page_id long, url string, html string")
    folder = warc.shared_uri(spark, "warc-test")
    first = warc.write_archives(warc.chunk_table(warc.capture_records(pages)), folder)
    warc.write_archives(warc.chunk_table(warc.capture_records(pages)), folder)
    assert warc.read_archives(first, folder).count() == 1


def test_broken_archives_are_errors():
    head = warc.record_head(1, None, 5, hashlib.sha256(b"hello").hexdigest(), None, "2020-01-01T00:00:00Z")
    read = lambda data: list(warc.read_chunks(io.BufferedReader(io.BytesIO(data)), 2))
    assert read(head + b"hello\r\n\r\n")[-1]["last"]
    for data in (head + b"hel", head + b"hellO\r\n\r\n", b"nothing of the kind\r\n"):
        with pytest.raises(warc.BrokenArchive):
            read(data)


def test_empty_table(spark):
    pages = prepare(spark).createDataFrame([], SCHEMA)
    assert warc.archive_round_trip(pages).count() == 0
