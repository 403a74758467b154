"""WARC archives: exact round trip, one member per record, index offsets."""

import base64
import gzip
import hashlib
import zlib
from collections import Counter

import pytest

from cellspark.llm import warc

from .conftest import SF

PAGES = [
    (1, "http://a/1", "<p>same</p>"),
    (2, "http://a/2", "<p>same</p>"),
    (3, "http://a/3\r\nWARC-Type: x", "<p>same</p>"),
    (3, "http://a/4", "<p>same</p>"),
    (4, None, None),
    (5, "", ""),
    (6, "http://b/é", "WARC/1.1\r\nContent-Length: 5\r\n\r\n12345\r\n\r\n"),
    (7, "http://b/7", "ü" * 300_000),
    (None, "http://b/8", "<p>same</p>"),
    (None, "http://b/9", "alone"),
    (None, "http://b/9", "alone"),
]


def expected(rows, least=0):
    largest = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= least and page is not None:
            largest[data] = max(largest.get(data, page), page)
    for page, _, html in rows:
        data = (html or "").encode()
        top = largest.get(data)
        revisit = top is not None and (page is None or page < top)
        name = base64.b32encode(hashlib.sha1(data).digest()).decode()
        yield page, len(data), name, "revisit" if revisit else "response", top if revisit else None


def trip(spark, df, folder, **options):
    archives = warc.write(df, folder, **options)
    members = warc.normalise(archives, folder)
    return archives, members, warc.read(members, folder)


@pytest.mark.parametrize("least", [0, 6])
def test_odd_pages(spark, tmp_path, least):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 as payload", "'' as sha1")
    folder = f"file://{tmp_path}/out"
    archives, members, found = trip(spark, df.repartition(2), folder, revisit_bytes=least, archive_bytes=400)
    rows = [tuple(r)[:5] for r in found.collect()]
    assert Counter(rows) == Counter(expected(PAGES, least))
    bodies = {r.page_id: bytes(r.payload) for r in found.filter("record_type = 'response' and page_id is not null").collect()}
    assert bodies[7] == ("ü" * 300_000).encode() and bodies[6] == PAGES[6][2].encode()
    assert members.groupBy().sum("records").first()[0] == len(PAGES)
    for name in (r.archive for r in archives.collect()):  # one gzip member over the whole file
        stream = zlib.decompressobj(31)
        stream.decompress((tmp_path / "out" / name).read_bytes())
        assert stream.eof and not stream.unused_data
    for name in (r.archive for r in members.collect()):  # members tile the file as the index says
        data = (tmp_path / "out" / f"{name}.warc.gz").read_bytes()
        end = 0
        for line in (tmp_path / "out" / f"{name}.idx").read_bytes().splitlines():
            offset, length, record = line.split(b" ", 2)
            assert int(offset) == end
            end += int(length)
            assert b"WARC-Record-ID: " + record in gzip.decompress(data[int(offset) : end])
        assert end == len(data)


def test_pages(spark, tmp_path):
    df = spark.read.parquet(f"{SF}/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in df.collect()]
    found = trip(spark, df, f"file://{tmp_path}/out")[2]
    assert Counter(tuple(r)[:5] for r in found.collect()) == Counter(expected(rows))


def test_empty(spark, tmp_path):
    df = spark.read.parquet(f"{SF}/pages.parquet").limit(0)
    assert trip(spark, df, f"file://{tmp_path}/out")[2].count() == 0


def test_broken_archives_are_errors(spark, tmp_path):
    whole = warc.record(1, "http://a", b"abc", None)
    for name, data in (("cut", whole[:-3]), ("junk", b"no record\r\n\r\n")):
        (tmp_path / f"mono-{name}.warc.gz").write_bytes(gzip.compress(data))
        archives = spark.createDataFrame([(f"mono-{name}.warc.gz",)], "archive string")
        with pytest.raises(Exception, match="inside a record|not a WARC"):
            warc.normalise(archives, f"file://{tmp_path}")
    # several streams in one file are read like one
    (tmp_path / "mono-two.warc.gz").write_bytes(gzip.compress(whole[:50]) + gzip.compress(whole[50:] + whole))
    archives = spark.createDataFrame([("mono-two.warc.gz",)], "archive string")
    members = warc.normalise(archives, f"file://{tmp_path}")
    assert [bytes(r.payload) for r in warc.read(members, f"file://{tmp_path}").collect()] == [b"abc", b"abc"]
