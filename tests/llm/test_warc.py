import gzip
import io
import zlib

import pytest

from roadtally.llm import warc as W
from tests.llm.cases import LONG

PAGES = [
    (1, "http://a.b/c d?x=ü", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "u", None), (4, "u", ""), (5, "", LONG),
    (None, "u", "<p>one</p>"), (1, "u", "<p>one</p>"), (7, "u", "line\r\n\r\nWARC/1.1\r\n"), (8, "u", LONG), (0, "u", "late \U0001f600"),
]


def pages(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumn("payload", F.lit("clash")).withColumn("first", F.lit(0))


def round_trip(spark, rows, **kw):
    archives = W.write_archives(W.with_references(pages(spark, rows)), W.archive_folder(spark), **kw)
    return W.read_archives(archives).collect(), archives


@pytest.mark.parametrize("archive_bytes", [1, 2000, 1 << 26])
def test_round_trip(spark, archive_bytes):
    got, archives = round_trip(spark, PAGES, archive_bytes=archive_bytes)
    assert sum(r.n_records for r in archives.collect()) == len(PAGES) == len(got)
    firsts = {}
    for page_id, _, html in PAGES:
        if page_id is not None:
            firsts[html or ""] = min(firsts.get(html or "", page_id), page_id)
    expected = []
    for page_id, url, html in PAGES:
        first = firsts[html or ""]
        revisit = page_id is not None and page_id != first
        payload = (html or "").encode()
        expected.append((page_id, url, "revisit" if revisit else "response", first if revisit else None, len(payload), None if revisit else payload))
    key = lambda x: repr(x[:4])
    assert sorted([(*r[:5], None if r.payload is None else bytes(r.payload)) for r in got], key=key) == sorted(expected, key=key)


def test_archives_are_read_side_by_side(spark):
    from pyspark.sql import functions as F

    rows = [(i, "u", f"text {i}" * 50) for i in range(24)]
    archives = W.write_archives(W.with_references(pages(spark, rows)), W.archive_folder(spark), archive_bytes=1)
    assert archives.count() == 24
    tasks = W.read_archives(archives).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 20


def test_empty_table(spark):
    got, archives = round_trip(spark, [])
    assert got == [] and archives.count() == 0


def records_of(data):
    return list(W.records(io.BytesIO(data)))


def test_members_are_gzip_and_damage_is_found():
    one = W.record(1, "u", b"abc", 3, W._sha1(b"abc").removeprefix("sha1:"), None)
    two = W.record(2, "u", None, 3, W._sha1(b"abc").removeprefix("sha1:"), 1)
    assert gzip.decompress(one).startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
    assert [r["record_type"] for r in records_of(one + two)] == ["response", "revisit"]
    text = zlib.decompress(one, 31)
    for damaged in (text.replace(b"abc", b"abd"), text.replace(b"Content-Length: 8", b"Content-Length: 7"), text[:-6], b"x" + text):
        with pytest.raises(ValueError):
            records_of(gzip.compress(damaged))
    with pytest.raises(ValueError):
        records_of(one + two[:-9])
    text_two = zlib.decompress(two, 31)
    for misaligned in (gzip.compress(text + text_two), gzip.compress(text[:40]) + gzip.compress(text[40:]), gzip.compress(text + text_two[:30]) + gzip.compress(text_two[30:])):
        with pytest.raises(ValueError, match="member of its own"):
            records_of(misaligned)
    with pytest.raises((ValueError, zlib.error)):
        records_of(one[:50] + b"\x00\x01" + one[52:])
