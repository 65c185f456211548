"""Round trip through real archive files."""

import gzip
import hashlib
import json

import pytest

from strata.llm import warc

SCHEMA = "page_id long, url string, html string, payload string"


def expected(rows):
    out = []
    for page_id, _, html, _ in rows:
        data = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None]
        first = min(same, default=None)
        revisit = len(data) >= 100 and page_id != first
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response",
                    first if revisit else None))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


PAGES = [
    (1, "http://a/1", None, "x"), (2, None, "", "x"), (3, "http://a/3", "<p>é" * 40, "x"),
    (9, "http://a/9", "<p>é" * 40, "x"), (7, "u", "short", "x"), (8, "u", "short", "x"),
    (5, "v\r\nWARC-Type: evil", "a\r\n\r\nWARC/1.1\r\n\r\n" * 20, "x"), (6, "v", "a\r\n\r\nWARC/1.1\r\n\r\n" * 20, "x"),
    (10, "w", "z" * 99, "x"), (11, "w", "z" * 99, "x"), (12, "w", "z" * 100, "x"), (13, "w", "z" * 100, "x"),
    (14, "big", "long " * 700000, "x"), (15, "big", "long " * 700000, "x"), (None, "n", "z" * 100, "x"),
    (3, "http://a/3", "<p>é" * 40, "x")]


def test_round_trip(spark):
    df = spark.createDataFrame(PAGES, SCHEMA).repartition(3)
    assert rows_of(warc.round_trip(df)) == expected(PAGES)


def test_files_index_and_payloads(spark, scratch):
    df = spark.createDataFrame(PAGES, SCHEMA).coalesce(1)
    raw, neat = f"{scratch}/raw", f"{scratch}/neat"
    warc.write_archives(df, raw, records_per_file=5)
    index = warc.normalise(spark, raw, neat)
    rows = index.collect()
    assert len(rows) == len(PAGES) and len({r.path for r in rows}) >= 3
    for r in rows:
        with open(r.path, "rb") as f:
            f.seek(r.offset)
            one = gzip.decompress(f.read(r.length))
        assert one.startswith(b"WARC/1.1\r\n") and one.endswith(b"\r\n\r\n")
        side = [json.loads(x) for x in open(r.path.replace(".warc.gz", ".index.jsonl"))]
        assert side[r.record]["offset"] == r.offset and side[r.record]["length"] == r.length
    by_index, walked = warc.read_archives(spark, neat), warc.read_archives(spark, neat, by_index=False)
    assert rows_of(by_index) == rows_of(walked)
    payloads = {r.page_id: bytes(r.payload) for r in walked.collect() if r.record_type == "response"}
    assert payloads[5].decode() == PAGES[6][2] and payloads[14].decode() == PAGES[12][2]


def test_empty_and_broken(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
    whole = gzip.compress(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n")
    assert [b for _, _, b in warc.split_records(warc._inflated(whole + whole))] == [b"abc", b"abc"]
    with pytest.raises(ValueError):
        list(warc.split_records(warc._inflated(whole[:-12])))
    with pytest.raises(ValueError):
        list(warc.split_records(iter([b"WARC/1.1\r\nContent-Length: 30\r\n\r\nabc"])))
