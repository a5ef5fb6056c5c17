from __future__ import annotations

import base64
import gzip
import hashlib
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from brightloom.llm import warc

SCHEMA = "page_id long, url string, html string, key string, digest string, file int, first long, offset string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "k", "d", 1, 2, "o") for r in rows], SCHEMA).repartition(4)


ROWS = [
    (i if i % 29 else None, f"https://{'www.' * (i % 2)}site{i % 5}.example.com:{80 + i % 2}/p/{i % 11}?q=é x\n#f" if i % 7 else None,
     ["same", "", None, f"page {i} é", "x" * 300_000, "same"][i % 6])
    for i in range(200)
] + [(5, "no scheme", "same"), (5, "no scheme", "same"), (1000, "http://hot.example.com/", "\r\n\r\n WARC/1.1")]
ROWS += [(2000 + i, "http://hot.example.com/#x", f"hot {i}") for i in range(90)]


def plain(rows, least):
    payloads = [(r[2] or "").encode() for r in rows]
    first = {}
    for r, p in zip(rows, payloads):
        if len(p) >= least and r[0] is not None:
            first[p] = min(r[0], first.get(p, r[0]))
    out = Counter()
    for r, p in zip(rows, payloads):
        to = first.get(p) if len(p) >= least else None
        to = None if to == r[0] else to
        out[str(r[0]) if r[0] is not None else None, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(),
            "response" if to is None else "revisit", None if to is None else str(to)] += 1
    return out


@pytest.mark.parametrize("least", [0, 1, 10])
def test_pages_come_back(spark, least):
    read = warc.archived_pages(pages_of(spark, ROWS), least)
    got = Counter(tuple(r) for r in read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())
    assert got == plain(ROWS, least)


def test_files_are_plain_warc_and_payloads_are_kept(spark):
    folder, captures = warc.write_archives(pages_of(spark, ROWS), file_bytes=2000)
    files = sorted(Path(folder.removeprefix("file:")).glob("*.warc.gz"))
    assert len(files) > 4
    kinds = Counter()
    for f in files:
        raw = gzip.decompress(f.read_bytes())
        while raw:
            head, _, raw = raw.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            fields = dict(x.split(": ", 1) for x in lines[1:])
            assert lines[0] == "WARC/1.1" and {"WARC-Record-ID", "WARC-Date", "WARC-Type"} <= set(fields)
            size = int(fields["Content-Length"])
            assert raw[size:size + 4] == b"\r\n\r\n"
            raw = raw[size + 4:]
            kinds[fields["WARC-Type"]] += 1
    assert kinds["warcinfo"] == len(files) and kinds["response"] + kinds["revisit"] == len(ROWS)
    read = warc.read_records(folder, captures, with_payload=True).filter("record_type = 'response'")
    assert Counter(bytes(r.payload) for r in read.collect()) == Counter(
        (html or "").encode() for (_, _, html), kind in zip(ROWS, [r[3] for r in _kinds()]) if kind == "response")


def _kinds():
    firsts: dict[bytes, int] = {}
    for i, _, html in ROWS:
        p = (html or "").encode()
        if i is not None:
            firsts[p] = min(i, firsts.get(p, i))
    return [(i, None, html, "response" if firsts.get((html or "").encode()) in (None, i) else "revisit") for i, _, html in ROWS]


def test_index_finds_all_captures_of_a_key(spark):
    """Blocks of two lines, so that keys span blocks and files."""
    folder, captures = warc.write_archives(pages_of(spark, ROWS))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = warc.build_index(folder, captures, block_lines=2)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(index.shards) > 1
    keys = [r[0] for r in captures.select("key").distinct().collect()]
    some = spark.createDataFrame([(k,) for k in [*keys[::2], keys[0], "", "zzz", "com,a", "com,example,hot)/x", None]], "key string")
    got = Counter(map(tuple, warc.search(index, some).collect()))
    assert got == Counter(map(tuple, captures.filter(F.col("key").isin(keys[::2])).collect()))
    assert sum(n for r, n in got.items() if r[0] == "com,example,hot)/") in (0, 91)


def test_url_keys(spark):
    urls = ["http://B.a.Example.com/x/?q=1#f", "https://u:p@a.com:8080", "plain", "", None, "ftp://h/#", "http://[bad"]
    df = spark.createDataFrame([(u,) for u in urls], "url string").select(warc.url_key(F.col("url")))
    assert [r[0] for r in df.collect()] == ["com,example,a,b)/x/?q=1", "com,a:8080)", ")plain", ")", ")", "h)/", "[bad)"]


def test_damaged_record_is_an_error(spark):
    folder, captures = warc.write_archives(pages_of(spark, [(1, "http://a/", "text")]))
    file = next(Path(folder.removeprefix("file:")).glob("*.warc.gz"))
    place = captures.first()
    data = file.read_bytes()
    headers, block = warc.parsed(data[place.offset:place.offset + place.length])
    other = warc.member([(k, v) for k, v in headers.items() if k != "Content-Length"], block.replace(b"text", b"tost"))
    file.write_bytes(data[:place.offset] + other)
    wrong = captures.withColumn("length", F.lit(len(other)).cast("long"))
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read_records(folder, wrong).collect()


def test_empty_table(spark):
    assert warc.archived_pages(pages_of(spark, []).limit(0)).collect() == []
