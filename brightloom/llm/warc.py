"""WARC archives of pages, and reading them by range through a two-level capture index.

Writing: every task writes its pages as gzip members into files of its own. File names are new for each attempt,
and only files that a finished task has reported enter the index, so a lost executor leaves at most files that
nothing points to.

Index: one line for each capture, sorted by reversed-host key and cut into compressed blocks; the first keys of
the blocks of a file are its sparse directory, kept at the end of the file. The list of index files, one entry
for each partition, is all that the driver holds.

Reading: a binary search in the list and in one directory gives the blocks that can hold a key, a binary search
in each block its captures, and their records are read by range, neighbours in one read. Captures of a key that
most pages share lie in many blocks, which different tasks search.

Files are reached through ``pyarrow.fs``: ``file``, ``hdfs``, ``s3``, ``s3a`` and ``gs`` paths.
"""

from __future__ import annotations

import base64
import gzip
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator, Sequence
from hashlib import sha1
from typing import NamedTuple
from urllib.parse import quote, unquote

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brightloom.llm.common import written
from brightloom.operators.skew import salted_join
from brightloom.session import scratch_path

#: Lines of an index block.
BLOCK_LINES = 3000
#: A new archive file begins after so many bytes.
FILE_BYTES = 1 << 30
#: Records at most ``GAP`` bytes apart are read together, up to about ``READ_BYTES``.
GAP, READ_BYTES = 1 << 16, 1 << 22
#: Pages carry no time of capture.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*://"
_CAPTURE = "key string, url string, page_id string, record_type string, digest string, file string, offset long, length long"
_COLUMNS = [c.split()[0] for c in _CAPTURE.split(", ")]


def url_key(url: Column) -> Column:
    """Host reversed, then port, path and query, so that pages of a domain are neighbours; a null URL counts as empty."""
    url = F.coalesce(url, F.lit(""))
    host = F.lower(F.regexp_extract(url, f"{_SCHEME}(?:[^/?#@]*@)?([^/?#:]*)", 1))
    port = F.regexp_extract(url, f"{_SCHEME}(?:[^/?#@]*@)?[^/?#:]*(:[0-9]+)", 1)
    rest = F.regexp_replace(F.regexp_replace(url, f"{_SCHEME}[^/?#]*", ""), "(?s)#.*$", "")
    return F.concat(F.array_join(F.reverse(F.split(host, "[.]")), ","), port, F.lit(")"), rest)


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI."""
    uri = re.sub("^s3[an]:", "s3:", re.sub("^([a-z0-9]+):/(?!/)", r"\1:///", uri))
    return fs.FileSystem.from_uri(uri)


class _Output:
    """A file that a task writes, with the number of bytes so far."""

    def __init__(self, folder: str, name: str):
        self.name, self.size = name, 0
        system, path = opened(folder)
        system.create_dir(path, recursive=True)
        self._to = system.open_output_stream(f"{path}/{name}", compression=None)

    def write(self, data: bytes) -> tuple[int, int]:
        begin = self.size
        self._to.write(data)
        self.size += len(data)
        return begin, len(data)

    def close(self) -> None:
        self._to.close()


class _Ranges:
    """Range reads in the files of a folder; the file last used stays open."""

    def __init__(self, folder: str):
        self._system, self._folder = opened(folder)
        self._name, self._from = None, None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self._name:
            self.close()
            self._name, self._from = name, self._system.open_input_file(f"{self._folder}/{name}")
        data = self._from.read_at(length, offset)
        if len(data) != length:
            raise ValueError(f"{name} ends before byte {offset + length}")
        return data

    def close(self) -> None:
        if self._from:
            self._from.close()


def member(headers: Iterable[tuple[str, str | None]], block: bytes) -> bytes:
    """A record as a gzip member. Blanks and control characters in header values are percent-encoded."""
    lines = [f"{k}: {re.sub('[\x00-\x20\x7f]', lambda c: quote(c[0]), v)}" for k, v in headers if v is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", ""])
    return gzip.compress(head.encode() + block + b"\r\n\r\n", 6, mtime=0)


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, json.dumps(parts))}>"


def page_record(page_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str = DATE) -> bytes:
    """A response record, or a revisit record that keeps the HTTP headers and leaves out the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    return member([
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, url, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Page-ID", page_id and quote(page_id)),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To-Page-ID", refers_to and quote(refers_to)),
        ("Content-Type", "application/http;msgtype=response"),
    ], http if revisit else http + payload)


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of the record in a gzip member."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    size = int(headers["Content-Length"])
    if not first.startswith("WARC/") or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    return headers, rest[:size]


def _b32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _archived(folder: str, file_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = None
        for batch in batches:
            rows = []
            for key, url, page_id, html, digest, refers_to in batch[["key", "url", "page_id", "html", "digest", "refers_to"]].itertuples(index=False):
                if out is None or out.size >= file_bytes:
                    if out:
                        out.close()
                    out = _Output(folder, f"pages-{uuid.uuid4().hex}.warc.gz")
                    out.write(member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(out.name)), ("WARC-Date", DATE),
                                      ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                digest = _b32(bytes.fromhex(digest))
                place = out.write(page_record(page_id, url, html.encode(), digest, refers_to))
                rows.append((key, url, page_id, "response" if refers_to is None else "revisit", digest, out.name, *place))
            yield pd.DataFrame(rows, columns=_COLUMNS)
        if out:
            out.close()

    return run


def write_archives(pages: DataFrame, least_bytes: int = 0, file_bytes: int = FILE_BYTES) -> tuple[str, DataFrame]:
    """Write a record for each row of ``page_id, url, html``; the folder, and one capture for each record.

    Of rows whose payloads are equal and have at least ``least_bytes`` bytes, the one with the smallest id is the
    response and the others are revisits. Rows that repeat the smallest id are responses too, rows without an id
    are revisits where an equal payload has one, else responses. A null html is the empty payload. Only rows of
    payloads that occur more than once meet in a join, whose hot payloads are dealt over tasks.
    """
    spark = pages.sparkSession
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))
    wide = rows.filter(F.octet_length("html") >= least_bytes)
    shared = wide.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 AND first IS NOT NULL")
    shared = written(shared, "payloads")
    total = shared.agg(F.sum("n")).first()[0] or 0
    hot = [] if not total else [r[0] for r in shared.filter(F.col("n") * 200 >= total).select(F.xxhash64("digest")).collect()]  # 200 at most
    marked = salted_join(rows, shared.select("digest", "first"), ["digest"], ["page_id", "url"], "left", hot=hot)
    again = (F.octet_length("html") >= least_bytes) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    named = marked.select(
        url_key(F.col("url")).alias("key"), "url", F.col("page_id").cast("string").alias("page_id"), "html", "digest",
        F.when(again, F.col("first").cast("string")).alias("refers_to"))
    folder = scratch_path(spark, "warc")
    return folder, written(named.mapInPandas(_archived(folder, file_bytes), _CAPTURE), "captures")


class Shard(NamedTuple):
    """An index file: its first and last key, and where its directory lies."""

    first: str
    last: str
    file: str
    offset: int
    length: int


class Index(NamedTuple):
    folder: str
    #: In the order of their keys, one for each partition of the sort.
    shards: tuple[Shard, ...]


def _packed(lines: Sequence) -> bytes:
    return gzip.compress("\n".join(json.dumps(x, ensure_ascii=False) for x in lines).encode(), 6, mtime=0)


def _unpacked(data: bytes) -> list[list]:
    return [json.loads(line) for line in zlib.decompress(data, 31).decode().split("\n")]


def _indexed(folder: str, block_lines: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, directory, lines, last = None, [], [], ""

        def flush() -> None:
            directory.append([lines[0][0], *out.write(_packed(lines))])
            lines.clear()

        for batch in batches:
            for line in batch[_COLUMNS].itertuples(index=False):
                out = out or _Output(folder, f"index-{uuid.uuid4().hex}.cdx.gz")
                lines.append([x if x is None or isinstance(x, str) else int(x) for x in line])
                last = line[0]
                if len(lines) == block_lines:
                    flush()
        if out:
            if lines:
                flush()
            place = out.write(_packed(directory))
            out.close()
            yield pd.DataFrame([(directory[0][0], last, out.name, *place)], columns=Shard._fields)

    return run


def build_index(folder: str, captures: DataFrame, block_lines: int = BLOCK_LINES) -> Index:
    """Sort captures by key into index files of compressed blocks, each file with its sparse directory."""
    order = ["key", "page_id", "file", "offset"]
    ranged = captures.repartitionByRange(*order).sortWithinPartitions(*order)
    types = "first string, last string, file string, offset long, length long"
    shards = written(ranged.mapInPandas(_indexed(folder, block_lines), types), "shards").collect()  # one row a partition
    return Index(folder, tuple(sorted((Shard(*r) for r in shards), key=lambda s: (s.first, s.last))))


def _blocks_of(index: Index):
    firsts, lasts = [s.first for s in index.shards], [s.last for s in index.shards]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, held, directory, keys = _Ranges(index.folder), None, [], []
        for batch in batches:
            rows = []
            for key in batch["key"]:
                for shard in index.shards[bisect_left(lasts, key):bisect_right(firsts, key)]:
                    if shard is not held:
                        held, directory = shard, _unpacked(files.read(shard.file, shard.offset, shard.length))
                        keys = [entry[0] for entry in directory]
                    begin = max(0, bisect_left(keys, key) - 1)
                    rows += [(key, shard.file, *entry[1:]) for entry in directory[begin:bisect_right(keys, key)]]
            yield pd.DataFrame(rows, columns=["key", "file", "offset", "length"])
        files.close()

    return run


def _captures_of(folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, held, lines, keys = _Ranges(folder), None, [], []
        for batch in batches:
            rows = []
            for key, *place in batch[["key", "file", "offset", "length"]].itertuples(index=False):
                if place != held:
                    held, lines = place, _unpacked(files.read(*place))
                    keys = [line[0] for line in lines]
                rows += lines[bisect_left(keys, key):bisect_right(keys, key)]
            yield pd.DataFrame(rows, columns=_COLUMNS)
        files.close()

    return run


def search(index: Index, keys: DataFrame) -> DataFrame:
    """All captures of the keys in column ``key``; keys that repeat count once, null and unknown keys give none."""
    wanted = keys.select("key").filter("key IS NOT NULL").distinct()
    near = wanted.repartitionByRange("key").sortWithinPartitions("key")
    blocks = near.mapInPandas(_blocks_of(index), "key string, file string, offset long, length long")
    order = ["file", "offset", "key"]
    ranged = blocks.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.mapInPandas(_captures_of(index.folder), _CAPTURE)


def _runs(places: Iterable[tuple[str, int, int]]) -> Iterator[list[tuple[str, int, int]]]:
    """Neighbours that one read covers."""
    run: list[tuple[str, int, int]] = []
    for place in places:
        if run and (place[0] != run[0][0] or place[1] - (run[-1][1] + run[-1][2]) > GAP or place[1] + place[2] - run[0][1] > READ_BYTES):
            yield run
            run = []
        run.append(place)
    if run:
        yield run


def _records(folder: str, with_payload: bool):
    names = [*_READ, "payload"] if with_payload else _READ

    def row(headers: dict[str, str], block: bytes) -> tuple:
        head, _, payload = block.partition(b"\r\n\r\n")
        size = int(dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])["Content-Length"])
        digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"]
        if kind == "response" and (len(payload) != size or _b32(sha1(payload).digest()) != digest):
            raise ValueError(f"{headers['WARC-Record-ID']}: the payload does not have its digest")
        own, first = (v and unquote(v) for v in (headers.get("WARC-Page-ID"), headers.get("WARC-Refers-To-Page-ID")))
        kept = (own, headers.get("WARC-Target-URI"), kind, size, digest, first)
        return (*kept, payload if kind == "response" else None) if with_payload else kept

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files = _Ranges(folder)
        for batch in batches:
            rows, held = [], 0
            for places in _runs(batch[["file", "offset", "length"]].itertuples(index=False, name=None)):
                begin, end = places[0][1], places[-1][1] + places[-1][2]
                data = files.read(places[0][0], begin, end - begin)
                rows += [row(*parsed(data[offset - begin:offset - begin + length])) for _, offset, length in places]
                held += sum(r[3] for r in rows) if with_payload else 0
                if held > 8 * READ_BYTES:
                    yield pd.DataFrame(rows, columns=names)
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=names)
        files.close()

    return run


_READ = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"]


def read_records(folder: str, captures: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of captures, by range reads: ``page_id, url, record_type, payload_bytes, payload_digest, refers_to``.

    Size and digest of a response are worked out from the payload read, and a record that differs from its own
    digest is an error; a revisit states those of the full payload. ``url`` is the target as the record has it, with
    blanks and control characters percent-encoded. ``with_payload`` adds the payload, null for revisits.
    """
    types = "page_id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string"
    order = ["file", "offset"]
    ranged = captures.select("file", "offset", "length").repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.mapInPandas(_records(folder, with_payload), types + ", payload binary" * with_payload)


def archived_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives, index them, and read every page back by the key of its URL."""
    folder, captures = write_archives(pages, least_bytes)
    index = build_index(folder, captures)
    return read_records(folder, search(index, pages.select(url_key(F.col("url").cast("string")).alias("key"))))


def check_sql(least_bytes: int = 0) -> str:
    """The DuckDB statement for the query over ``pages``."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    quad = " || ".join(f"substr('{letters}', 1 + (v // {32 ** k}) % 32, 1)" for k in (3, 2, 1, 0))
    return f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha1(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= {least_bytes} GROUP BY d),
t AS (SELECT page_id, n, d, CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to FROM p LEFT JOIN f USING (d))
SELECT page_id, n AS payload_bytes, array_to_string(list_transform(list_transform(range(8),
    lambda k: ('0x' || substr(d, 1 + 5 * k, 5))::BIGINT), lambda v: {quad}), '') AS payload_digest,
    CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM t"""
