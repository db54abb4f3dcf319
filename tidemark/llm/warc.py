"""WARC archives of pages: written, read back, and indexed in one global order.

Every record's index line goes into a run that is sorted where the archive was read. Ranges of
the global order then merge their part of all runs with a loser tree.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from base64 import b32encode
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta, timezone
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.staging import Scratch, picked
from tidemark.session import scratch_path

# Fixed values of the format.
VERSION = "WARC/1.1"
LINE, BREAK = "\r\n", "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
#: Pages have no capture time; this one and the id in seconds stand for it.
FIRST_CAPTURE = "2024-01-01 00:00:00"
#: Bytes of payload in an archive, and rows of the index in a merged range, about.
ARCHIVE_BYTES, RANGE_ROWS = 16 << 20, 20_000


def base32_sha1(payload: Column) -> Column:
    """The bare upper-case base32 form of a payload's SHA-1."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _clean(url: Column) -> Column:
    """A header's value has no line breaks."""
    return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _record_id(digest: Column, page_id: Column) -> Column:
    h = F.md5(F.concat_ws(":", digest, page_id.cast("string")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _revisits(rows: DataFrame, least_bytes: int) -> DataFrame:
    """``(key, digest, first)`` of the pages that revisit another, without their payloads.

    Digests are folded before they are shuffled.
    """
    # An id of NULL comes after all others.
    first = F.min(F.struct(F.col("page_id").isNull(), "page_id"))["page_id"]
    slim = rows.select("key", "page_id", "digest", "size").filter(F.col("size") >= least_bytes)
    firsts = slim.groupBy("digest").agg(first.alias("first"))
    return (slim.join(firsts, "digest").filter(~F.col("page_id").eqNullSafe(F.col("first")))
            .select("key", "digest", "first").distinct())


def records(pages: DataFrame, scratch: Scratch, least_bytes: int, files: int) -> DataFrame:
    """One record per page: ``record`` is its text up to the closing break.

    Of pages with equal payloads of ``least_bytes`` or more, the one with the smallest id holds
    the payload; the others revisit it. Who does is decided on ids and digests; payloads are shuffled
    once, into as many partitions as there will be ``files``, where the decisions meet them.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = picked(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("size"), base32_sha1(payload).alias("digest"))
    rows = rows.withColumn("key", F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    revisits = scratch.write(_revisits(rows, least_bytes), "revisits")
    rows = (rows.repartition(files, "key", "digest")
            .join(revisits.repartition(files, "key", "digest").hint("merge"), ["key", "digest"], "left"))
    revisit = F.col("first").isNotNull()
    date = F.date_format(F.timestamp_seconds(F.unix_timestamp(F.lit(FIRST_CAPTURE))
                                             + F.coalesce("page_id", F.lit(0))),
                         "yyyy-MM-dd'T'HH:mm:ss'Z'")
    header = lambda name, value: F.when(value.isNotNull(), F.concat(
        F.lit(f"{name}: "), value, F.lit(LINE)))
    http = F.concat(F.lit(HTTP), F.lit("Content-Length: "), F.col("size").cast("string"),
                    F.lit(BREAK))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    text = F.concat_ws(
        "", F.lit(VERSION + LINE),
        header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        header("WARC-Record-ID", _record_id(F.col("digest"), F.col("page_id"))),
        header("WARC-Date", date), header("WARC-Target-URI", _clean(F.col("url"))),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        header("WARC-Refers-To", F.when(revisit, _record_id(F.col("digest"), F.col("first")))),
        header("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        header("X-Page-ID", F.col("page_id").cast("string")),
        header("X-Refers-To-Page-ID", F.when(revisit, F.col("first").cast("string"))),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", F.octet_length(block).cast("string")), F.lit(LINE), block)
    return rows.select(text.alias("record"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0,
                   scratch: Scratch | None = None) -> None:
    """Writes ``pages(page_id, url, html)`` as gzipped WARC files below ``path``.

    The text writer closes each record with the two line breaks that the format asks for.
    Records are spread by id over as many files as their bytes need.
    """
    scratch = scratch or Scratch(pages.sparkSession, "warc")
    total = pages.agg(F.sum(F.octet_length("html")), F.count(F.lit(1))).first()
    files = max(1, (total[0] or 0) // ARCHIVE_BYTES, total[1] // 50_000)
    (records(pages, scratch, least_bytes, files).select(F.col("record").alias("value"))
     .write.option("lineSep", BREAK).option("compression", "gzip").text(path))
    scratch.release("revisits")


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an archive, plain or gzipped."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split(LINE)
        if lines[0] != VERSION:
            raise ValueError(f"no record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        size = int(headers["Content-Length"])
        yield headers, data[end + 4:end + 4 + size]
        at = end + 4 + size + 4


def url_key(url: str | None) -> str:
    """The host's parts from the top, then port, path and query, without scheme and fragment."""
    try:
        parts = urlsplit(url or "")
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return (url or "").lower()
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port not in (None, 80, 443) else "")
    path = re.sub(r"/+$", "", parts.path) or "/"
    return f"{key}){path}{'?' + parts.query if parts.query else ''}".lower()


INDEX = ("run string, url_key string, captured string, page_id bigint, url string, "
         "record_type string, payload_digest string, payload_bytes bigint, refers_to bigint, "
         "offset bigint")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted run of each archive; the digest of a response is that of what was read."""
    names = [f.split()[0] for f in INDEX.split(", ")]
    kinds = [pa.int64() if f.endswith("bigint") else pa.string() for f in INDEX.split(", ")]
    for batch in batches:
        for run, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows, offset = [], 0
            for headers, block in parse_archive(content.as_buffer().to_pybytes()):
                payload = block[block.index(b"\r\n\r\n") + 4:]
                response = headers["WARC-Type"] == "response"
                digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                if response:
                    digest = b32encode(hashlib.sha1(payload).digest()).decode()
                number = lambda name: int(headers[name]) if name in headers else None
                url = headers.get("WARC-Target-URI")
                rows.append((run, url_key(url), headers["WARC-Date"], number("X-Page-ID"), url,
                             headers["WARC-Type"], digest, len(payload) if response else None,
                             number("X-Refers-To-Page-ID"), offset))
                offset += 1
            rows.sort(key=_order)
            for at in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows[at:at + 10_000]), kinds)], names=names)


def _order(row: tuple) -> tuple:
    """URL key, time, then the id, NULL last."""
    return row[1], row[2], row[3] is None, row[3] or 0


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the winner moves up."""

    def __init__(self, runs: Sequence[Sequence[tuple]], key):
        self.iterators = [iter(r) for r in runs]
        self.key, self.k = key, max(1, len(runs))
        self.heads = [self._next(i) for i in range(len(runs))] or [None]
        self.losers = [-1] * self.k
        self.winner = self._play(1) if self.k > 1 else 0

    def _next(self, i: int):
        row = next(self.iterators[i], None)
        return None if row is None else (self.key(row), row)

    def _beats(self, i: int, j: int) -> bool:
        a, b = self.heads[i], self.heads[j]
        if a is None or b is None:
            return b is None and (a is not None or i < j)
        return (a[0], i) < (b[0], j)

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        left, right = self._play(2 * node), self._play(2 * node + 1)
        won, lost = (left, right) if self._beats(left, right) else (right, left)
        self.losers[node] = lost
        return won

    def __iter__(self) -> Iterator[tuple]:
        while self.heads[self.winner] is not None:
            i = self.winner
            yield self.heads[i][1]
            self.heads[i] = self._next(i)
            node = (i + self.k) // 2
            while node:
                if self._beats(self.losers[node], i):
                    i, self.losers[node] = self.losers[node], i
                node //= 2
            self.winner = i


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of the global order: its slices of all runs, merged.

    A run's rows come in their order, but for the seam between two blocks of it: where the order
    falls back, the next slice begins.
    """
    slices: dict[str, list[list[tuple]]] = {}
    schema = None
    for batch in batches:
        schema = batch.schema
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            own = slices.setdefault(row[0], [])
            if own and _order(own[-1][-1]) <= _order(row):
                own[-1].append(row)
            else:
                own.append([row])
    if schema is None:
        return
    out: list[tuple] = []
    for row in LoserTree([s for _, own in sorted(slices.items()) for s in own], _order):
        out.append(row)
        if len(out) == 10_000:
            yield _as_batch(out, schema)
            out = []
    if out:
        yield _as_batch(out, schema)


def _as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def read_archives(spark, path: str, scratch: Scratch) -> DataFrame:
    """The index of all records below ``path``, in ranges that follow the global order.

    Archives are bounded in size and read one at a time by a task. Ranges are cut by URL key,
    time and id together, so a URL that is captured very often is spread over several.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    runs = scratch.write(files.mapInArrow(_read, INDEX), "runs")
    n = runs.count()
    ranges = max(1, n // RANGE_ROWS)
    return (runs.repartitionByRange(min(ranges, 100_000), "url_key", "captured",
                                    F.col("page_id").asc_nulls_last())
            .mapInArrow(_merge, INDEX))


def capture_histories(index: DataFrame, scratch: Scratch) -> DataFrame:
    """The index with ``place``, each capture's number in the global order, and resolved revisits.

    Ranges are written one file each in their order; counts per range give the offsets.
    """
    kept = index.withColumns({"range": F.spark_partition_id(),
                              "at": F.monotonically_increasing_id().bitwiseAND(
                                  F.lit((1 << 33) - 1))})
    kept = scratch.write(kept, "merged")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (kept.groupBy("range").agg(F.count(F.lit(1)).alias("rows"))
               .select("range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before")))
    offsets = scratch.write(offsets, "offsets")
    sizes = scratch.write(kept.filter("record_type = 'response'").select(
        F.col("payload_digest"), F.col("payload_bytes").alias("full_bytes")).distinct(), "sizes")
    return (kept.join(offsets, "range").join(sizes, "payload_digest", "left")
            .withColumn("place", F.col("before") + F.col("at")))


def archive_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes ``pages(page_id, url, html)`` as WARC archives and reads them back.

    Other columns are ignored. Returns a row per page: ``page_id, payload_bytes, payload_digest,
    record_type, refers_to, url_key, captured, place``. Of equal payloads of ``least_bytes`` or
    more, the page with the smallest id is a response and the others are revisits, whose size
    comes from the response that they refer to; rows alike in id and payload are all responses.
    NULL html is an empty payload, a NULL url has no target header, a NULL id comes last. The
    archives stay in the shared folder. No rows give no rows.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    path = scratch_path(pages.sparkSession, "warc-archives")
    write_archives(pages, path, least_bytes, scratch)
    found = capture_histories(read_archives(pages.sparkSession, path, scratch), scratch)
    return found.select(
        "page_id", F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"),
        "payload_digest", "record_type", "refers_to", "url_key", "captured", "place")
