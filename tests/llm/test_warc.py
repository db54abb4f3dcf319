"""Round trips through archives, and the merge of runs."""

import base64
import hashlib
import random

from tidemark.llm.staging import Scratch
from tidemark.llm.warc import LoserTree, archive_pages, parse_archive, url_key, write_archives
from tidemark.session import scratch_path

PAGES = [(3, "http://a.example.com/x", "<p>é</p>\r\n\r\nWARC/1.1\r\n\r\n", 1), (1, None, None, 1),
         (2, "https://www.b.example.com:8080/q?z=1#f", "", 1), (5, "http://a.example.com/x/", "<p>é</p>", 1),
         (4, "http://a.example.com/\r\nX: y", "<p>é</p>", 1), (None, "::bad[", "<p>é</p>", 1),
         (7, "http://b.example.com", "z" * 2_000_000, 1), (8, "http://b.example.com", None, 1),
         (9, "http://c.example.com", "twin", 1), (9, "http://c.example.com", "twin", 1)]
SCHEMA = "page_id bigint, url string, html string, digest int"


def test_pages_come_back(spark):
    df = spark.createDataFrame(PAGES, SCHEMA).repartition(4)
    got = archive_pages(df).collect()
    first = {}
    for p, _, html, _ in PAGES:
        if p is not None:
            first[html or ""] = min(p, first.get(html or "", p))
    want = []
    for p, _, html, _ in PAGES:
        data, f = (html or "").encode(), first[html or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((p, len(data), digest) + (("response", None) if p == f else ("revisit", f)))
    keys = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[k] for k in keys) for r in got), key=repr) == sorted(want, key=repr)
    assert sorted(r["place"] for r in got) == list(range(len(PAGES)))
    order = [(r["url_key"], r["captured"], r["page_id"] is None, r["page_id"] or 0)
             for r in sorted(got, key=lambda r: r["place"])]
    assert order == sorted(order)


def test_small_payloads_are_not_revisited(spark):
    df = spark.createDataFrame(PAGES, SCHEMA)
    got = archive_pages(df, least_bytes=100).collect()
    assert {r["record_type"] for r in got} == {"response"}
    assert archive_pages(df.limit(0)).count() == 0


def test_archives_are_well_formed(spark):
    path = scratch_path(spark, "archives")
    write_archives(spark.createDataFrame(PAGES, SCHEMA), path, 0, Scratch(spark, "t"))
    files = spark.read.format("binaryFile").load(path).collect()
    records = [r for f in files for r in parse_archive(bytes(f["content"]))]
    assert len(records) == len(PAGES)
    for headers, block in records:
        assert headers["WARC-Record-ID"].startswith("<urn:uuid:")
        head, _, payload = block.partition(b"\r\n\r\n")
        if headers["WARC-Type"] == "response":
            assert int(head.rpartition(b": ")[2]) == len(payload)
        else:
            assert payload == b"" and "WARC-Refers-To" in headers


def test_loser_tree_merges_runs():
    rng = random.Random(6)
    for k in range(0, 12):
        runs = [sorted(rng.randint(0, 20) for _ in range(rng.randint(0, 9))) for _ in range(k)]
        assert list(LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_url_keys():
    assert url_key("https://www.B.Example.com:8080/Q/?z=1#f") == "com,example,b:8080)/q?z=1"
    assert url_key("http://b.example.com") == "com,example,b)/" and url_key(None) == ")/"
