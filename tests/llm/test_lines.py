"""Line dedup against brute force, and its reversal."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import cuckoo
from tidemark.llm.lines import LineIndex, drop_repeated_lines, references

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = " \t\n\v\f\r"


def brute(docs, least=10):
    order = lambda d: (d is None, d or 0)
    holders = defaultdict(set)
    key = lambda x: x.strip(SPACE).translate(FOLD)
    for d, text in docs:
        for line in (text or "").split("\n"):
            holders[key(line)].add(order(d))
    out = []
    for d, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or min(holders[key(x)]) == order(d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice(["Lorem", "ipsum", "élan", "x"]) for _ in range(rng.randint(1, 5)))
            for _ in range(25)]
    docs = []
    for i in range(80):
        lines = [rng.choice(["", " ", "\t"]) + rng.choice([str.upper, str])(rng.choice(pool))
                 + rng.choice(["", "\r", "\v"]) for _ in range(rng.randint(0, 8))]
        docs.append((i, "\n".join(lines)))
    return docs + [(200, None), (201, ""), (202, "\n\n"), (None, docs[1][1]), (None, "only here, twice"),
                   (None, "only here, twice"), (203, " " + pool[0]), (204, "a" * 200_000)]


@pytest.mark.parametrize("batches", [1, 2, 3])
def test_same_lines_stay_as_by_brute_force(spark, batches):
    docs = corpus(batches)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = drop_repeated_lines(df, batches=batches).select("doc_id", "n_lines", "n_dropped", "kept_text")
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs)


def test_repeated_rows_extra_columns_and_empty_tables(spark):
    text = "a line of text\nb"
    df = spark.createDataFrame([(1, text, "k", 1), (1, text, "l", 2), (2, text, "m", 3)],
                               "doc_id int, text string, key string, row int")
    got = drop_repeated_lines(df, carry=["key", "row"]).collect()
    assert sorted((r["doc_id"], r["kept_text"], r["carried"]["key"]) for r in got) == [
        (1, text, "k"), (1, text, "l"), (2, "b", "m")]
    assert drop_repeated_lines(df.limit(0)).count() == 0


def counts(index):
    return sorted((bytes(r["key"]), r["n"], r["first"], r["last"]) for r in index.counts.collect())


def test_deleting_documents_restores_the_index(spark):
    docs = corpus(4)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    first, second = df.filter("doc_id < 40"), df.filter("doc_id >= 40 AND doc_id < 80")
    base = LineIndex.empty(spark).insert(references(first, 10, 4))
    grown = base.insert(references(second, 10, 4))
    assert counts(grown) == counts(LineIndex.empty(spark).insert(
        references(df.filter("doc_id < 80"), 10, 4)))
    back = grown.delete(second.select("doc_id"))
    assert counts(back) == counts(base)
    # No key that is held may be unknown to the filters.
    held = {(r["shard"], bytes(r["key"])) for r in back.counts.collect()}
    filters = {r["shard"]: [bytes(s) for s in r["segments"]] for r in back.filters.collect()}
    for shard, key in held:
        short = np.frombuffer(key[:8], np.uint64)
        assert cuckoo.contains(filters[shard], short)[0]
    again = back.insert(references(second, 10, 4))
    assert counts(again) == counts(grown)


def test_cuckoo_filters():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    a, b, other = keys[:6000], keys[6000:10_000], keys[10_000:]
    segments = cuckoo.insert([cuckoo.build(a)], b)
    assert cuckoo.contains(segments, keys[:10_000]).all()
    assert cuckoo.contains(segments, other).mean() < 0.01
    left = cuckoo.delete(segments, a[:500])
    assert cuckoo.contains(left, keys[500:10_000]).all()
    assert cuckoo.contains(left, a[:500]).mean() < 0.05
    assert cuckoo.insert([], keys[:0]) == [] and not cuckoo.contains([], a).any()


def test_hash_of_kept_text_is_that_of_the_contract(spark):
    from tidemark.llm.queries import QUERIES
    got = QUERIES["op6_lines"](spark, "/root/testdata/sf0.001")
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
            .select("doc_id", "text").collect()]
    want = sorted((d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute(docs))
    assert sorted(map(tuple, got.select("doc_id", "n_lines", "n_dropped", "kept_sha256")
                      .collect())) == want


def test_many_deletions_lose_no_held_key():
    """A small first batch, larger ones later, and most keys taken out again."""
    keys = np.random.default_rng(8).integers(0, 1 << 63, 12_000).astype(np.uint64)
    segments = []
    for part in np.split(keys, [1500, 4000, 7000]):
        segments = cuckoo.insert(segments, part)
    assert len({len(s) for s in segments}) == 1 and cuckoo.contains(segments, keys).all()
    segments = cuckoo.delete(segments, keys[5000:9000])
    assert cuckoo.contains(segments, keys[:5000]).all()
    assert cuckoo.contains(segments, keys[9000:]).all()


def test_filters_that_outgrow_their_segment_are_rebuilt(spark):
    rows = [(i, f"line number {i} of many\nand another line {i}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    small, large = df.filter("doc_id < 10"), df.filter("doc_id >= 10")
    index = LineIndex.empty(spark).insert(references(small, 10, 2)).insert(references(large, 10, 2))
    assert {len(r["segments"]) for r in index.filters.collect()} == {1}
    back = index.delete(df.filter("doc_id % 2 = 0").select("doc_id"))
    filters = {r["shard"]: [bytes(s) for s in r["segments"]] for r in back.filters.collect()}
    held = back.counts.collect()
    assert len(held) == 600 and all(cuckoo.contains(
        filters[r["shard"]], np.frombuffer(bytes(r["key"])[:8], np.uint64))[0] for r in held)
