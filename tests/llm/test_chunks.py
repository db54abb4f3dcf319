"""Exact dedup against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm.chunks import cut, dedupe_texts, normalised

SCHEMA = "doc_id long, text string, row string, hashes long"


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", "", text or "")].append((doc_id, text or ""))
    out = []
    for plain, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        sha = hashlib.sha256(plain.encode()).hexdigest()
        out += [(doc_id, best[0], len(members), sha) for doc_id, _ in members]
    return sorted(out, key=repr)


def documents():
    rng = random.Random(5)
    words = ["alpha", "beta.", "gamma", "délta!", "ε。", "𝄞x", "end.\n", " "]
    long_text = " ".join(rng.choice(words) for _ in range(40_000))
    texts = [None, "", " \t\n", "a b", "ab", "a\nb  ", "A b", " ", long_text, long_text.replace(" ", "\n "),
             long_text[:-1] + "?", "x" * 20_000, "x" * 19_999, "x" * 20_001]
    rows = [(i, t, "clash", 7) for i, t in enumerate(texts)]
    rows += [(100 + i, " ".join(rng.choice(words) for _ in range(rng.choice([3, 400]))), None, None)
             for i in range(60)]
    rows += [(300 + i, rows[40 + i % 5][1].replace(" ", " " * (i % 3 + 1)), "c", 1) for i in range(25)]
    rows += [(None, "a b", "n", 1), (None, None, "n", 1), (3, "a b", "again", 2), (3, "a b", "again", 2)]
    return rows


@pytest.mark.parametrize("hashed", [F.xxhash64, lambda c: F.pmod(F.xxhash64(c), F.lit(3))])
def test_against_brute_force(spark, hashed):
    rows = documents()
    found = dedupe_texts(spark.createDataFrame(rows, SCHEMA), 16, 64, hashed)
    out = found.documents.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out), key=repr) == brute(rows)
    kept = defaultdict(int)
    for r in out:
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}
    # Put together again from the store, every text is the one that was hashed.
    told = {r.row: r.text_sha256 for r in out}
    for row in found.texts().collect():
        assert hashlib.sha256(row.text.encode()).hexdigest() == told[row.row]
    assert found.chunks.count() == found.chunks.select("chunk").distinct().count()
    assert found.chunks.groupBy("hash", "variant").count().filter("count > 1").isEmpty()


def test_each_chunk_is_stored_once(spark):
    text = documents()[8][1]
    docs = spark.createDataFrame([(1, text), (2, "Other beginning. " + text), (3, text)], "doc_id long, text string")
    found = dedupe_texts(docs)
    stored = found.chunks.selectExpr("sum(length(chunk))").first()[0]
    assert stored < 1.1 * len(re.sub(r"[\x20\x09-\x0D]", "", text))


def test_chunks_join_to_the_text(spark):
    df = spark.createDataFrame([(t,) for _, t, *_ in documents()], "text string")
    wrong = df.select(normalised(F.col("text")).alias("t")).filter(
        (F.array_join(cut(F.col("t"), 16, 64), "") != F.col("t"))
        | F.exists(cut(F.col("t"), 16, 64), lambda c: F.char_length(c) > 64))
    assert wrong.isEmpty()


def test_no_rows(spark):
    assert dedupe_texts(spark.createDataFrame([], SCHEMA)).documents.isEmpty()
