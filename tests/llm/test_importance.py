"""Importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm import importance
from tidemark.llm.importance import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, runs):
    words = WORD.findall((text or "").translate(FOLD))
    return words, [" ".join(words[i:i + n]) for n in range(1, runs + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, runs, buckets, least=20, percent=10):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in features(t, runs)[1])
    t = Counter(bucket(f) for x in target for f in features(x, runs)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log(
        (t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
    out = []
    for doc_id, text in docs:
        words, found = features(text, runs)
        weight = sum(gain(bucket(f)) for f in found)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(words), len(found), weight, score, None])
    fit = [r for r in out if r[1] >= least]
    fit.sort(key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for i, r in enumerate(fit[: percent * len(fit) // 100]):
        r[5] = i + 1
    return sorted(map(tuple, out), key=repr)


def texts():
    rng = random.Random(3)
    common = ["Alpha", "beta", "naïve", "日本", "x1", "É", " ", "it's", "a-b", "w" * 100]
    docs = [(i, " ".join(rng.choice(common) if rng.random() < .7 else f"w{rng.randrange(500)}"
                         for _ in range(rng.choice([0, 5, 19, 20, 21, 60])))) for i in range(150)]
    docs += [(500, None), (501, ""), (502, "\x00 \x7f --"), (None, "alpha " * 30), (None, None), (7, docs[7][1]),
             (7, docs[7][1]), (600, " ".join(f"long{i % 977}" for i in range(30_000))), (601, "y" * 50_000)]
    return docs, ["alpha beta w1 w2 w3 naïve", None, "日本 É x1", "", "alpha beta"]


@pytest.mark.parametrize("runs", [1, 2, 3])
@pytest.mark.parametrize("head", [5, 20_000])
def test_against_brute_force(spark, rows, runs, head, monkeypatch):
    monkeypatch.setattr(importance, "BLOCK", 1000)
    monkeypatch.setattr(importance, "HELD", 50)
    docs, target = texts()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'c' AS row", "1 AS weight")
    out = resample(df, spark.createDataFrame([(t,) for t in target], "text string"), runs=runs, buckets=997,
                   head_words=head, head_pairs=head)
    assert rows(out) == brute(docs, target, runs, 997)


def test_no_rows(spark, rows):
    empty = spark.createDataFrame([], "doc_id long, text string")
    one = spark.createDataFrame([(1, "a b c " * 10)], "doc_id long, text string")
    assert rows(resample(empty, one)) == []
    assert rows(resample(one, empty)) == brute([(1, "a b c " * 10)], [], 1, 10_000)
