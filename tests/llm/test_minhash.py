"""Near duplicates against a brute-force comparison of all sets."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import minhash
from tidemark.llm.graph import components
from tidemark.llm.minhash import band_keys, minima, near_duplicates, packed_bits
from tidemark.llm.shingles import shingle_set, word_hashes
from tidemark.llm.staging import Scratch


def sets(text, n):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(fold))
    if not words:
        return set()
    n = min(n, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def brute(docs, n):
    """Size, component and kept per (id, text); ids are distinct or NULL."""
    known = [(d, sets(t, n)) for d, t in docs if d is not None]
    label = {d: d for d, _ in known}
    changed = True
    links = [(a, b) for i, (a, x) in enumerate(known) for b, y in known[i + 1:]
             if x and y and 100 * len(x & y) >= 80 * len(x | y)]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return sorted(((d, len(sets(t, n)), label.get(d), d is None or label[d] == d)
                   for d, t in docs), key=repr)


def corpus(seed, n_docs=150):
    rng = random.Random(seed)
    words = ["the", "of", "and", "é", "Ünit", "b!", "c", "d", "e", "f", "x1"]
    text = lambda k: [rng.choice(words) + str(rng.randint(0, 9)) for _ in range(k)]
    bases = [text(rng.randint(5, 60)) for _ in range(12)]
    docs = []
    for i in range(n_docs):
        w = list(rng.choice(bases)) if rng.random() < .8 else text(rng.randint(1, 40))
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = rng.choice(words)
        docs.append((i, rng.choice([" ", "\n", "\t "]).join(w)))
    return docs + [(1000, None), (1001, " \n"), (1002, "one"), (1003, "ONE "), (1004, "one "),
                   (None, docs[0][1]), (None, None)]


@pytest.mark.parametrize("n", [2, 5])
def test_components_are_those_of_brute_force(spark, rows, n):
    docs = corpus(n)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    assert sorted(map(tuple, near_duplicates(df, n).collect()), key=repr) == brute(docs, n)


def test_group_of_many_near_copies_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_NODES", 4)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(40)]
    docs = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(40)] = f"z{rng.randint(0, 3)}"
        docs.append((i, " ".join(w)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert sorted(map(tuple, near_duplicates(df, 2).collect()), key=repr) == brute(docs, 2)


def test_repeated_rows_extra_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(7, "a b c", "x", 1), (7, "a b c", "y", 2), (9, "a b c", "z", 3)],
                               "doc_id int, text string, digest string, node int")
    got = sorted(map(tuple, near_duplicates(df, 2).collect()))
    assert got == [(7, 2, 7, True), (7, 2, 7, True), (9, 2, 7, False)]
    assert near_duplicates(df.limit(0)).count() == 0


def test_estimate_is_close_and_bits_are_packed(spark):
    rng = np.random.default_rng(3)
    pool = rng.integers(1, 1 << 62, 4000).astype(np.uint64)
    factors = minhash._constants()
    for share in (0.3, 0.6, 0.8, 0.95):
        common = int(2000 * share / (1 + share) * 1)
        a, b = np.sort(pool[:1000 + common]), np.sort(pool[1000:2000 + common])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        sig = [packed_bits(minima(x, factors)).tolist() for x in (a, b)]
        df = spark.createDataFrame([tuple(sig)], "a array<bigint>, b array<bigint>")
        agree = df.select(minhash.agreement(F.col("a"), F.col("b"))).first()[0]
        chance = 2.0 ** -minhash.BITS
        assert abs((agree / minhash.HASHES - chance) / (1 - chance) - true) < 0.15
    assert len(band_keys(minima(pool, factors))) == minhash.BANDS


def test_words_across_blocks(monkeypatch):
    text = " ".join(f"word{i}" for i in range(5000))
    whole = [w.tolist() for w in word_hashes([text, "Word1", None, "word2"])]
    monkeypatch.setattr("tidemark.llm.shingles.BLOCK", 100)
    assert [w.tolist() for w in word_hashes([text, "Word1", None, "word2"])] == whole
    assert whole[0][1] == whole[1][0] and whole[2] == [] and len(whole[0]) == 5000
    assert len(shingle_set(np.array(whole[0], np.uint64), 3)) == 4998


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (103, 101), (7, 7)]
    df = spark.createDataFrame(links, "u bigint, v bigint")
    got = dict(components(df, Scratch(spark, "t")).collect())
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 103: 100}


def test_long_texts_in_one_bucket_stay_in_bounds(spark, monkeypatch):
    """Blocks are cut by the bytes of their sets, and shared shingles counted slice by slice."""
    monkeypatch.setattr(minhash, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(minhash, "SLICE", 500)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(1500)]
    docs = []
    for i in range(24):
        w = list(base)
        for j in range(0, 1500, rng.choice([2, 8, 40])):
            w[j] = f"z{i % 6}_{j}"
        docs.append((i, " ".join(w)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert sorted(map(tuple, near_duplicates(df, 2).collect()), key=repr) == brute(docs, 2)


def test_shared_shingles_by_slices(monkeypatch):
    monkeypatch.setattr(minhash, "SLICE", 64)
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype(np.uint64)) for _ in range(20)]
    rows, cols = np.arange(0, 9), np.arange(9, 20)
    shared = minhash._shared(sets, rows, cols)
    assert shared.tolist() == [[len(np.intersect1d(sets[i], sets[j])) for j in cols] for i in rows]


def test_estimates_of_blocks_are_those_of_pairs(spark):
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 400, 300).astype(np.uint64)) for _ in range(12)]
    sets += [np.unique(np.concatenate((s[20:], s[:5] + np.uint64(10_000)))) for s in sets]
    sig = np.array([packed_bits(minima(s, minhash._constants())) for s in sets])
    df = spark.createDataFrame([(i, s.tolist()) for i, s in enumerate(sig)], "i int, s array<bigint>")
    pairs = df.join(df.selectExpr("i AS j", "s AS t"), F.col("i") != F.col("j"), "left")
    told = pairs.select("i", "j", minhash.may_reach(F.col("s"), F.col("t"), 80).alias("m")).collect()
    fits = minhash._possible(sig.view(np.uint64), sig.view(np.uint64), 80)
    assert all(fits[r.i, r.j] == r.m for r in told) and 0 < fits.sum() < fits.size
