"""Sketches against plain set differences."""

import hashlib
import random
import re

import pytest

from tidemark.llm import fingerprints as fp
from tidemark.llm.staging import Scratch


def units(text):
    return {p for p in re.split(fp.BOUNDARY, text or "") if p.strip(" ")}


def likeness(a, b):
    a, b = units(a), units(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(docs):
    order = sorted(docs, key=lambda d: d[0], reverse=True)
    out = []
    for i, (d, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        k = len(text) // 3
        edited = text[:len(text) - k] + after[:k]
        out.append((d, len(text), hashlib.sha256(edited.encode()).hexdigest(),
                    likeness(text, edited), likeness(text, after)))
    return sorted(out)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(8)
    line = lambda: " ".join(rng.choice(["ab", "cd", "é", "fgh"]) for _ in range(rng.randint(1, 6)))
    rows = [(i * 3, rng.choice([". ", "\n", "? "]).join(line() for _ in range(rng.randint(0, 60))))
            for i in range(250)]
    rows += [(10_000, None), (10_001, ""), (10_002, "x"), (10_003, rows[5][1]), (10_004, rows[5][1]),
             (-5, "\n".join(f"line {i} {rng.random()}" for i in range(3000)))]
    return rows


def test_versions_against_plain_sets(spark, docs):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs],
                               "doc_id bigint, text string, units int, run string").repartition(6)
    got = fp.fingerprint_versions(df).collect()
    keys = ("doc_id", "n_chars", "edited_sha256", "near_edited", "near_next")
    for g, w in zip(sorted(tuple(r[k] for k in keys) for r in got), brute(docs)):
        assert g[:3] == w[:3] and g[3:] == pytest.approx(w[3:])
    prints = {}
    for r in got:
        prints.setdefault(dict(docs)[r["doc_id"]] or "", set()).add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())


def test_repeated_rows_null_ids_single_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a. b. c."), (1, "a. b. c."), (None, "d. e."), (2, None)],
                               "doc_id int, text string")
    got = fp.fingerprint_versions(df).collect()
    assert sorted((str(r["doc_id"]), r["n_chars"]) for r in got) == [
        ("1", 8), ("1", 8), ("2", 0), ("None", 5)]
    one = fp.fingerprint_versions(df.filter("doc_id IS NULL")).first()
    assert (one["near_next"], one["near_edited"]) == (1.0, pytest.approx(likeness("d. e.", "d. ed")))
    assert fp.fingerprint_versions(df.limit(0)).count() == 0


def test_texts_without_sentence_marks_have_units(spark):
    rng = random.Random(4)
    words = [f"w{rng.randint(0, 5000)}" for _ in range(3000)]
    han = "".join(chr(0x4e00 + rng.randint(0, 3000)) for _ in range(4000))
    marked = "".join(chr(0x4e00 + rng.randint(0, 3000)) + ("。" if i % 9 == 0 else "")
                     for i in range(900))
    texts = [" ".join(words), han, marked, "other words " * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: r for r in fp.fingerprint_versions(df).collect()}
    assert all(.35 < got[i]["near_edited"] < .7 for i in range(3))
    assert all(got[i]["near_next"] < .1 for i in range(3))


def test_an_id_of_many_rows_is_spread_and_keeps_its_order(spark):
    texts = [f"text {i}. And {i % 7}." for i in range(3000)]
    rows = [(None, t) for t in texts] + [(i, f"doc {i}.") for i in range(500)] \
        + [(200, f"again {i}.") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    joined = fp.with_next(df, Scratch(spark, "t"))
    hashes = {r["text"]: r["h"] for r in df.selectExpr("text", "xxhash64(text) AS h").collect()}
    order = sorted(rows, key=lambda r: (-(1 << 63) if r[0] is None else r[0], hashes[r[1]]),
                   reverse=True)
    want = {t: order[(i + 1) % len(order)][1] for i, (_, t) in enumerate(order)}
    assert {r["text"]: r["next_text"] for r in joined.collect()} == want
    quantiles = [-(1 << 63)] * 20 + [3, 5, 5, 9]
    runs = df.select("doc_id", fp._run_number(fp.F.coalesce("doc_id", fp.F.lit(-(1 << 63))),
                                              fp.F.xxhash64("text"), quantiles).alias("run"))
    found = runs.filter("doc_id IS NULL").groupBy("run").count().collect()
    assert len(found) == 21 and max(r["count"] for r in found) < 250


def test_fingerprints_alone_give_the_same_differences(spark, docs):
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    pairs = fp.fingerprint_versions(df).selectExpr("doc_id AS id", "fingerprint AS a",
                                                   "edited_fingerprint AS b")
    read = {r["id"]: r["differing"] for r in fp.compare_fingerprints(pairs).collect()}
    order = sorted(docs, key=lambda d: d[0], reverse=True)
    small = told = 0
    for i, (d, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        k = len(text) // 3
        differing = units(text) ^ units(text[:len(text) - k] + after[:k])
        assert read[d] in (None, len(differing))
        small += len(differing) <= 8
        told += len(differing) <= 8 and read[d] is not None
    assert small > 40 and told > .9 * small


def test_small_sketches_are_made_again_until_all_is_recovered(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for i in range(40):
        a, b = ({rng.getrandbits(32) for _ in range(rng.randint(0, 400))} for _ in range(2))
        both = {rng.getrandbits(32) for _ in range(50)}
        rows.append((i, 0, list(a | both), list(b | both)))
        want[i] = len(a | both) + len(b | both) - 2 * len((a | both) & (b | both))
    df = spark.createDataFrame(rows, "id bigint, kind int, a array<bigint>, b array<bigint>")
    got = {r["id"]: r["differing"] for r in fp.differences(df, Scratch(spark, "t")).collect()}
    assert {i: got.get(i, 0) for i in want} == want
