"""Targets against plain arithmetic; blocks and permutations by their laws."""

import re
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidemark.llm.mixing import mix_sources, permuted


def plain_targets(sizes):
    """Shares 150 % of all words by weight; what is above twice a source's size is shared anew."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    pool, full = Fraction(3 * sum(sizes.values()), 2), set()
    while True:
        left = pool - sum(2 * sizes[s] for s in full)
        w = sum(weight[s] for s in order if s not in full)
        target = {s: Fraction(2 * sizes[s]) if s in full else weight[s] * left / w for s in order}
        over = {s for s in order if s not in full and target[s] >= 2 * sizes[s]}
        if not over or len(full) + len(over) == len(order):
            return {s: min(target[s], Fraction(2 * sizes[s])) for s in order}
        full |= over


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 300)), f"src{i % 7}" if i % 11 else None, i)
            for i in range(600)]
    rows += [(700, None, "src1", 0), (701, "", "src1", 0), (702, " x\n y", "src2", 0),
             (None, "a b c", "src2", 0), (5, "again", "src2", 0), (5, "again", "src2", 0),
             (703, "w " * 50_000, "big", 0), (704, None, "void", 0)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, size int")


def test_targets_sizes_and_limits(spark, docs):
    got = mix_sources(docs).documents.collect()
    want = [(r["doc_id"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")), r["source"])
            for r in docs.collect()]
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sorted((str(d), n) for d, n, _ in want)
    sizes, source_of = defaultdict(int), {}
    for d, n, s in want:
        sizes[s] += n
        source_of[d, n] = s
    target, taken = plain_targets(sizes), defaultdict(int)
    for r in got:
        s = source_of[r["doc_id"], r["size"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(float(target[s]))
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 128 + 0.02 * target[s] for s in sizes)
    again = mix_sources(docs.repartition(7)).documents.collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_blocks_and_shards(docs):
    mix = mix_sources(docs, block_words=64, shard_slots=50)
    slots = mix.slots.collect()
    assert len({(r["shard"], r["slot"]) for r in slots}) == len(slots)
    times = defaultdict(int)
    for r in slots:
        times[r["sid"], r["block"]] += 1
    pieces = mix.pieces.groupBy("sid", "block").agg(F.sum("words").alias("n")).collect()
    words = {(r["sid"], r["block"]): r["n"] for r in pieces}
    assert max(times.values()) <= 2 and set(times) <= set(words) and max(words.values()) == 64
    taken = sum(words[b] * n for b, n in times.items())
    assert taken == mix.documents.agg(F.sum("taken")).first()[0]
    shard = [r["sid"] for r in slots if r["shard"] == 0]
    assert len(set(shard)) > 3


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_permutation(spark, n):
    df = spark.range(n).select(permuted(F.col("id"), F.lit(n), F.lit(5)).alias("p"))
    order = [r["p"] for r in df.collect()]
    assert sorted(order) == list(range(n)) and (n < 10 or order != list(range(n)))


def test_empty_tables(docs):
    assert mix_sources(docs.limit(0)).documents.count() == 0
    blank = mix_sources(docs.filter("text IS NULL")).documents.collect()
    assert {(r["size"], r["target"], r["taken"]) for r in blank} == {(0, 0.0, 0)}


def test_the_mix_holds_the_words_themselves(spark):
    """Every block is rebuilt by hand from the texts, rows with equal or no ids among them."""
    rows = [(i if i % 5 else None if i % 2 else 7, "\t" + " \n".join(
        f"s{i % 3}d{i}w{j}" for j in range(i * 13 % 140)), f"s{i % 3}", i) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n int")
    mix = mix_sources(docs, block_words=64, shard_slots=50, carry=["n"])
    words_of = {n: text.split() for _, text, _, n in rows}
    by_slot = defaultdict(list)
    for r in mix.documents.collect():
        own = words_of[r["carried"]["n"]]
        assert r["size"] == len(own) and r["taken"] == sum(len(m["text"].split()) for m in r["mixed"])
        for m in r["mixed"]:
            cut = own[m["first_word"]:m["first_word"] + m["words"]]
            assert m["text"].split() == cut and m["words"] > 0 and " \n".join(cut) == m["text"]
            by_slot[m["shard"], m["slot"]].append((m["place"], cut))
    blocks, contents = mix.blocks.collect(), {}
    assert {(r["shard"], r["slot"]) for r in blocks} == set(by_slot)
    assert len(blocks) == mix.slots.count() == len(by_slot)
    for r in blocks:
        parts = sorted(by_slot[r["shard"], r["slot"]])
        at = 0
        for place, cut in parts:
            assert place == at
            at += len(cut)
        text = r["text"].split()
        assert text == [w for _, cut in parts for w in cut] and r["words"] == len(text) <= 64
        assert all(w.startswith(r["source"] + "d") for w in text)
        # A block that is used again has the same words.
        assert contents.setdefault((r["source"], r["block"]), text) == text
    again = mix_sources(docs.repartition(5), block_words=64, shard_slots=50).blocks.collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, blocks))


def test_pipeline_stage_returns_the_words_that_are_taken(spark):
    import corpus_pipeline
    rows = [(None, " ".join(f"d{i}w{j}" for j in range(50 + i)), "ab"[i % 2], i) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars bigint")
    got = corpus_pipeline.mix(spark, docs, "").collect()
    for r in got:
        words, at = r["text"].split(), 0
        assert len(words) == r["taken"] > 0 and r["n_chars"] == len(r["text"])
        for m in r["mixed"]:
            first = int(words[at].split("w")[1])
            assert first == m["first_word"] and len({w.split("w")[0] for w in words}) == 1
            at += m["words"]
        assert at == r["taken"]
    assert any(r["taken"] != r["size"] for r in got)
