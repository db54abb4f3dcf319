"""Retrieval against scores of all pairs, and leaks against planted items."""

import numpy as np
import pytest

from tidemark.llm import decontaminate as dc
from tidemark.llm.shingles import word_hashes

ITEMS = [(1, "What is the capital of the land of oranges and lemons?\nIt is the town of Mirabel."),
         (2, "Name three rivers that cross the northern plain. They are Ira, Osk and Venn."),
         (3, "one two three four five six seven eight nine ten"), (4, None), (5, ""), (6, "!?")]
NOISE = "the of and it is a town river land plain name what " * 8


@pytest.fixture(scope="module")
def docs(spark):
    q, a = ITEMS[0][1].split("\n")
    rows = [(10, NOISE + ITEMS[0][1] + NOISE), (11, ITEMS[1][1].upper().replace(" ", "  ")),
            (12, NOISE), (13, q), (14, None), (15, ""), (16, NOISE * 4000 + ITEMS[2][1]),
            (17, ITEMS[0][1]), (17, ITEMS[0][1]), (None, ITEMS[2][1]),
            (18, a + " " + NOISE + NOISE), (19, ITEMS[0][1] + " " + ITEMS[1][1])]
    return spark.createDataFrame([(d, t, "x") for d, t in rows],
                                 "doc_id bigint, text string, item_id string")


def test_planted_items_are_found_and_others_left(spark, docs):
    items = spark.createDataFrame([(i, t, 0.5) for i, t in ITEMS], "item_id bigint, text string, score double")
    got = sorted(((r["doc_id"], r["item_id"]) for r in dc.contaminated(docs, items).collect()), key=str)
    assert got == sorted([(10, 1), (11, 2), (16, 3), (17, 1), (17, 1), (None, 3), (19, 1), (19, 2)],
                         key=str)
    assert dc.contaminated(docs.limit(0), items).count() == 0
    assert dc.contaminated(docs, items.limit(0)).count() == 0


def test_more_items_than_one_index_holds(spark, docs, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    whole = sorted(map(str, dc.contaminated(docs, items).drop("n_passages").collect()))
    monkeypatch.setattr(dc, "SHARD_WORDS", 12)
    assert sorted(map(str, dc.contaminated(docs, items).drop("n_passages").collect())) == whole


@pytest.mark.parametrize("least", [0.05, 0.2, 0.5])
def test_blocks_lose_nothing_above_the_threshold(least, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_ITEMS", 3)
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocabulary, rng.integers(3, 15)))) for i in range(25)]
    words = [np.unique(w) for w in word_hashes([t for _, t in items])]
    df = {}
    for w in words:
        for t in w.tolist():
            df[t] = df.get(t, 0) + 1
    index = dc.build_index(items, df, len(items), 9.0, 20)
    queries = [rng.choice(len(index.terms), rng.integers(1, 20), replace=False) for _ in range(80)]
    passage = np.repeat(np.arange(80), [len(q) for q in queries])
    p, i, s = dc.retrieve(index, passage, np.concatenate(queries), 80, least)
    got = {(a, b): c for a, b, c in zip(p.tolist(), i.tolist(), s.tolist())}
    want = {}
    for a, q in enumerate(queries):
        score = np.zeros(len(items))
        for t in q:
            at = slice(index.post_at[t], index.post_at[t + 1])
            score[index.post_item[at]] += index.post_impact[at]
        want |= {(a, b): c for b, c in enumerate(score.tolist()) if c >= least}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_parts_of_an_item():
    assert dc.split_item("Q one\nA two") == ("Q one", "A two")
    assert dc.split_item("Is it so? Yes it is.")[1] == "Yes it is."
    assert dc.split_item("a b c d") == ("a b", "c d") and dc.split_item("") == ("", "")


def test_parts_far_apart_and_edited(spark):
    """Most of the question on one page and most of the answer far away, rare words altered."""
    q, a = [f"q{i}" for i in range(30)], [f"a{i}" for i in range(30)]
    far = NOISE * 40
    rows = [(1, " ".join(q[:25]) + far + " ".join(a[5:])), (2, " ".join(q) + far),
            (3, " ".join(q[:14]) + far + " ".join(q[10:26]) + far + " ".join(a[:26])),
            (4, " ".join(q[:20]) + far + " ".join(a))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    # All words of the second half are rare, those of the first are in all items.
    items = [(9, " ".join(q) + "\n" + " ".join(a))] + [
        (20 + i, " ".join(q[:25]) + f" z{i}\n" + " ".join(a[5:]) + f" y{i} x{i} w{i}") for i in range(30)]
    items = spark.createDataFrame(items, "item_id bigint, text string")
    got = dc.contaminated(docs, items).filter("item_id = 9").collect()
    shares = {r["doc_id"]: (round(r["question_overlap"] * 26), round(r["answer_overlap"] * 26)) for r in got}
    assert shares == {1: (20, 21), 3: (20, 22)}


def test_items_without_ids_or_parts(spark, docs):
    words = "some rare words stand here together?\nand an answer nobody else has given"
    items = spark.createDataFrame([(None, words), (None, ITEMS[0][1]), (8, "town"), (9, None)],
                                  "item_id bigint, text string")
    more = docs.select("doc_id", "text").unionByName(
        spark.createDataFrame([(90, words)], "doc_id bigint, text string"))
    got = sorted((r["doc_id"], r["item_id"]) for r in dc.contaminated(more, items).collect())
    assert got == [(10, None), (17, None), (17, None), (19, None), (90, None)]
