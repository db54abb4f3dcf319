"""Benchmark decontamination by a BM25 index of the test items.

Every document is a query against an inverted index whose entries are the questions and the answers
of the items. Postings are kept in blocks of entries with the largest impact of each term in a
block; a document looks into a block only if the sum of its terms' block maxima reaches the
threshold, and what reaches it is retrieved, all of it. The threshold of an entry is the least
score that a document can have which holds enough of its word runs, wherever they stand. An item
counts if both its question and its answer are retrieved and verified.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.shingles import shingle_set, word_hashes
from tidemark.llm.staging import Scratch, picked

K1, B = 1.2, 0.75
GRAM = 5
BLOCK_ITEMS = 32
#: Words of items that one index holds; more items make further indexes, each run over all rows.
SHARD_WORDS = 1_000_000
#: Words of passages that are scored together.
BATCH_WORDS = 400_000

# ASCII punctuation, which separates words like white space does.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_PLAIN = bytes(32 if chr(i) in PUNCTUATION else i for i in range(256))


def plain(text: str | None) -> str:
    """Lower case, with ASCII punctuation as spaces."""
    return (text or "").lower().encode().translate(_PLAIN).decode()


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of an item: its last line is the answer, or else its last sentence, or
    else its second half."""
    text = text.strip()
    for mark in ("\n", "? ", ". ", "! "):
        head, found, tail = text.rpartition(mark)
        if found and plain(head).split() and plain(tail).split():
            return head, tail
    words = text.split()
    return " ".join(words[: len(words) // 2]), " ".join(words[len(words) // 2:])


class Index(NamedTuple):
    """Terms in order of their hash; postings by term, then item; blocks of ``BLOCK_ITEMS``."""
    terms: np.ndarray
    top: np.ndarray
    post_at: np.ndarray
    post_item: np.ndarray
    post_impact: np.ndarray
    block_at: np.ndarray
    block_no: np.ndarray
    block_top: np.ndarray
    block_from: np.ndarray
    ids: list
    grams: list
    need: np.ndarray
    step: int


def build_index(rows: Sequence[tuple], df: dict[int, int], n_items: int, mean_words: float,
                step: int, overlap: float | None = None) -> Index | None:
    """An index of ``rows(id, text)``; ``df``, ``n_items`` and ``mean_words`` are those of all
    items. Impacts are BM25 terms divided by the entry's score against itself, so a text that
    holds all its words scores 1. With ``overlap`` they are divided by the score that any text has
    which holds this share of the entry's word runs (``need``), so that 1 is the threshold."""
    words = list(word_hashes([plain(t) for _, t in rows]))
    terms = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
    if len(terms) == 0:
        return None
    idf = np.array([np.log(1 + (n_items - df[int(t)] + 0.5) / (df[int(t)] + 0.5)) for t in terms])
    grams = [_grams(w) for w in words]
    need = np.ones(len(rows))
    term_no, item_no, impact = [], [], []
    for i, w in enumerate(words):
        found, tf = np.unique(np.searchsorted(terms, w), return_counts=True)
        value = idf[found] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(w) / mean_words))
        term_no.append(found)
        item_no.append(np.full(len(found), i))
        impact.append(value / max(value.sum(), 1e-12))
        if overlap is not None and len(w):
            need[i] = _least(w, grams[i][1], dict(zip(terms[found].tolist(), impact[-1])), overlap)
            impact[-1] = impact[-1] / need[i]
    term_no, item_no, impact = map(np.concatenate, (term_no, item_no, impact))
    order = np.lexsort((item_no, term_no))
    term_no, item_no, impact = term_no[order], item_no[order], impact[order]
    post_at = np.searchsorted(term_no, np.arange(len(terms) + 1))
    top = np.maximum.reduceat(impact, post_at[:-1])
    key = term_no * (len(rows) // BLOCK_ITEMS + 1) + item_no // BLOCK_ITEMS
    block_from = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    block_at = np.searchsorted(term_no[block_from], np.arange(len(terms) + 1))
    return Index(terms, top, post_at, item_no, impact, block_at, item_no[block_from] // BLOCK_ITEMS,
                 np.maximum.reduceat(impact, block_from), np.append(block_from, len(impact)),
                 [r[0] for r in rows], grams, need, step)


def _least(words: np.ndarray, width: int, weight: dict[int, float], overlap: float) -> float:
    """The least score of a text that holds ``overlap`` of the distinct runs of ``words``.

    A word is missing only if all runs with it are, so its weight is dealt evenly to them; what
    the missing runs can take is at most the sum of the heaviest.
    """
    runs = {tuple(words[i:i + width].tolist()) for i in range(len(words) - width + 1)}
    inside: dict[int, int] = {}
    for run in runs:
        for t in set(run):
            inside[t] = inside.get(t, 0) + 1
    value = sorted((sum(weight[t] / inside[t] for t in set(run)) for run in runs), reverse=True)
    missing = int((1 - overlap) * len(runs) + 1e-9)
    return max(1e-6, 1 - sum(value[:missing]) - 1e-9)


def _grams(words: np.ndarray) -> tuple[np.ndarray, int]:
    width = max(1, min(GRAM, len(words)))
    return shingle_set(words, width), width


def _spread(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each interval its number, and each place in it."""
    n = ends - starts
    owner = np.repeat(np.arange(len(n)), n)
    return owner, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts, n)


def retrieve(index: Index, passage: np.ndarray, term: np.ndarray, n: int,
             least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All (passage, item, score) with a score of ``least`` or more.

    ``passage`` and ``term`` are the distinct pairs of ``n`` passages and the terms they hold.
    """
    slack = least - 1e-9
    bound = np.bincount(passage, index.top[term], n)
    alive = (bound >= slack)[passage]
    passage, term = passage[alive], term[alive]
    owner, at = _spread(index.block_at[term], index.block_at[term + 1])
    key = passage[owner] * (len(index.ids) // BLOCK_ITEMS + 1) + index.block_no[at]
    found, place = np.unique(key, return_inverse=True)
    alive = (np.bincount(place, index.block_top[at], len(found)) >= slack)[place]
    owner, at = owner[alive], at[alive]
    entry, post = _spread(index.block_from[at], index.block_from[at + 1])
    key = passage[owner[entry]] * len(index.ids) + index.post_item[post]
    found, place = np.unique(key, return_inverse=True)
    score = np.bincount(place, index.post_impact[post], len(found))
    good = score >= slack
    return found[good] // len(index.ids), found[good] % len(index.ids), score[good]


def _passages(words: list[np.ndarray], index: Index):
    """Distinct (passage, term) pairs of overlapping passages, and the document of each passage."""
    passage, term, owner, n = [], [], [], 0
    for d, w in enumerate(words):
        at = np.searchsorted(index.terms, w)
        at[at == len(index.terms)] = 0
        hits = np.flatnonzero(index.terms[at] == w)
        windows = max(1, -(-len(w) // index.step) - 1)
        if len(hits):
            first = hits // index.step
            for back in (0, 1):
                p = first - back
                ok = (p >= 0) & (p < windows)
                passage.append(n + p[ok])
                term.append(at[hits[ok]])
        owner.append(np.full(windows, d))
        n += windows
    if not passage:
        return np.zeros(0, int), np.zeros(0, int), np.concatenate(owner), n
    key = np.unique(np.concatenate(passage) * len(index.terms) + np.concatenate(term))
    return key // len(index.terms), key % len(index.terms), np.concatenate(owner), n


def _share(grams: tuple[np.ndarray, int], words: np.ndarray, held: dict[int, np.ndarray]) -> float:
    """The share of an entry's runs in ``words``; ``held`` keeps the runs of these by width."""
    wanted, width = grams
    if len(wanted) == 0 or len(words) < width:
        return 0.0
    if width not in held:
        held[width] = shingle_set(words, width)
    return float(np.isin(wanted, held[width]).mean())


def _search(index: Index, least: float, overlap: float):
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_passages", pa.int64()),
                        ("score", pa.float64()), ("question_overlap", pa.float64()),
                        ("answer_overlap", pa.float64())])

    def look(ids: list, words: list[np.ndarray]) -> list[tuple]:
        doc, term = [], []
        for d, w in enumerate(words):
            at = np.unique(np.searchsorted(index.terms, w))
            at = at[at < len(index.terms)]
            at = at[np.isin(index.terms[at], w)]
            doc.append(np.full(len(at), d))
            term.append(at)
        hit, entry, _ = retrieve(index, np.concatenate(doc), np.concatenate(term), len(words), 1.0)
        # The entries of an item are neighbours, first the question, then the answer.
        both = np.unique(hit * len(index.ids) + entry // 2 * 2, return_counts=True)
        out, held, last = [], {}, -1
        for key in both[0][both[1] == 2].tolist():
            d, e = divmod(key, len(index.ids))
            if d != last:
                held, last, scores = {}, d, None
            q, a = (_share(index.grams[x], words[d], held) for x in (e, e + 1))
            if q >= overlap and a >= overlap:
                if scores is None:
                    passage, term, _, n = _passages([words[d]], index)
                    scores = retrieve(index, passage, term, n, 1e-3)
                mine = (scores[1] == e) | (scores[1] == e + 1)
                score = scores[2][mine] * index.need[scores[1][mine]]
                count = len(np.unique(scores[0][mine][score >= least - 1e-9]))
                out.append((ids[d], index.ids[e], count, float(score.max(initial=0.0)), q, a))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, waiting, size, out = [], [], 0, []
            texts = (plain(t.as_py()) for t in batch.column(1))
            for doc_id, words in zip(batch.column(0).to_pylist(), word_hashes(texts)):
                ids.append(doc_id)
                waiting.append(words)
                size += len(words)
                if size > BATCH_WORDS:
                    out += look(ids, waiting)
                    ids, waiting, size = [], [], 0
            if waiting:
                out += look(ids, waiting)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip(list(zip(*out)) or [[]] * 6, schema)],
                schema=schema)
    return run


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        item, term, size = [], [], []
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = np.concatenate(list(word_hashes([plain(part) for part in split_item(text)])))
            found = np.unique(words)
            item += [i] * len(found)
            term.append(found.view(np.int64))
            size += [len(words)] * len(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), pa.array(np.concatenate(term) if term else [], pa.int64()),
             pa.array(size, pa.int64())], names=["item", "term", "words"])


FOUND = ("doc_id bigint, item_id bigint, n_passages bigint, score double, "
         "question_overlap double, answer_overlap double")


def contaminated(docs: DataFrame, items: DataFrame, least_score: float = 0.5,
                 overlap: float = 0.7) -> DataFrame:
    """Documents that hold test items, a row for each document row and item.

    ``docs`` needs ``doc_id, text``, ``items`` needs ``item_id, text`` (integer ids); other
    columns are ignored. Words are runs of characters other than white space and ASCII
    punctuation, in lower case. The overlaps are the shares of the distinct 5-word runs of the
    item's question and answer that the document holds, together or far apart; both must reach
    ``overlap``, and each pair of which both do is found. An item without words in its question
    or in its answer matches nothing, nor do NULL and empty texts, documents' or items'.
    ``score`` only informs: the best BM25 score of a passage against the question or the answer,
    1 if all its words are in it; ``n_passages`` of them reach ``least_score``. Passages are twice
    as long as the longest item and overlap by half. An item may have no id. Rows of one id each count. No rows give no rows.

    Documents aren't shuffled. Items are indexed in shards of ``SHARD_WORDS`` words at most
    (an item by itself may be longer), each one sent to the tasks; term statistics are those of
    all items.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    items = picked(items, "item_id", "text").filter("text IS NOT NULL").select(
        F.xxhash64("item_id", F.col("item_id").isNull(), "text").alias("item"), "item_id", "text")
    terms = scratch.write(items.select("item", "text").mapInArrow(
        _terms, "item bigint, term bigint, words bigint"),
                          "terms")
    per_item = scratch.write(terms.groupBy("item").agg(F.max("words").alias("words")), "sizes")
    n_items, total, longest = per_item.agg(F.count(F.lit(1)), F.sum("words"), F.max("words")).first()
    found = spark.createDataFrame([], FOUND)
    if not n_items:
        return found
    shards = -(-2 * total // SHARD_WORDS) if total > SHARD_WORDS else 1
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("item"), F.lit(shards)))
    counted = terms.groupBy("term").agg(F.countDistinct("item").alias("df"))
    counted = scratch.write(counted, "counted")
    for shard in range(shards):
        own = dealt.filter(F.col("shard") == shard)
        rows = [tuple(r) for r in own.select("item_id", "text").collect()]
        in_shard = terms.join(own.select("item").distinct(), "item", "left_semi")
        df = {r["term"] % (1 << 64): r["df"] for r in
              counted.join(in_shard.select("term").distinct(), "term", "left_semi").collect()}
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        entries = [(i, part) for i, text in rows for part in split_item(text)]
        index = build_index(entries, df, n_items, total / n_items / 2, int(longest), overlap)
        if index is not None:
            found = found.unionByName(picked(docs, "doc_id", "text").mapInArrow(
                _search(index, least_score, overlap), FOUND))
    return found
