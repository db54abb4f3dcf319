"""Importance resampling towards a target text: hashed word features, exact bucket totals, a
seeded draw without replacement.

A feature's bucket is its CRC-32 modulo the number of buckets. The vocabulary has a head and a tail:
for the most frequent words the CRC state is computed once and sent to the tasks, and likewise the
bucket of the most frequent pairs; all other features take their CRC where they stand. A longer run
goes on from the state of its first words.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.staging import Scratch, picked
from tidemark.operators.keys import assign_surrogates

#: Most frequent words and pairs that are sent to the tasks, and the longest that may be one.
HEAD_WORDS, HEAD_PAIRS, HEAD_BYTES = 20_000, 20_000, 64
#: Bytes of a text whose words are held at a time, and distinct features counted at a time.
BLOCK, HELD = 1 << 20, 1 << 18
#: Everything but a-z, 0-9 and bytes of other scripts parts words; A-Z are lower-cased.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else
               b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def word_blocks(text: str | None) -> Iterator[list[bytes]]:
    """The words of a whole text, a bounded number at a time."""
    data = (text or "").encode().translate(_TABLE)
    at = 0
    while at < len(data):
        end = at + BLOCK
        if end < len(data):
            gap = data.find(b" ", end)
            end = len(data) if gap < 0 else gap
        yield data[at:end].split()
        at = end


def _texts(batch: pa.RecordBatch) -> list[str | None]:
    return batch.column("text").to_pylist()


def frequent(texts: DataFrame, runs: int, limit: int, scratch: Scratch) -> dict[bytes, int]:
    """CRC states of the most frequent runs of ``runs`` words, by counts over all texts.

    Tasks count ahead of the shuffle, a bounded number of distinct runs at a time. Counts are told
    apart in steps of a sixteenth of a power of two; the head is all runs from that step on from which
    there are ``limit`` at most. So what comes to the driver is one row per step and ``limit`` runs of
    ``HEAD_BYTES`` bytes, and no task sorts them.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            fits = {k: n for k, n in counts.items() if len(k) <= HEAD_BYTES}
            counts.clear()
            return pa.record_batch([pa.array(list(fits), pa.binary()),
                                    pa.array(list(fits.values()), pa.int64())], ["feature", "n"])
        for batch in batches:
            for text in _texts(batch):
                before: list[bytes] = []
                for words in word_blocks(text):
                    words = before + words
                    counts.update(words if runs == 1 else
                                  map(b" ".join, zip(*(words[j:] for j in range(runs)))))
                    before = words[len(words) - runs + 1:] if runs > 1 else []
                    if len(counts) > HELD:
                        yield flush()
        yield flush()

    label = f"runs-{runs}"
    step = F.floor(F.log2(F.sum("n")) * 16).cast("int")
    found = scratch.write(texts.mapInArrow(counted, "feature binary, n long").groupBy("feature")
                          .agg(step.alias("step")), label)
    sizes = {r.step: r.n for r in found.groupBy("step").agg(F.count(F.lit(1)).alias("n")).collect()}
    room, least = limit, max(sizes, default=0) + 1
    for each in sorted(sizes, reverse=True):
        room -= sizes[each]
        if room < 0:
            break
        least = each
    head = {bytes(r.feature): zlib.crc32(r.feature)
            for r in found.filter(F.col("step") >= least).select("feature").collect()}
    scratch.release(label)
    return head


def _states(words: list[bytes], runs: int, head: dict[bytes, int],
            pairs: dict[bytes, int], fresh: int) -> list[int]:
    """CRC states of all runs of one to ``runs`` words that end at or after place ``fresh``."""
    crc = zlib.crc32
    state = [s if (s := head.get(w)) is not None else crc(w) for w in words]
    out = state[fresh:]
    for n in range(2, runs + 1):
        spaced = [b" " + w for w in words[n - 1:]]
        if n == 2:
            state = [s if (s := pairs.get(a + b)) is not None else crc(b, before)
                     for a, b, before in zip(words, spaced, state)]
        else:
            state = [crc(b, before) for b, before in zip(spaced, state)]
        out += state[max(0, fresh - n + 1):]
    return out


def bucket_counts(text: str | None, runs: int, buckets: int, head: dict[bytes, int],
                  pairs: dict[bytes, int]) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Words and features of a text, its buckets, and how many features fall into each."""
    n_words = n_features = 0
    before: list[bytes] = []
    total: np.ndarray | None = None
    found = counts = np.empty(0, np.int64)
    for words in word_blocks(text):
        n_words += len(words)
        words = before + words
        states = np.array(_states(words, runs, head, pairs, len(before)), np.int64) % buckets
        n_features += len(states)
        more, times = np.unique(states, return_counts=True)
        if len(found):
            if total is None:
                total = np.zeros(buckets, np.int64)
                total[found] = counts
            total[more] += times
        else:
            found, counts = more, times
        before = words[max(0, len(words) - runs + 1):] if runs > 1 else []
    if total is not None:
        found = np.flatnonzero(total)
        counts = total[found]
    return n_words, n_features, found, counts


def hashed_features(docs: DataFrame, runs: int, buckets: int, head: dict[bytes, int],
                    pairs: dict[bytes, int], id_col: str) -> DataFrame:
    """``(id_col, n_words, n_features, buckets, counts)`` of every text."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((head, pairs))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states, pair_states = sent.value
        for batch in batches:
            parts = [bucket_counts(t, runs, buckets, states, pair_states) for t in _texts(batch)]
            if not parts:
                continue
            ends = np.cumsum([0] + [len(p[2]) for p in parts]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(
                [p[i] for p in parts]).astype(np.int32), pa.int32())) for i in (2, 3)]
            yield pa.record_batch(
                [batch.column(id_col), pa.array([p[0] for p in parts], pa.int64()),
                 pa.array([p[1] for p in parts], pa.int64()), *lists],
                [id_col, "n_words", "n_features", "buckets", "counts"])
    schema = (f"`{id_col}` long, n_words long, n_features long, buckets array<int>, "
              "counts array<int>")
    return docs.select(F.col(id_col).cast("bigint").alias(id_col), "text").mapInArrow(hashed, schema)


def bucket_totals(features: DataFrame, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket; ``buckets`` numbers come together."""
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            np.add.at(total, batch.column("buckets").flatten().to_numpy(zero_copy_only=False),
                      batch.column("counts").flatten().to_numpy(zero_copy_only=False))
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    total = np.zeros(buckets, np.int64)
    for row in (features.select("buckets", "counts").mapInArrow(summed, "bucket long, n long")
                .groupBy("bucket").agg(F.sum("n").alias("n")).collect()):
        total[row.bucket] = row.n
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a weight: a thousand times the smoothed log ratio."""
    size = len(source)
    all_source, all_target = float(source.sum() + size), float(target.sum() + size)
    return np.array([math.floor(1000 * math.log(((t + 1) * all_source) / ((s + 1) * all_target)))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def _weighed(features: DataFrame, gain: np.ndarray) -> DataFrame:
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("buckets")
            each = gain[lists.flatten().to_numpy(zero_copy_only=False)] \
                * batch.column("counts").flatten().to_numpy(zero_copy_only=False)
            sums = np.concatenate(([0], np.cumsum(each)))
            ends = np.cumsum(np.concatenate(([0], lists.value_lengths().to_numpy(
                zero_copy_only=False).astype(np.int64))))
            yield pa.record_batch(
                [batch.column(c) for c in ("row", "doc_id", "n_words", "n_features")]
                + [pa.array(sums[ends[1:]] - sums[ends[:-1]])],
                ["row", "doc_id", "n_words", "n_features", "weight"])
    return features.mapInArrow(weigh, "row long, doc_id long, n_words long, n_features long, "
                                      "weight long")


def resample(docs: DataFrame, target: DataFrame, *, runs: int = 1, buckets: int = 10_000,
             least_words: int = 20, percent: int = 10, seed: int = 2024,
             head_words: int = HEAD_WORDS, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """Documents drawn by how much their words look like those of the target texts.

    ``docs`` needs ``doc_id`` (integer) and ``text``, ``target`` needs ``text``; other columns are
    ignored. Features are all runs of one to ``runs`` words, repeats counted. Weights are sums of
    ``gains``; the score adds noise that hangs on ``seed`` and ``doc_id`` alone, so reruns agree.
    Of the documents with at least ``least_words`` words the ``percent`` with the highest scores are
    drawn, ties going to the smaller ``doc_id``, NULL last, repeated rows each by itself. Returns
    ``doc_id, n_words, n_features, weight, score, rank`` for every document, ``rank`` being NULL
    where it was not drawn. NULL is an empty text and weighs 0; a NULL id makes the noise of an
    empty one. No documents give no rows; without target texts all buckets of the target are empty.

    ``head_words`` and ``head_pairs`` bound what is sent to the tasks and change no result. Texts
    are read twice, once for the head and once for the buckets; what follows reads the buckets,
    which are written. Ranks come from range partitions and their offsets.
    """
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "importance")
    texts = picked(docs, "doc_id", "text")
    wanted = picked(target, "text").select(F.lit(0).alias("doc_id"), "text")
    both = texts.select("text").unionByName(wanted.select("text"))
    head = frequent(both, 1, head_words, scratch)
    pairs = frequent(both, 2, head_pairs, scratch) if runs > 1 else {}
    features = scratch.write(
        hashed_features(texts, runs, buckets, head, pairs, "doc_id")
        .withColumn("row", F.monotonically_increasing_id()), "features")
    goal = bucket_totals(hashed_features(wanted, runs, buckets, head, pairs, "doc_id"), buckets)
    weighed = _weighed(features.select("row", "doc_id", "n_words", "n_features", "buckets", "counts"),
                       gains(bucket_totals(features, buckets), goal))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"),
                             F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = scratch.write(weighed.withColumn("score", F.col("weight") + noise)
                           .withColumn("long_enough", F.col("n_words") >= least_words), "scored")
    scratch.release("features")
    drawn = scored.filter("long_enough").count() * percent // 100
    ranked = assign_surrogates(
        scored.select("*", F.when(F.col("long_enough"), -F.col("score")).alias("order")),
        "place", ["order", "doc_id", "row"], 1)
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score",
                         F.when(F.col("place") <= drawn, F.col("place")).alias("rank"))
