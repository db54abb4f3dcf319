"""Repeated passages, found by longest-previous-factor arrays over suffix arrays.

A passage of ``length`` bytes that occurs twice holds an anchor: the run of ``GRAM`` bytes with
the least hash in it, the same in both places. Anchors that occur once are put aside. Those that
occur again are compared with all they stand in; equal surroundings are one class. Where
surroundings differ, one of each class goes into a suffix array together with the others of its
anchor. The previous and next smaller positions in suffix order then tell, for each position,
whether what follows occurs earlier, or later, for ``length`` bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.shingles import BLOCK, mix, prefix_hashes, slice_hashes
from tidemark.llm.staging import Scratch, picked

#: Surroundings of one anchor that go into a suffix array together with as many others.
BLOCK_CONTEXTS = 1024
#: Parts of the places that an anchor may have in a passage.
CLASSES = 4
#: Bytes of surroundings that are compared at a time, unless a single group has more.
ARRAY_BYTES = 1 << 18


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the place of the least one, the first if level.

    Values are compared by their upper 42 bits; up to 2**22 of them at a time.
    """
    n = len(values)
    low = np.uint64((1 << 22) - 1)
    packed = (values & ~low) | np.arange(n, dtype=np.uint64)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max)
    padded[:n] = packed
    table = padded.reshape(-1, width)
    to_here = np.minimum.accumulate(table, axis=1).ravel()
    from_here = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    best = np.minimum(from_here[: n - width + 1], to_here[width - 1: n])
    return (best & low).astype(np.int64)


def _anchors(texts: Sequence[bytes], length: int, gram: int):
    """Text number, place, anchor hash, digest of the surroundings, and the least and greatest
    distance from the start of the windows that have this anchor, as six arrays."""
    out: list[tuple[np.ndarray, ...]] = []

    def flush(parts: list[tuple[int, bytes, int, int, int]]):
        """Each part: number of the text, bytes, where they stand in it, the text's length, and
        how many windows begin here."""
        data = np.frombuffer(b"".join(p[1] for p in parts), np.uint8)
        if len(data) < length:
            return
        number, offset, total, windows = (np.array([p[k] for p in parts]) for k in (0, 2, 3, 4))
        sizes = np.array([len(p[1]) for p in parts])
        begins = np.cumsum(sizes) - sizes
        sums = prefix_hashes(data)
        starts = np.arange(len(data) - gram + 1)
        grams = slice_hashes(sums, starts, starts + gram)
        first = sliding_argmin(grams, length - gram + 1)
        good = np.zeros(len(data) + 1, np.int32)
        np.add.at(good, begins, 1)
        np.add.at(good, begins + windows, -1)
        valid = np.flatnonzero(np.cumsum(good[:-1])[: len(first)] > 0)
        places, at, count = np.unique(first[valid], return_index=True, return_counts=True)
        # Anchors of later windows stand later, so those of one anchor are neighbours.
        far, near = places - valid[at], places - valid[at + count - 1]
        part = np.searchsorted(begins, places, "right") - 1
        reach = length - gram
        left = np.maximum(places - reach, begins[part])
        right = np.minimum(places + length, begins[part] + sizes[part])
        digest = mix(slice_hashes(sums, left, right) + (places - left).astype(np.uint64)
                     * np.uint64(0xD6E8FEB86659FD93))
        out.append((number[part], places - begins[part] + offset[part], grams[places], digest,
                    near, far))

    waiting, size = [], 0
    step = BLOCK
    for i, text in enumerate(texts):
        n_windows = len(text) - length + 1
        for at in range(0, max(0, n_windows), step):
            # Windows that begin in this part, with what their anchors' surroundings need.
            count = min(step, n_windows - at)
            a, b = max(0, at - length), min(len(text), at + count - 1 + 2 * length)
            if waiting and size + b - a > BLOCK:
                flush(waiting)
                waiting, size = [], 0
            waiting.append((i, text[a:b], a, len(text), count) if a == at else
                           (i, text[a:b], a, len(text), count + at - a))
            size += b - a
    if waiting:
        flush(waiting)
    if not out:
        return (np.zeros(0, np.int64),) * 6
    number, place, anchor, digest, near, far = (np.concatenate(x) for x in zip(*out))
    # An anchor that two parts of a long text have found: their windows together.
    _, keep, which = np.unique(number * (1 << 40) + place, return_index=True, return_inverse=True)
    least, greatest = near[keep], far[keep]
    np.minimum.at(least, which, near)
    np.maximum.at(greatest, which, far)
    return (number[keep], place[keep], anchor[keep].view(np.int64), digest[keep].view(np.int64),
            least, greatest)


def _find_anchors(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [(t or "").encode() for t in part.column(2).to_pylist()]
                number, place, anchor, digest, near, far = _anchors(texts, length, gram)
                take = pa.array(number)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take), pa.array(place),
                     pa.array(anchor), pa.array(digest), pa.array(near), pa.array(far)],
                    names=["doc_id", "row", "place", "anchor", "digest", "near", "far"])
    return run


def suffix_array(data: np.ndarray, depth: int, starts: np.ndarray | None = None
                 ) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order of their first ``depth`` bytes or more, and the ranks at each doubling,
    from 7 bytes on. ``data`` holds byte + 1, and 0 after the end of each string.

    With ``starts`` only the suffixes from there are put in order. Ranks count from 1, and are 0
    at places that this doesn't take.
    """
    n = len(data)
    # The last step only goes as far as is asked for.
    steps, reach = [], 7
    while reach < depth:
        steps.append(min(reach, depth - reach))
        reach += steps[-1]
    needed = [np.arange(n) if starts is None else starts]
    for step in reversed(steps):
        among = np.zeros(n + step, bool)
        among[needed[-1]] = among[needed[-1] + step] = True
        needed.append(np.flatnonzero(among[:n]))
    needed.reverse()

    padded = np.concatenate((data, np.zeros(8, data.dtype))).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for j in range(7):
        key = (key << np.uint64(9)) | padded[j:j + n]
    key, ranks = key[needed[0]], []
    for k, places in enumerate(needed):
        if k:
            beyond = np.concatenate((ranks[-1], np.zeros(steps[k - 1], np.int64)))
            key = ranks[-1][places] * (n + 1) + beyond[places + steps[k - 1]]
        order = np.argsort(key)
        ordered = key[order]
        rank = np.zeros(n, np.int64)
        rank[places[order]] = np.cumsum(np.append(True, ordered[1:] != ordered[:-1]))
        ranks.append(rank)
    return places[order], ranks


def share_prefix(order: np.ndarray, ranks: list[np.ndarray], length: int) -> np.ndarray:
    """Whether neighbours in suffix order agree in their first ``length`` bytes: two overlapping
    runs whose length is the largest doubling that fits are compared by rank."""
    level = max(k for k in range(len(ranks)) if 7 << k <= length)
    rank, beyond = ranks[level], length - (7 << level)
    padded = np.concatenate((rank, np.full(beyond, -1)))
    a, b = order[:-1], order[1:]
    return (rank[a] == rank[b]) & (padded[a + beyond] == padded[b + beyond])


def smaller_before(values: np.ndarray, same_run: np.ndarray) -> np.ndarray:
    """For each value whether its run holds a smaller one before it."""
    n, top = len(values), np.iinfo(np.int64).max
    heads = np.flatnonzero(~same_run)
    head_of = heads[np.cumsum(~same_run) - 1]
    seen, width = values.copy(), 1
    # Running minimum within runs by doubling.
    while True:
        moved = np.full(n, top)
        moved[width:] = seen[:-width]
        moved[np.arange(n) - width < head_of] = top
        if not (moved < seen).any():
            break
        seen = np.minimum(seen, moved)
        width *= 2
    least = np.full(n, top)
    least[1:] = seen[:-1]
    least[heads] = top
    return least < values


def earlier_and_later(strings: Sequence[bytes], ids: Sequence[np.ndarray],
                      length: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each place of each string, whether the ``length`` bytes from there also begin at a
    smaller, or at a larger id; ``ids`` gives each place one.

    In suffix order a longest previous factor of ``length`` or more lies among the neighbours
    that share as many bytes: it's there if a smaller id comes before or after in that run.
    """
    data = np.concatenate([np.append(np.frombuffer(s, np.uint8).astype(np.int16) + 1, 0)
                           for s in strings])
    where = np.concatenate([np.append(i, -1) for i in ids])
    ends = np.cumsum([len(s) + 1 for s in strings]) - 1
    left = np.repeat(ends, [len(s) + 1 for s in strings]) - np.arange(len(data))
    # Suffixes too short to hold so many bytes have no place in the order.
    starts = np.flatnonzero(left >= length)
    if len(starts) == 0:
        return tuple([np.zeros(len(s), bool) for s in strings] for _ in range(2))
    order, ranks = suffix_array(data, length, starts)
    tied = np.append(False, share_prefix(order, ranks, length))
    position = where[order]

    def either_side(v: np.ndarray) -> np.ndarray:
        before = smaller_before(v, tied)
        after = smaller_before(v[::-1], np.concatenate(([False], tied[1:][::-1])))[::-1]
        out = np.zeros(len(data), bool)
        out[order] = before | after
        return out
    earlier, later = either_side(position), either_side(-position)
    begins = ends - [len(s) for s in strings]
    cut = lambda x: [x[a:b] for a, b in zip(begins, ends)]
    return cut(earlier), cut(later)


def _worth_sorting(strings: Sequence[bytes], ids: Sequence[np.ndarray], asked: np.ndarray,
                   length: int) -> list[tuple[int, int] | None]:
    """For each string the part that holds all its windows of ``length`` bytes whose hash also
    belongs to a window of another id, one of them in a string that is ``asked`` about; what
    lies outside need not be sorted."""
    sums = prefix_hashes(np.frombuffer(b"".join(strings), np.uint8))
    sizes = np.array([len(s) for s in strings])
    begins, counts = np.cumsum(sizes) - sizes, np.maximum(sizes - length + 1, 0)
    owner = np.repeat(np.arange(len(strings)), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = begins[owner] + place
    hashes = slice_hashes(sums, starts, starts + length)
    where = np.concatenate([i[:c] for i, c in zip(ids, counts)])
    order = np.argsort(hashes, kind="stable")
    ordered, where = hashes[order], where[order]
    heads = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    several = np.minimum.reduceat(where, heads) != np.maximum.reduceat(where, heads)
    several &= np.maximum.reduceat(asked[owner[order]], heads)
    hit = np.zeros(len(order), bool)
    hit[order] = np.repeat(several, np.diff(np.append(heads, len(order))))
    low = np.full(len(strings), np.iinfo(np.int64).max)
    high = np.full(len(strings), -1)
    np.minimum.at(low, owner[hit], place[hit])
    np.maximum.at(high, owner[hit], place[hit])
    return [(int(a), int(b) + length) if b >= 0 else None for a, b in zip(low, high)]


def _spans(covered: np.ndarray, length: int, offset: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes in strings that begin at the covered places."""
    at = np.flatnonzero(covered)
    if len(at) == 0:
        return []
    breaks = np.flatnonzero(np.diff(at) > length)
    firsts = at[np.concatenate(([0], breaks + 1))]
    lasts = at[np.concatenate((breaks, [len(at) - 1]))]
    return [(int(a) + offset, int(b) + length + offset) for a, b in zip(firsts, lasts)]


def _compare(length: int, keep_first: bool):
    """Spans of the surroundings in each partition, which is sorted by group."""
    names = ["doc_id", "row", "start", "stop"]

    def solve(rows: list[tuple]) -> list[tuple]:
        docs = {d: i for i, d in enumerate(sorted({(r[1] is None, r[1] or 0, r[2]) for r in rows}))}
        distinct = {(r[1], r[2], r[3], len(r[4])): r for r in rows}
        rows = list(distinct.values())
        ids = [docs[(r[1] is None, r[1] or 0, r[2])] * (1 << 40) + r[3]
               + np.arange(len(r[4]), dtype=np.int64) for r in rows]
        # Surroundings that occur twice as a whole go anyway, if all copies do.
        asked = np.array([keep_first or r[5] for r in rows])
        parts = _worth_sorting([r[4] for r in rows], ids, asked, length)
        ids = [i[p[0]:p[1]] for i, p in zip(ids, parts) if p]
        rows = [(*r[:3], r[3] + p[0], r[4][p[0]:p[1]], r[5]) for r, p in zip(rows, parts) if p]
        if not rows:
            return []
        earlier, later = earlier_and_later([r[4] for r in rows], ids, length)
        out = []
        for r, e, x in zip(rows, earlier, later):
            if not (keep_first or r[5]):
                continue
            for a, b in _spans(e if keep_first else e | x, length, r[3]):
                out.append((r[1], r[2], a, b))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size, group, tail = [], 0, None, 0

        def flush(rows):
            found = list(zip(*solve(rows))) or [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=names)

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for key, doc, row, at, context, single in zip(*columns):
                if key != group:
                    if size > ARRAY_BYTES:
                        yield flush(waiting)
                        waiting, size = [], 0
                    group = key
                waiting.append((key, doc, row, at, context, single))
                size += len(context)
        if waiting:
            yield flush(waiting)
    return run


def _class_bounds(reach: int) -> list[tuple[int, int]]:
    """Least and greatest distance of the anchor from the passage's start in each class."""
    edges = [(reach + 1) * k // CLASSES for k in range(CLASSES + 1)]
    return [(a, b - 1) for a, b in zip(edges, edges[1:])]


def _class_keys(anchor: int, context: bytes, at: int, length: int, reach: int) -> list[int | None]:
    """A hash, for each class, of the bytes that all its passages share; None if there are none.

    Two surroundings of an anchor hold a common passage of a class only if these are equal.
    """
    keys: list[int | None] = []
    for k, (low, high) in enumerate(_class_bounds(reach)):
        a, b = at - low, at - high + length
        if low > high or a < 0 or b > len(context):
            keys.append(None)
            continue
        told = hashlib.blake2b(context[a:b], digest_size=8, salt=bytes([k]),
                               key=anchor.to_bytes(8, "big", signed=True)).digest()
        keys.append(int.from_bytes(told, "big", signed=True))
    return keys


def _cut(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """The surroundings of the anchors that are asked for in each text."""
    reach = length - gram
    for batch in batches:
        out = []
        for doc, row, text, wanted in zip(*(batch.column(i).to_pylist() for i in range(4))):
            data = (text or "").encode()
            for w in wanted:
                # Passages that have another anchor are found with that one.
                a, b = w["place"] - w["far"], w["place"] - w["near"] + length
                context = data[a:b]
                out.append((w["anchor"], w["digest"], doc, row, w["place"], w["single"], a, context,
                            _class_keys(w["anchor"], context, w["place"] - a, length, reach)))
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
        columns = list(zip(*out)) or [[]] * 9
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["anchor", "digest", "doc_id", "row", "place", "single", "start", "context",
                   "keys"])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, removed, counts, hashes, kept, listed = [], [], [], [], [], []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            data = (text or "").encode()
            runs = merged([(s["start"], s["stop"]) for s in spans or ()])
            parts, at = [], 0
            for a, b in runs:
                parts.append(data[at:a])
                at = b
            rest = b"".join(parts) + data[at:]
            sizes.append(len(data))
            removed.append(len(data) - len(rest))
            counts.append(len(runs))
            hashes.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest)
            listed.append([{"start": a, "stop": b} for a, b in runs])
        span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, pa.int64()) for c in (sizes, removed, counts)],
             pa.array(hashes, pa.string()), pa.array(kept, pa.binary()),
             pa.array(listed, pa.list_(span))],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])


def remove_repeats(docs: DataFrame, length: int = 400, keep_first: bool = True) -> DataFrame:
    """Takes repeated passages of ``length`` (8 at least) bytes or more out of ``docs(doc_id, text)``.

    A byte goes if a string of ``length`` bytes that covers it begins anywhere else as well, in
    the same document or another; with ``keep_first`` only if it begins earlier, documents being
    in order of id, NULL last, then of a hash of the text. Texts are UTF-8 bytes, NULL is empty,
    passages never cross documents, and all is judged on the input. Other columns are ignored.
    Returns for every row ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, spans``.
    Rows alike in id and text are copies of each other: without ``keep_first`` they lose all
    that is long enough, with it they are one document. No rows give no rows.

    Anchors are folded by hash before any join; surroundings are fetched once for each class,
    and a group with many goes through the suffix arrays in pairs of blocks, none of it capped.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    gram = length // 2
    rows = picked(docs, "doc_id", "text").select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"), "text")
    anchors = scratch.write(rows.mapInArrow(
        _find_anchors(length, gram),
        "doc_id bigint, row bigint, place bigint, anchor bigint, digest bigint, near bigint, "
        "far bigint"), "anchors")
    again = (anchors.groupBy("anchor")
             .agg(F.count(F.lit(1)).alias("n"), F.min("digest").alias("low"),
                  F.max("digest").alias("high"))
             .filter("n > 1").select("anchor", (F.col("low") != F.col("high")).alias("mixed")))
    hits = scratch.write(anchors.join(scratch.write(again, "again"), "anchor"), "hits")
    scratch.release("anchors", "again")
    where = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "place", "near", "far")
    classes = (hits.groupBy("anchor", "digest", "mixed")
               .agg(F.count(F.lit(1)).alias("n"), F.min(where).alias("first")))
    classes = scratch.write(classes, "classes")
    reach = F.greatest(F.col("place") - (length - gram), F.lit(0))
    whole = (hits.join(classes.filter("n > 1").select("anchor", "digest", "first"),
                       ["anchor", "digest"]))
    if keep_first:
        whole = whole.filter(~(where.eqNullSafe(F.col("first"))))
    whole = whole.select("doc_id", "row", reach.alias("start"),
                         (F.col("place") + length).alias("stop")).distinct()

    wanted = (classes.filter("mixed").select("anchor", "digest", "first.doc_id", "first.row",
                                             "first.place", "first.near", "first.far",
                                             (F.col("n") == 1).alias("single"))
              .groupBy("doc_id", "row").agg(F.collect_list(F.struct(
                  "place", "anchor", "digest", "near", "far", "single")).alias("wanted")))
    wanted = wanted.withColumnRenamed("doc_id", "id_").withColumnRenamed("row", "row_")
    same = (F.col("row") == F.col("row_")) & F.col("doc_id").eqNullSafe(F.col("id_"))
    contexts = (rows.join(wanted, same).select("doc_id", "row", "text", "wanted")
                .mapInArrow(lambda b: _cut(b, length, gram),
                            "anchor bigint, digest bigint, doc_id bigint, row bigint, "
                            "place bigint, single boolean, start bigint, context binary, "
                            "keys array<bigint>"))
    contexts = scratch.write(contexts, "contexts")
    # Only surroundings that agree with others in what a class of passages shares go on, cut to
    # the classes in which they do.
    keyed = contexts.select("anchor", "digest", F.posexplode("keys").alias("class", "key")) \
        .filter("key IS NOT NULL")
    agreed = scratch.write(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                           .select("key"), "agreed")
    live = (keyed.join(agreed, "key").groupBy("anchor", "digest")
            .agg(F.min("class").alias("low"), F.max("class").alias("high")))
    bounds = F.array(*[F.struct(F.lit(a).alias("low"), F.lit(b).alias("high"))
                       for a, b in _class_bounds(length - gram)])
    begin = F.greatest(F.col("start"), F.col("place") - F.get(bounds, F.col("high"))["high"])
    end = F.col("place") - F.get(bounds, F.col("low"))["low"] + length
    contexts = contexts.join(live, ["anchor", "digest"]).select(
        "anchor", "digest", "doc_id", "row", "single", begin.alias("start"),
        F.substring("context", (begin - F.col("start") + 1).cast("int"), (end - begin).cast("int"))
        .alias("context"))
    contexts = scratch.write(contexts, "cut")
    sizes = scratch.write(contexts.groupBy("anchor").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK_CONTEXTS).cast("int").alias("blocks")), "sizes")
    own = F.pmod(F.col("digest"), F.col("blocks")).cast("int")
    # A block meets every block, itself included: pairs (a, b) with a <= b.
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(
        F.least(b, own).alias("a"), F.greatest(b, own).alias("b")))
    dealt = (contexts.join(sizes, "anchor")
             .select("anchor", F.explode(pairs).alias("p"), "doc_id", "row", "start", "context",
                     "single")
             .select(F.xxhash64("anchor", "p.a", "p.b").alias("group"), "doc_id", "row", "start",
                     "context", "single"))
    # In as many parts as shuffles have: to compare surroundings takes far longer than their few
    # bytes say, by which adaptive execution would put groups together.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    compared = (dealt.repartition(parts, "group").sortWithinPartitions("group")
                .mapInArrow(_compare(length, keep_first),
                            "doc_id bigint, row bigint, start bigint, stop bigint"))
    spans = scratch.write(whole.unionByName(compared).groupBy("doc_id", "row").agg(
        F.collect_set(F.struct("start", "stop")).alias("spans")), "spans")
    scratch.release("hits", "classes", "contexts", "cut")
    spans = spans.withColumnRenamed("doc_id", "id_").withColumnRenamed("row", "row_")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (rows.join(spans, same, "left")
            .select(F.col("doc_id").cast(kind).alias("doc_id"), "text", "spans")
            .mapInArrow(_remove, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, "
                                 "kept_sha256 string, kept binary, "
                                 "spans array<struct<start:bigint,stop:bigint>>"))
