"""Near duplicates by b-bit MinHash.

Minima of many hash functions are banded to find candidates; the low bits of the minima, packed
into a few longs, estimate the similarity of a candidate pair by counting bits, corrected for
chance agreement; what may reach the threshold is confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.graph import components
from tidemark.llm.shingles import mix, shingle_set, word_hashes
from tidemark.llm.staging import Scratch, picked

BANDS, ROWS, BITS = 40, 4, 2
HASHES = BANDS * ROWS
PER_LONG = 64 // BITS
#: Six standard deviations of the estimate below the threshold: what is dropped unseen.
SLACK = 0.23
#: Nodes in a block of neighbours that are compared with each other, and bytes of their sets, about.
BLOCK_NODES, BLOCK_BYTES = 1024, 16 << 20
#: Numbers in a slice of the matrix that shared shingles are counted with.
SLICE = 1 << 22

SIGNATURE = ("doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>, "
             "sig array<bigint>")


def _constants() -> np.ndarray:
    return mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)


def minima(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set of shingles."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1024):
        np.minimum(least, (shingles[at:at + 1024, None] * factors).min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = least.reshape(BANDS, ROWS)
    key = mix(np.arange(BANDS, dtype=np.uint64))
    for j in range(ROWS):
        key = mix(key ^ rows[:, j])
    return key.view(np.int64)


def packed_bits(least: np.ndarray) -> np.ndarray:
    """The low bits of the scrambled minima, packed into longs."""
    low = mix(least) & np.uint64((1 << BITS) - 1)
    shifts = np.arange(0, 64, BITS, dtype=np.uint64)
    return np.bitwise_or.reduce(low.reshape(-1, PER_LONG) << shifts, axis=1).view(np.int64)


def _digest(shingles: np.ndarray) -> bytes:
    import hashlib
    return hashlib.md5(shingles.tobytes()).digest()


def _sign(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _constants()
        schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()),
                            ("digest", pa.binary()), ("bands", pa.list_(pa.int64())),
                            ("sig", pa.list_(pa.int64()))])
        for batch in batches:
            sizes, digests, bands, sigs = [], [], [], []
            for words in word_hashes(batch.column(1).to_pylist()):
                shingles = shingle_set(words, n)
                sizes.append(len(shingles))
                if len(shingles):
                    least = minima(shingles, factors)
                    digests.append(_digest(shingles))
                    bands.append(band_keys(least))
                    sigs.append(packed_bits(least))
                else:
                    digests.append(None)
                    bands.append([])
                    sigs.append([])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
                 pa.array(sigs, pa.list_(pa.int64()))], schema=schema)
    return run


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: set size, digest of the set, band keys, packed bits."""
    return picked(docs, "doc_id", "text").mapInArrow(_sign(n), SIGNATURE)


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(w, n).tobytes() for w in word_hashes(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()),
                                              pa.array(found, pa.binary())],
                                             names=["node", "shingles"])
    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, key, left = [], None, None
            for a, b in zip(batch.column(2), batch.column(3)):
                if key is None or not a.equals(key):
                    key, left = a, np.frombuffer(a.as_py(), np.uint64)
                right = np.frombuffer(b.as_py(), np.uint64)
                both = np.concatenate((left, right))
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                good.append(100 * shared >= percent * (len(left) + len(right) - shared))
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["u", "v"])
    return run


def agreement(a: Column, b: Column) -> Column:
    """How many of the packed groups of bits agree in two signatures."""
    odd = sum(1 << i for i in range(0, 64, BITS)) - (1 << 64 if BITS == 1 else 0)
    differ = F.lit(0)
    for i in range(HASHES // PER_LONG):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        folded = x
        for s in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(x, s))
        differ = differ + F.bit_count(folded.bitwiseAND(F.lit(odd)))
    return F.lit(HASHES) - differ


def may_reach(a: Column, b: Column, percent: int) -> Column:
    """Whether the estimate, corrected for chance agreement, comes near the threshold."""
    chance = 2.0 ** -BITS
    least = percent / 100 - SLACK
    return agreement(a, b) >= F.lit(int(HASHES * (chance + (1 - chance) * least)))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the candidate pairs ``(u, v)`` those that are links by their full sets."""
    full = (pairs.join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("s_v")), "v")
            .join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("s_u")), "u")
            .select("u", "v", "s_u", "s_v"))
    return full.mapInArrow(_confirm(percent), "u bigint, v bigint")


def _possible(left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """``may_reach`` for each signature on the left with each on the right."""
    differ = np.zeros((len(left), len(right)), np.int64)
    odd = np.uint64(sum(1 << i for i in range(0, 64, BITS)))
    for i in range(left.shape[1]):
        x = left[:, i][:, None] ^ right[:, i][None, :]
        folded = x.copy()
        for s in range(1, BITS):
            folded |= x >> np.uint64(s)
        differ += np.bitwise_count(folded & odd)
    chance = 2.0 ** -BITS
    return HASHES - differ >= int(HASHES * (chance + (1 - chance) * (percent / 100 - SLACK)))


def _likely(percent: int):
    """Of two blocks the nodes that some node of the other block may be linked with."""
    def run(table: pa.Table) -> pa.Table:
        node, size = table["node"].to_numpy(), table["n_shingles"].to_numpy()
        left = table["left"].to_numpy(zero_copy_only=False)
        sig = table["sig"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(node), -1)
        rows, cols = np.flatnonzero(left), np.flatnonzero(~left)
        fits = _possible(sig[rows], sig[cols], percent)
        low = np.minimum(size[rows][:, None], size[cols][None, :])
        high = np.maximum(size[rows][:, None], size[cols][None, :])
        # A node stands on both sides if its hub isn't linked with it.
        fits &= (100 * low >= percent * high) & (node[rows][:, None] != node[cols][None, :])
        keep = np.zeros(len(node), bool)
        keep[rows[fits.any(axis=1)]] = True
        keep[cols[fits.any(axis=0)]] = True
        return table.select(["hub", "node", "left", "a", "b"]).filter(pa.array(keep))
    return run


def _shared(sets: list[np.ndarray], rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """How many shingles each set of ``rows`` has in common with each of ``cols``.

    Shingles are numbered, those that one set alone holds left out, and taken a slice at a time.
    """
    known, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    common = times > 1
    number = np.cumsum(common) - 1
    mine = common[place]
    owner, place = owner[mine], number[place[mine]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    shared = np.zeros((len(rows), len(cols)), np.int64)
    width = max(1, SLICE // len(sets))
    for at in range(0, int(common.sum()), width):
        a, b = np.searchsorted(place, (at, at + width))
        held = np.zeros((len(sets), width), np.float32)
        held[owner[a:b], place[a:b] - at] = 1
        shared += (held[rows] @ held[cols].T).astype(np.int64)
    return shared


def _across(percent: int):
    """Links between two blocks of a hub's neighbours: as few as connect all that is linked."""
    def run(table: pa.Table) -> pa.Table:
        node = table["node"].to_numpy()
        left = table["left"].to_numpy(zero_copy_only=False)
        sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
        sizes = np.array([len(x) for x in sets])
        rows, cols = np.flatnonzero(left), np.flatnonzero(~left)
        shared = _shared(sets, rows, cols)
        both = sizes[rows][:, None] + sizes[cols][None, :] - shared
        i, j = np.nonzero(100 * shared >= percent * both)
        pairs = _spanning(node[rows[i]].tolist(), node[cols[j]].tolist())
        return pa.table([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)],
                        names=["u", "v"])
    return run


def _spanning(left: list[int], right: list[int]) -> list[tuple[int, int]]:
    """The pairs that join two parts not joined by those before."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while above.setdefault(x, x) != x:
            above[x] = x = above[above[x]]
        return x
    kept = []
    for u, v in zip(left, right):
        a, b = top(u), top(v)
        if a != b:
            above[a] = b
            kept.append((u, v))
    return kept


def _renamed(sig: DataFrame, side: str) -> DataFrame:
    return sig.select(*[F.col(c).alias(side if c == "node" else f"{c}_{side}")
                        for c in sig.columns])


def _links_across(stars: DataFrame, links: DataFrame, reps: DataFrame, sets: DataFrame, percent: int,
                  scratch: Scratch) -> DataFrame:
    """Links between neighbours of one hub, of which one isn't linked with the hub.

    Those that aren't are compared with all the hub's neighbours. Both are dealt into blocks of
    about ``BLOCK_NODES`` and ``BLOCK_BYTES``, and each pair of blocks is a group of its own. First
    their signatures meet, and only sets that may reach the threshold with another's follow.
    """
    linked = links.select(F.col("u").alias("hub"), F.col("v").alias("node"),
                          F.lit(True).alias("linked"))
    around = stars.join(linked, ["hub", "node"], "left").select(
        "hub", "node", F.coalesce("linked", F.lit(False)).alias("linked"))
    around = scratch.write(around.join(reps.select("node", "n_shingles"), "node"), "around")

    def blocks(nodes: Column, shingles: Column) -> Column:
        return F.greatest(F.ceil(nodes / BLOCK_NODES), F.ceil(8 * shingles / BLOCK_BYTES))
    apart = ~F.col("linked")
    mixed = (around.groupBy("hub").agg(
        blocks(F.count(F.when(apart, 1)), F.sum(F.when(apart, F.col("n_shingles"))))
        .alias("left_blocks"),
        blocks(F.count(F.lit(1)), F.sum("n_shingles")).alias("right_blocks"),
        F.count(F.lit(1)).alias("nodes")).filter("left_blocks > 0 AND nodes > 1").drop("nodes"))
    near = around.join(scratch.write(mixed, "mixed"), "hub")
    block = lambda n: F.pmod(F.xxhash64("node"), n)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))
    dealt = near.filter("NOT linked").select(
        "hub", "node", F.lit(True).alias("left"), block(F.col("left_blocks")).alias("a"),
        every(F.col("right_blocks")).alias("b"))
    dealt = dealt.unionByName(near.select(
        "hub", "node", F.lit(False).alias("left"), every(F.col("left_blocks")).alias("a"),
        block(F.col("right_blocks")).alias("b")))
    signed = dealt.join(reps.select("node", "n_shingles", "sig"), "node")
    likely = scratch.write(signed.groupBy("hub", "a", "b").applyInArrow(
        _likely(percent), "hub bigint, node bigint, left boolean, a bigint, b bigint"), "likely")
    return (likely.join(sets, "node").groupBy("hub", "a", "b")
            .applyInArrow(_across(percent), "u bigint, v bigint"))


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Groups of documents whose shingle sets have a similarity of ``percent`` / 100 or more.

    ``docs`` needs ``doc_id`` (integer) and ``text``; other columns are ignored. A set holds the
    distinct runs of ``n`` words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased); fewer words count as
    one run. Returns per row ``doc_id, n_shingles, component_id, kept``: ``component_id`` is the
    smallest id reachable by links, itself included, ``kept`` tells whether it is the row's own.
    NULL and blank texts have an empty set and are linked with nothing. Rows of one id are one
    document. A row without an id is linked with nothing: its component is NULL and it is kept.
    No rows give no rows.

    Rows with equal sets are one class, found by digest and represented by the smallest id. Band
    keys are compared among representatives. In a bucket all are compared with its hub only, the
    member that shares most buckets, so a bucket of many near copies costs as many pairs as it
    has members. Neighbours that their hub isn't linked with are then compared with its others,
    block by block inside the tasks, by signatures and then by sets, and no more links are given
    away than connect them. Nothing
    is capped. At 40 bands of 4 minima a link is missed with a chance below 1e-9.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "minhash")
    signed = scratch.write(signatures(docs, n), "signatures")
    full = signed.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = scratch.write(full.groupBy("digest").agg(F.min("doc_id").alias("node")), "classes")
    reps = scratch.write(full.join(classes, "digest").filter("doc_id = node")
                         .select("node", "n_shingles", "bands", "sig"), "reps")
    members = reps.select("node", F.explode("bands").alias("bucket"))
    shared = (members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
              .filter("size > 1"))
    shared = scratch.write(shared, "shared")
    crowd = scratch.write(members.join(shared, "bucket"), "crowd")
    degree = crowd.groupBy("node").agg(F.sum("size").alias("degree"))
    hubs = (crowd.join(degree, "node").groupBy("bucket")
            .agg(F.max(F.struct(F.col("degree"), F.bitwise_not("node").alias("node"))).alias("hub"))
            .select("bucket", F.bitwise_not("hub.node").alias("hub")))
    hubs = scratch.write(hubs, "hubs")
    stars = scratch.write(crowd.join(hubs, "bucket").filter("node <> hub").select("hub", "node")
                          .distinct(), "stars")
    scratch.release("shared", "crowd", "hubs")
    needed = stars.select(F.explode(F.array("hub", "node")).alias("doc_id")).distinct()
    # The ids grow with the corpus: the hint keeps them from being sent to every task.
    wanted = picked(docs, "doc_id", "text").join(needed.hint("merge"), "doc_id", "left_semi")
    sets = scratch.write(wanted.mapInArrow(_sets(n), "node bigint, shingles binary"), "sets")

    sig = reps.select("node", "n_shingles", "sig")
    near = (stars.select(F.col("hub").alias("u"), F.col("node").alias("v"))
            .join(_renamed(sig, "u"), "u").join(_renamed(sig, "v"), "v")
            .filter(100 * F.least("n_shingles_u", "n_shingles_v")
                    >= percent * F.greatest("n_shingles_u", "n_shingles_v"))
            .filter(may_reach(F.col("sig_u"), F.col("sig_v"), percent)).select("u", "v").distinct())
    links = scratch.write(_confirmed(near, sets, percent), "links")
    more = _links_across(stars, links, sig, sets, percent, scratch)
    labels = components(links.unionByName(scratch.write(more, "links-across")), scratch)
    scratch.release("sets", "stars", "reps")

    named = (classes.join(labels, "node", "left")
             .select("digest", F.coalesce("label", "node").alias("component")))
    named = scratch.write(named, "named")
    found = (signed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(),
                                                          F.col("digest")).alias("digest"))
             .join(named, "digest", "left"))
    component = F.coalesce("component", "doc_id")
    return found.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
