"""Hard negatives by exact search over shared lists.

Anchors are clustered by direction. Within a block of candidates, one list serves a whole cluster: the
candidates by falling upper bound of what they can score with any member, from their angle to the
centre less the cluster's widest angle. Members walk that list together and drop out one by one, each
as soon as the bound of what is left can't change its result. Blocks are dealt over the cluster and
their findings merged, so neither anchors nor candidates meet in one place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.staging import Scratch, picked

#: Anchors that centres are fitted on, and centres at most. They decide the effort, not the result.
SAMPLE, CENTRES, TURNS = 2048, 32, 8
#: Bytes of a full block of candidates, those of a small one, and the number of blocks up to which
#: blocks may be small, for the sake of spread.
BLOCK_BYTES, SMALL_BYTES, SPREAD = 64 << 20, 1 << 20, 24
#: Members that walk together, and candidates in their first and longest steps.
MEMBERS, FIRST_STEP, LONGEST_STEP = 256, 256, 4096
#: Squared lengths from here on are left out: their scores may not fit a long.
TOO_LONG = float(1 << 55)
_LOWEST, _HIGHEST = -(1 << 62), 1 << 62
_FOUND = "anchor_id long, slot int, vec_id long, score long"


def quantised(vectors: DataFrame, vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """``(vec_id, label, dim, v)`` of the rows that take part, one for each ``vec_id``.

    Components become whole numbers. Rows with a NULL or a component that is not finite are left
    out, and so are empty vectors; of several rows of one id the one with the smallest label, then
    vector, is taken.
    """
    rows = picked(vectors, "vec_id", "label", vector_col).toDF("vec_id", "label", "e")
    infinite = float("inf")
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("e") > 0) & F.forall(
        "e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    steps = F.transform("e", lambda x: F.floor(x.cast("double") * scale))
    wide = F.aggregate("e", F.lit(0.0), lambda a, x: a + F.pow(F.floor(x.cast("double") * scale), 2.0))
    kept = rows.filter(usable).filter(wide < TOO_LONG)
    one = kept.groupBy(F.col("vec_id").cast("bigint").alias("vec_id")).agg(
        F.min(F.struct(F.col("label").cast("bigint").alias("label"), steps.alias("v"))).alias("x"))
    return one.select("vec_id", "x.label", F.size("x.v").alias("dim"), "x.v")


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of rows of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _lengths(v: np.ndarray) -> np.ndarray:
    return np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))


def _angles(v: np.ndarray, lengths: np.ndarray, centre: np.ndarray) -> np.ndarray:
    cosine = (v.astype(np.float64) @ centre) / np.maximum(lengths, 1e-300)
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def fit_centres(anchors: DataFrame, sample: int = SAMPLE, centres: int = CENTRES) \
        -> dict[int, np.ndarray]:
    """Directions that anchors gather around, by their number of components.

    Fitted on ``sample`` anchors at most, chosen by a hash of their id.
    """
    taken = anchors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").collect()
    by_dim: dict[int, list[list[int]]] = {}
    for row in taken:
        by_dim.setdefault(len(row.v), []).append(row.v)
    fitted = {}
    for dim, rows in by_dim.items():
        v = np.array(rows, np.float64)
        v = v[(v != 0).any(axis=1)]
        if not len(v):
            continue
        v /= _lengths(v)[:, None]
        middle = v[:: max(1, len(v) // min(centres, len(v)))][:centres].copy()
        for _ in range(TURNS):
            nearest = (v @ middle.T).argmax(axis=1)
            for c in range(len(middle)):
                total = v[nearest == c].sum(axis=0)
                length = np.sqrt((total ** 2).sum())
                if length > 0:
                    middle[c] = total / length
        fitted[dim] = middle
    return fitted


def _clustered(anchors: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """Anchors with the nearest centre and their angle to it; -1 where there is none."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cluster, angle = np.full(len(dims), -1, np.int32), np.full(len(dims), np.pi)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                v = _matrix(batch.column("v").take(pa.array(at)))
                lengths = _lengths(v)
                middle = centres.get(int(dim))
                if middle is None:
                    continue
                cosine = (v.astype(np.float64) @ middle.T) / np.maximum(lengths, 1e-300)[:, None]
                best = cosine.argmax(axis=1)
                some = lengths > 0
                cluster[at[some]] = best[some]
                angle[at[some]] = np.arccos(np.clip(cosine[some, best[some]], -1, 1))
            yield pa.record_batch([*batch.columns, pa.array(cluster), pa.array(angle)],
                                  [*batch.schema.names, "cluster", "angle"])
    return anchors.mapInArrow(assign, "vec_id long, label long, dim int, v array<bigint>, "
                                      "cluster int, angle double")


@dataclass
class _Members:
    """Anchors that walk together; a window for each of their slots, empty if low > high."""

    ids: np.ndarray
    labels: np.ndarray
    v: np.ndarray
    low: np.ndarray
    high: np.ndarray


class _Block:
    """Candidates of one block and, for one cluster at a time, their shared list."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray):
        self.ids, self.labels, self.v = ids, labels, v
        self.lengths = _lengths(v)
        self.longest = float(self.lengths.max(initial=0.0))
        self.cluster: int | None = None

    def arrange(self, cluster: int, centre: np.ndarray | None, widest: float) -> None:
        """Sorts the candidates by what they can score with a member of length 1."""
        if cluster == self.cluster:
            return
        reach = self.lengths
        if centre is not None:
            # A little wider than the angles, which are rounded.
            apart = np.maximum(_angles(self.v, self.lengths, centre) - widest - 1e-6, 0.0)
            reach = self.lengths * np.cos(apart)
        self.order = np.argsort(-reach, kind="stable")
        self.reach, self.cluster = reach[self.order], cluster

    def scores(self, v: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Inner products, in floating point where all sums are exact in it."""
        if float(_lengths(v).max(initial=0.0)) * self.longest < 1 << 52:
            return np.rint(v.astype(np.float64) @ self.v[at].T.astype(np.float64)).astype(np.int64)
        return v @ self.v[at].T

    def best(self, a: _Members, k: int, same: bool) -> tuple[np.ndarray, ...]:
        """The first ``k`` of each member's windows as ``(member, slot, id, score)`` columns.

        Only candidates of the member's own label take part if ``same``, otherwise only others. A
        member walks on while what is left may reach the lowest score that any of its windows needs.
        """
        slots = a.low.shape[1]
        need = np.where(a.low > a.high, _HIGHEST, a.low).ravel()
        lengths = _lengths(a.v)
        keys = ids = scores = np.empty(0, np.int64)
        walking, at, step = np.arange(len(a.ids)), 0, FIRST_STEP
        while at < len(self.order):
            may = lengths[walking] * self.reach[at]
            least = need.reshape(-1, slots)[walking].min(axis=1)
            walking = walking[(may + np.abs(may) * 1e-9 + 1e-3 >= least) & (least < _HIGHEST)]
            if not len(walking):
                break
            part = self.order[at:at + step]
            s = self.scores(a.v[walking], part)
            least = need.reshape(-1, slots)[walking].min(axis=1)
            most = a.high[walking].max(axis=1)
            fits = (s >= least[:, None]) & (s <= most[:, None])
            fits &= (self.labels[part] == a.labels[walking][:, None]) == same
            fits &= self.ids[part] != a.ids[walking][:, None]
            r, c = np.nonzero(fits)
            member, score, found = walking[r], s[r, c], self.ids[part][c]
            for slot in range(slots):
                key = member * slots + slot
                inside = (score >= need[key]) & (score <= a.high[member, slot])
                keys = np.concatenate((keys, key[inside]))
                scores = np.concatenate((scores, score[inside]))
                ids = np.concatenate((ids, found[inside]))
            order = np.lexsort((ids, -scores, keys))
            keys, scores, ids = keys[order], scores[order], ids[order]
            first = np.searchsorted(keys, keys)
            place = np.arange(len(keys)) - first
            last = place == k - 1
            need[keys[last]] = scores[last]
            kept = place < k
            keys, scores, ids = keys[kept], scores[kept], ids[kept]
            at, step = at + step, min(2 * step, LONGEST_STEP)
        return keys // slots, keys % slots, ids, scores


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch cut where its dimension, block, kind or cluster changes."""
    marks = np.stack([batch.column(c).to_numpy() for c in ("dim", "block", "kind", "cluster")])
    edges = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
    bounds = [0, *edges.tolist(), len(batch)]
    for a, b in zip(bounds, bounds[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def _search(rows: DataFrame, centres: dict[int, np.ndarray], widest: dict[tuple[int, int], float],
            k: int, same: bool) -> DataFrame:
    """Walks every block with the anchors that follow its candidates in a partition."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        block, place = None, None
        for part in (run for batch in batches for run in _runs(batch)):
            here = (part.column("dim")[0].as_py(), part.column("block")[0].as_py())
            if here != place:
                held, block, place = [], None, here
            if part.column("kind")[0].as_py() == 0:
                held.append(part)
                continue
            if block is None:
                if not held:
                    continue
                block = _Block(*(np.concatenate([h.column(c).to_numpy() for h in held])
                                 for c in ("vec_id", "label")),
                               np.concatenate([_matrix(h.column("v")) for h in held]))
                held = []
            cluster = part.column("cluster")[0].as_py()
            centre = centres[here[0]][cluster] if cluster >= 0 else None
            block.arrange(cluster, centre, widest.get((here[0], cluster), np.pi))
            for start in range(0, len(part), MEMBERS):
                some = part.slice(start, MEMBERS)
                a = _Members(some.column("vec_id").to_numpy(), some.column("label").to_numpy(),
                             *(_matrix(some.column(c)) for c in ("v", "low", "high")))
                member, slot, ids, scores = block.best(a, k, same)
                yield pa.record_batch([pa.array(a.ids[member]), pa.array(slot.astype(np.int32)),
                                       pa.array(ids), pa.array(scores)],
                                      ["anchor_id", "slot", "vec_id", "score"])
    return rows.mapInArrow(search, _FOUND)


def _best_of(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each anchor and slot, out of those of all blocks."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, anchors: DataFrame, *, positives: int = 5, negatives: int = 10,
         least_percent: int = 30, most_percent: int = 90, centres: int = CENTRES,
         block_bytes: int = BLOCK_BYTES, spread: int = SPREAD) -> DataFrame:
    """Hard negatives of ``anchors`` among ``vectors``, both ``(vec_id, label, dim, v)``.

    Ids are unique, and anchors are rows of ``vectors``. An anchor's positives are its ``positives``
    best other rows of its label. For each, the first ``negatives`` rows of other labels follow whose
    score is ``least_percent`` to ``most_percent`` of the positive's; a positive that scores below 0
    has none. Higher scores come first, ties by smaller id. Rows are compared with those of as many
    components. Returns ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``; no rows or no anchors give no rows.

    Nothing is approximate: centres and blocks decide only how far lists are walked. Candidates are
    shuffled once for each of both searches, and an anchor goes to each block.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "negatives")
    total = F.sum(F.lit(8) * F.col("dim").cast("bigint"))
    blocks = F.greatest(F.ceil(F.col("bytes") / block_bytes),
                        F.least(F.ceil(F.col("bytes") / SMALL_BYTES), F.lit(spread)), F.lit(1))
    sizes = scratch.write(vectors.groupBy("dim").agg(total.alias("bytes"))
                          .select("dim", blocks.cast("int").alias("blocks")), "sizes")
    parts = int(sizes.agg(F.sum("blocks")).first()[0] or 1)
    fitted = fit_centres(anchors, centres=centres)
    placed = scratch.write(_clustered(anchors.select("vec_id", "label", "dim", "v"), fitted), "anchors")
    # One row for each centre.
    widest = {(r.dim, r.cluster): r.angle for r in placed.filter("cluster >= 0")
              .groupBy("dim", "cluster").agg(F.max("angle").alias("angle")).collect()}
    none = F.array().cast("array<bigint>")
    candidates = vectors.join(sizes, "dim").select(
        "dim", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int").alias("block"), F.lit(0).alias("kind"),
        F.lit(-1).alias("cluster"), "vec_id", "label", "v", none.alias("low"), none.alias("high"))

    def found(windows: DataFrame, k: int, same: bool) -> DataFrame:
        everywhere = windows.join(sizes, "dim").select(
            "dim", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
            F.lit(1).alias("kind"), "cluster", "vec_id", "label", "v", "low", "high")
        rows = (candidates.unionByName(everywhere).repartition(parts, "dim", "block")
                .sortWithinPartitions("dim", "block", "kind", "cluster"))
        return _best_of(_search(rows, fitted, widest, k, same), k)

    wide = placed.select("*", F.array(F.lit(_LOWEST)).alias("low"), F.array(F.lit(_HIGHEST)).alias("high"))
    near = scratch.write(found(wide, positives, True).select(
        "anchor_id", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score")), "positives")
    # Whole numbers throughout: the least score is rounded up, the most down.
    p = F.col("positive_score")
    low = F.expr(f"{least_percent} * positive_score div 100") + F.when(
        F.pmod(p * least_percent, F.lit(100)) > 0, 1).otherwise(0)
    window = F.when(p >= 0, F.struct(low.alias("low"), F.expr(f"{most_percent} * positive_score div 100")
                                     .alias("high"))).otherwise(
        F.struct(F.lit(1).cast("bigint").alias("low"), F.lit(0).cast("bigint").alias("high")))
    windows = near.groupBy("anchor_id").agg(
        F.array_sort(F.collect_list(F.struct("slot", window.alias("w")))).alias("s"))
    empty = F.lit(positives) - F.size("s")
    bounds = windows.select(
        F.col("anchor_id").alias("vec_id"),
        F.concat(F.col("s.w.low"), F.array_repeat(F.lit(1).cast("bigint"), empty)).alias("low"),
        F.concat(F.col("s.w.high"), F.array_repeat(F.lit(0).cast("bigint"), empty)).alias("high"))
    far = found(placed.join(bounds, "vec_id"), negatives, False)
    return far.join(near, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def relabelled(vectors: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """The label noise of the mining query: rows of ids divisible by ``every`` move to the next one."""
    moved = F.col("vec_id") % every == 0
    return vectors.withColumn("label", F.when(moved, (F.col("label").cast("bigint") + 1) % labels)
                              .otherwise(F.col("label").cast("bigint")))


def mine_negatives(vectors: DataFrame, anchor_every: int = 100) -> DataFrame:
    """``mine`` for the anchors whose id is divisible by ``anchor_every``, in a table of floating-point
    vectors ``(vec_id, embedding, label)``; other columns are ignored."""
    scratch = Scratch(vectors.sparkSession, "vectors")
    rows = scratch.write(quantised(relabelled(picked(vectors, "vec_id", "embedding", "label"))), "rows")
    return mine(rows, rows.filter(F.col("vec_id") % anchor_every == 0))
