"""Line dedup that can be undone: reference counts of lines, with cuckoo filters before them.

The index has three tables. ``references`` holds a row for each line key of each document,
``counts`` the exact number of references, the smallest and the largest document of each key,
and ``filters`` one cuckoo filter per shard of keys. A batch of documents is folded to distinct
keys first; keys that the filter of their shard doesn't know are new and skip the exact table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm import cuckoo
from tidemark.llm.staging import Scratch, picked

SPACE = " \t\n\v\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stands for a NULL id, which counts as larger than all others.
LAST_ID = (1 << 63) - 1
SHARD_KEYS = 4096

_FOLD = str.maketrans(UPPER, LOWER)
COUNTS = "key binary, shard bigint, n bigint, first bigint, last bigint"
FILTERS = "shard bigint, segments array<binary>"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def _order(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("bigint"), F.lit(LAST_ID))


def _row(text: Column) -> Column:
    """Tells rows of one id apart by their text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def references(docs: DataFrame, min_chars: int, shards: int) -> DataFrame:
    """A row for each distinct line key of ``min_chars`` or more in each row of ``docs``."""
    keys = F.array_distinct(F.filter(
        F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), line_key),
        lambda k: F.char_length(k) >= min_chars))
    exploded = picked(docs, "doc_id", "text").select(
        _order(F.col("doc_id")).alias("doc"), _row(F.col("text")).alias("row"),
        F.explode(keys).alias("line"))
    key = F.unhex(F.md5("line"))
    return exploded.select(key.alias("key"), "doc", "row").withColumn(
        "shard", F.pmod(F.xxhash64("key"), F.lit(shards)))


def _counted(references_: DataFrame) -> DataFrame:
    return references_.groupBy("key", "shard").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc").alias("first"), F.max("doc").alias("last"))


def _short(keys: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The first 8 bytes of each digest as a number."""
    return np.frombuffer(b"".join(k[:8] for k in keys.to_pylist()), np.uint64)


def _segments(filters: pa.Table) -> list[bytes]:
    return filters.column("segments")[0].as_py() if filters.num_rows else []


def _probe(keys: pa.Table, filters: pa.Table) -> pa.Table:
    known = cuckoo.contains(_segments(filters), _short(keys["key"])) if keys.num_rows \
        else np.zeros(0, bool)
    return keys.append_column("known", pa.array(known, pa.bool_()))


def _changed(change):
    def run(keys: pa.Table, filters: pa.Table) -> pa.Table:
        segments = _segments(filters)
        if keys.num_rows:
            segments = change(segments, _short(keys["key"]))
        shard = (keys if keys.num_rows else filters)["shard"][0].as_py()
        return pa.table([pa.array([shard], pa.int64()),
                         pa.array([segments], pa.list_(pa.binary()))], names=["shard", "segments"])
    return run


def _rebuilt(keys: pa.Table) -> pa.Table:
    segments = [cuckoo.build(_short(keys["key"]))]
    return pa.table([keys["shard"].slice(0, 1), pa.array([segments], pa.list_(pa.binary()))],
                    names=["shard", "segments"])


@dataclass
class LineIndex:
    """The three tables after some inserts and deletes; every change makes a new index."""
    references: DataFrame
    counts: DataFrame
    filters: DataFrame
    scratch: Scratch

    @classmethod
    def empty(cls, spark, scratch: Scratch | None = None) -> LineIndex:
        make = lambda schema: spark.createDataFrame([], schema)
        return cls(make("key binary, doc bigint, row bigint, shard bigint"), make(COUNTS),
                   make(FILTERS), scratch or Scratch(spark, "lines"))

    def _with_filters(self, keys: DataFrame, change, counts: DataFrame) -> DataFrame:
        """The changed filters; one that has outgrown its segment is built anew, larger, from the
        keys that its shard holds."""
        changed = (keys.select("key", "shard").groupBy("shard")
                   .cogroup(self.filters.groupBy("shard")).applyInArrow(_changed(change), FILTERS))
        changed = self.scratch.write(changed, "filters")
        grown = changed.filter(F.size("segments") > 1).select("shard")
        if grown.isEmpty():
            return changed
        rebuilt = (counts.select("key", "shard").join(grown, "shard", "left_semi")
                   .select("key", "shard").groupBy("shard").applyInArrow(_rebuilt, FILTERS))
        return self.scratch.write(changed.filter(F.size("segments") <= 1).unionByName(rebuilt),
                                  "filters")

    def insert(self, batch: DataFrame, keep_filters: bool = True) -> LineIndex:
        """Adds references. Without ``keep_filters`` no more can be added or taken out."""
        new = self.scratch.write(_counted(batch), "batch")
        probed = self.scratch.write(
            new.groupBy("shard").cogroup(self.filters.groupBy("shard"))
            .applyInArrow(_probe, COUNTS + ", known boolean"), "probed")
        known, unknown = probed.filter("known").drop("known"), probed.filter("NOT known").drop("known")
        held = self.counts.select("key", F.col("n").alias("n_"), F.col("first").alias("first_"),
                                  F.col("last").alias("last_"))
        met = self.scratch.write(known.join(held, "key", "left"), "met")
        updated = met.select("key", "shard", (F.col("n") + F.coalesce("n_", F.lit(0))).alias("n"),
                             F.least("first", "first_").alias("first"),
                             F.greatest("last", "last_").alias("last"))
        untouched = self.counts.join(met.filter("n_ IS NOT NULL").select("key"), "key", "left_anti")
        counts = self.scratch.write(untouched.unionByName(updated).unionByName(unknown), "counts")
        fresh = unknown.unionByName(met.filter("n_ IS NULL").select(*unknown.columns))
        filters = self._with_filters(fresh, cuckoo.insert, counts) if keep_filters else self.filters
        return LineIndex(self.references.unionByName(batch), counts, filters, self.scratch)

    def delete(self, ids: DataFrame) -> LineIndex:
        """Takes out the documents of ``ids(doc_id)``; keys that no one holds leave the filters."""
        gone = ids.select(_order(F.col("doc_id")).alias("doc")).distinct()
        left = self.references.join(gone, "doc", "left_anti").select(*self.references.columns)
        touched = self.scratch.write(self.references.join(gone, "doc", "left_semi")
                                     .select("key", "shard").distinct(), "touched")
        recounted = self.scratch.write(_counted(left.join(touched.select("key"), "key", "left_semi")),
                                       "recounted")
        counts = self.scratch.write(self.counts.join(touched.select("key"), "key", "left_anti")
                                    .unionByName(recounted), "counts")
        dead = touched.join(recounted.select("key"), "key", "left_anti")
        return LineIndex(self.scratch.write(left, "references"), counts,
                         self._with_filters(dead, cuckoo.delete, counts), self.scratch)

    def dropped(self) -> DataFrame:
        """Per document row the keys whose lines go, the smallest document keeping its own."""
        shared = self.scratch.write(self.counts.filter("first < last").select("key", "first"),
                                    "shared")
        return (self.references.join(shared, "key").filter("doc <> first")
                .groupBy("doc", "row").agg(F.collect_list("key").alias("gone")))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts lines and takes out those whose key is among the dropped ones."""
    for batch in batches:
        n_lines, n_dropped, kept = [], [], []
        for text, gone in zip(batch["__text"].to_pylist(), batch["__gone"].to_pylist()):
            lines = (text or "").split("\n")
            n_lines.append(len(lines))
            if gone:
                gone = set(gone)
                left = [x for x in lines if hashlib.md5(
                    x.strip(SPACE).translate(_FOLD).encode()).digest() not in gone]
                text = "\n".join(left)
                n_dropped.append(len(lines) - len(left))
            else:
                n_dropped.append(0)
            kept.append(text or "")
        rest = [i for i, n in enumerate(batch.schema.names) if n not in ("__text", "__gone")]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(i) for i in rest], pa.array(n_lines, pa.int64()),
             pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())],
            names=[*[batch.schema.names[i] for i in rest], "n_lines", "n_dropped", "kept_text"])


def drop_repeated_lines(docs: DataFrame, min_chars: int = 10, batches: int = 2,
                        carry: Sequence[str] = ()) -> DataFrame:
    """Lines that several documents hold stay only in the document with the smallest id.

    ``docs`` needs ``doc_id`` (integer) and ``text``; other columns are ignored. Texts are split
    at \\n, NULL and empty ones being one empty line. A line's key is the line without white
    space at its ends, A-Z lower-cased; keys below ``min_chars`` code points are left alone.
    Returns for every row ``doc_id, n_lines, n_dropped, kept_text``, with ``carry`` also those
    columns as the struct ``carried``. Rows of one id are one document; a NULL id counts as larger
    than all others. No rows give no rows.

    The documents are inserted in ``batches`` parts, chosen by a hash of the id, as they would
    come in day by day. Hot lines are folded in the map tasks before any shuffle; the join that
    finds their lines reads two stored tables, so that Spark can split a hot key.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lines")
    all_refs = references(docs, min_chars, 1 << 62).withColumn(
        "part", F.pmod(F.xxhash64("doc"), F.lit(batches)))
    all_refs = scratch.write(all_refs, "references")
    shards = max(1, all_refs.count() // SHARD_KEYS)
    all_refs = all_refs.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    index = LineIndex.empty(spark, scratch)
    for part in range(batches):
        batch = all_refs.filter(F.col("part") == part).drop("part")
        index = index.insert(batch, keep_filters=part < batches - 1)
    gone = LineIndex(all_refs.drop("part"), index.counts, index.filters, scratch).dropped()
    gone = scratch.write(gone, "gone")
    scratch.release("references", "batch", "probed", "met", "counts", "filters", "shared")
    taken = [F.struct(*[docs[f"`{c}`"] for c in carry]).alias("carried")] if carry else []
    rows = docs.select(docs["doc_id"], docs["text"].alias("__text"),
                       _order(docs["doc_id"]).alias("doc"), _row(docs["text"]).alias("row"), *taken)
    joined = rows.join(gone, ["doc", "row"], "left").select(
        "doc_id", *(["carried"] if carry else []), F.col("gone").alias("__gone"), "__text")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields
              if f.name not in ("__gone", "__text")]
    return joined.mapInArrow(_kept, ", ".join(fields) + ", n_lines bigint, n_dropped bigint, "
                                                        "kept_text string")
