"""Mixing sources to target weights, with DataFrame functions only.

The words of each source, one document after the other, are cut into blocks of fixed length.
Every slot of the mix draws a source, so that an output shard holds a multinomial number of
blocks of each; a source's slots are numbered through all shards, the numbers run through a
pseudorandom permutation of its block numbers, and blocks are joined by that number. The words
themselves are cut out of their documents and dealt to the slots.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.staging import Scratch, picked

WORD = r"[^\x20\x09-\x0D]+"
SPACE = " \t\n\v\f\r"
#: A word with the white space after it, so that lines outlive the cutting.
UNIT = rf"({WORD}[\x20\x09-\x0D]*)"
#: Documents that are put in order together, and how many such buckets make up the next level.
BUCKET_DOCS, BUCKET_FAN = 200, 256
#: Cells of the grid on which a drawn number meets the interval of its source.
CELLS = 4096
ROUNDS = 24


class Mix(NamedTuple):
    """``documents``: the rows with size, source_size, target, taken and what is taken (``mixed``);
    ``slots``: a block for each slot of each shard; ``pieces``: the words of documents that make a
    block, ``row`` telling rows apart; ``blocks``: the mix itself, a text for each slot."""
    documents: DataFrame
    slots: DataFrame
    pieces: DataFrame
    blocks: DataFrame


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _before(value: str, window) -> Column:
    """The sum over the rows before this one."""
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)),
                      F.lit(0)).cast("bigint")


def source_targets(sized: DataFrame, weights: Sequence[int] = (5, 2, 1), percent: int = 150,
                   cap: int = 2) -> DataFrame:
    """Per source its size and target words.

    Sources in order, NULL last, take the weights in turn and share ``percent`` / 100 of all
    words; none gets above ``cap`` times its size, the excess being shared anew. With sources in
    the order of cap to weight, those that are full come first, so two running sums decide. One
    row per source is all that meets in a task.
    """
    per = sized.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    all_rows = Window.orderBy(F.col("source").asc_nulls_last())
    share = F.array(*[F.lit(w) for w in weights])
    per = per.withColumn("sid", F.row_number().over(all_rows).cast("bigint") - 1)
    per = per.withColumn("w", F.get(share, (F.col("sid") % len(weights)).cast("int")).cast("bigint"))
    exact = lambda c: c.cast("decimal(38,0)")
    full, w = exact(F.col("source_size") * cap), exact(F.col("w"))
    per = per.withColumns({"full": full, "pool": exact(F.sum("source_size").over(
        all_rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) * percent)})
    lcm = 1
    for x in weights:
        lcm *= x
    by_fill = Window.orderBy(F.floor(F.col("full") * lcm / F.col("w")), "sid")
    to_here = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    per = per.withColumns({
        "taken_before": F.coalesce(F.sum("full").over(to_here), F.lit(0)).cast("decimal(38,0)"),
        "w_left": F.sum("w").over(from_here).cast("decimal(38,0)")})
    per = per.withColumn("is_full", F.col("full") * 100 * F.col("w_left")
                         <= w * (F.col("pool") - 100 * F.col("taken_before")))
    whole = by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = F.coalesce(F.sum(F.when(F.col("is_full"), F.col("full"))).over(whole), F.lit(0))
    open_w = F.sum(F.when(~F.col("is_full"), F.col("w"))).over(whole)
    rest = (F.col("w") * (F.col("pool") - 100 * filled)).cast("double") / (100 * open_w).cast("double")
    return per.select("sid", "source", "source_size",
                      F.when(F.col("is_full"), F.col("full").cast("double")).otherwise(rest)
                      .alias("target"))


def permuted(index: Column, size: Column, *key: Column) -> Column:
    """A pseudorandom permutation of 0 .. size - 1, chosen by ``key``: in each round ``x`` and
    ``k - x`` change places or not, by a bit that both agree on."""
    def step(x: Column, r: Column) -> Column:
        y = F.pmod(F.pmod(F.xxhash64(F.lit(1), r, *key), size) - x, size)
        swap = F.xxhash64(F.lit(2), r, F.greatest(x, y), *key).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, y).otherwise(x)
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index, step)


def _grid(intervals: DataFrame, step: int, *columns: str) -> DataFrame:
    """Half-open intervals ``lo`` to ``hi`` with the cells that they touch."""
    cells = F.sequence(F.floor(F.col("lo") / step), F.floor((F.col("hi") - 1) / step))
    return intervals.filter("lo < hi").select(F.explode(cells).alias("cell"), "lo", "hi", *columns)


def mix_sources(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), percent: int = 150,
                cap: int = 2, block_words: int = 128, shard_slots: int = 1024,
                seed: int = 7, carry: Sequence[str] = ()) -> Mix:
    """Mixes ``docs(doc_id, text, source)`` by source; other columns are ignored.

    A document's size is its number of words (``[^\\x20\\x09-\\x0D]+``), 0 for NULL. ``documents``
    has a row for every row: ``doc_id, size, source_size, target, taken, mixed``. ``mixed`` lists
    what the mix takes of the row, repeats included: ``shard`` and ``slot`` where it goes,
    ``place``, the number of words before it in the slot's block, ``first_word`` in the document,
    ``words`` and their ``text``; ``taken`` is the sum of its words. With ``carry`` the row has also
    those columns as the struct ``carried``. ``blocks`` has the same by slot: ``shard, slot, source,
    block, words, text``, the pieces of a block in order of place, a line each. A source's number of slots is its target in
    blocks, rounded; draws above it go to the sources that were drawn too seldom. A block is used
    ``cap`` times at most, so no document gives more than ``cap`` times its size. NULL is a source
    of its own; rows of one id each count; empty texts take no part. The same rows give the same
    mix. No rows give no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    carried = [F.struct(*[docs[f"`{c}`"] for c in carry]).alias("carried")] if carry else []
    # The number of a row holds as long as it is read from the written table.
    texts = scratch.write(docs.select(
        F.monotonically_increasing_id().alias("row"), docs["doc_id"], docs["source"],
        n_words(docs["text"]).alias("size"), docs["text"], *carried), "texts")
    sized = scratch.write(texts.select("row", "doc_id", "source", "size", F.xxhash64("text")
                                       .alias("print")), "sized")
    n_docs = sized.count()
    buckets = max(1, -(-n_docs // BUCKET_DOCS))
    sources = source_targets(sized, weights, percent, cap)
    blocks = F.ceil(F.col("source_size") / block_words).cast("bigint")
    quota = F.when(F.col("source_size") > 0, F.least(
        F.round(F.col("target") * blocks / F.col("source_size")).cast("bigint"), cap * blocks))
    sources = scratch.write(sources.withColumns({
        "blocks": blocks, "quota": F.coalesce(quota, F.lit(0)).cast("bigint")}), "sources")

    known = sources.withColumnRenamed("source", "name")
    rows = (sized.join(known, F.col("source").eqNullSafe(F.col("name")))
            .withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size", "print"),
                                         F.lit(buckets)))
            .select("row", "doc_id", "sid", "bucket", "size", "print", "source_size", "target"))
    # Rows alike in all that is ordered by can change places and the mix stays the same.
    inner = Window.partitionBy("sid", "bucket").orderBy("doc_id", "size", "print", "row")
    rows = scratch.write(rows.withColumn("inner", _before("size", inner)), "rows")
    per_bucket = (rows.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
                  .withColumn("tier", F.floor(F.col("bucket") / BUCKET_FAN)))
    per_tier = per_bucket.groupBy("sid", "tier").agg(F.sum("words").alias("words"))
    tiers = per_tier.select("sid", "tier", _before("words", Window.partitionBy("sid")
                                                   .orderBy("tier")).alias("tier_at"))
    starts = (per_bucket.withColumn("in_tier", _before(
        "words", Window.partitionBy("sid", "tier").orderBy("bucket")))
        .join(tiers, ["sid", "tier"])
        .select("sid", "bucket", (F.col("tier_at") + F.col("in_tier")).alias("bucket_at")))
    starts = scratch.write(starts, "starts")
    placed = (rows.join(starts, ["sid", "bucket"])
              .withColumn("at", F.col("bucket_at") + F.col("inner")))
    first, last = F.floor(F.col("at") / block_words), F.floor((F.col("at") + F.col("size") - 1)
                                                              / block_words)
    pieces = placed.filter("size > 0").select(
        "row", "sid", "doc_id", "size", "at", F.explode(F.sequence(first, last)).alias("block"))
    begins = F.greatest(F.col("at"), F.col("block") * block_words)
    ends = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block_words)
    pieces = pieces.select("row", "sid", "block", "doc_id",
                           (begins - F.col("block") * block_words).alias("place"),
                           (begins - F.col("at")).alias("first_word"), (ends - begins).alias("words"))

    slots = scratch.write(_slots(spark, scratch, sources, shard_slots, seed), "slots")
    takes = pieces.join(slots, ["sid", "block"]).groupBy("row").agg(F.array_sort(F.collect_list(
        F.struct("shard", "slot", "place", "first_word", "words"))).alias("takes"))
    takes = scratch.write(takes, "takes")
    per_row = rows.select("row", "source_size", "target").join(takes, "row", "left")
    # The words of a text are bound to a variable, so that they are found once, not for each piece.
    cut = F.transform(
        F.array(F.regexp_extract_all("text", F.lit(UNIT), F.lit(1))), lambda w: F.transform(
            F.col("takes"), lambda t: F.struct(
                *[t[c].alias(c) for c in ("shard", "slot", "place", "first_word", "words")],
                F.rtrim(F.array_join(F.slice(w, (t["first_word"] + 1).cast("int"),
                                             t["words"].cast("int")), ""), F.lit(SPACE))
                .alias("text"))))
    none = F.array().cast("array<struct<shard:bigint,slot:bigint,place:bigint,first_word:bigint,"
                          "words:bigint,text:string>>")
    dealt = texts.join(per_row, "row").select(
        "row", "doc_id", "source", "size", "source_size", "target", *(["carried"] if carry else []),
        F.coalesce(F.when(F.col("takes").isNotNull(), cut[0]), none).alias("mixed"))
    taken = F.aggregate("mixed", F.lit(0).cast("bigint"), lambda n, m: n + m["words"])
    documents = dealt.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "mixed",
                             *(["carried"] if carry else []))
    parts = dealt.select("source", F.explode("mixed").alias("m")).groupBy("m.shard", "m.slot").agg(
        F.first("source").alias("source"), F.sum("m.words").alias("words"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("m.place", "m.text"))),
                                 lambda m: m["text"]), "\n").alias("text"))
    blocks = slots.select("shard", "slot", "block").join(parts, ["shard", "slot"]).select(
        "shard", "slot", "source", "block", "words", "text")
    return Mix(documents, slots, pieces, blocks)


def _slots(spark, scratch: Scratch, sources: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """Every slot of the mix with its shard, source and block."""
    in_order = Window.orderBy("sid")
    quotas = sources.select("sid", "blocks", "quota", _before("quota", in_order).alias("lo"))
    quotas = quotas.withColumn("hi", F.col("lo") + F.col("quota"))
    n_slots = sources.agg(F.sum("quota")).first()[0] or 0
    step = max(1, n_slots // CELLS)
    grid = scratch.write(_grid(quotas, step, "sid"), "grid")
    drawn = spark.range(n_slots).select(
        F.col("id").alias("slot"), F.floor(F.col("id") / shard_slots).alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(1, n_slots))).alias("u"))
    drawn = (drawn.withColumn("cell", F.floor(F.col("u") / step)).join(grid, "cell")
             .filter("lo <= u AND u < hi").select("slot", "shard", "sid"))
    drawn = scratch.write(drawn, "drawn")

    counts = drawn.groupBy("shard", "sid").agg(F.count(F.lit(1)).alias("n"))
    by_shard = Window.partitionBy("sid").orderBy("shard")
    counts = scratch.write(counts.withColumn("before", _before("n", by_shard)), "counts")
    totals = (sources.select("sid", "blocks", "quota")
              .join(counts.groupBy("sid").agg(F.sum("n").alias("n")), "sid", "left")
              .withColumn("n", F.coalesce("n", F.lit(0))))
    spare, lack = F.greatest(F.col("n") - F.col("quota"), F.lit(0)), \
        F.greatest(F.col("quota") - F.col("n"), F.lit(0))
    totals = totals.withColumns({"spare": spare, "lack": lack})
    totals = scratch.write(totals.withColumns({"spare_at": _before("spare", in_order),
                                               "lo": _before("lack", in_order)}), "totals")
    ranked = (drawn.withColumn("k", F.row_number().over(
        Window.partitionBy("shard", "sid").orderBy("slot")) - 1)
        .join(counts.drop("n"), ["shard", "sid"])
        .withColumn("k", F.col("k") + F.col("before"))
        .join(totals.select("sid", "blocks", "quota", "spare_at"), "sid"))
    kept = ranked.filter("k < quota").select("shard", "slot", "sid", "blocks", "k")
    lacking = _grid(totals.withColumn("hi", F.col("lo") + F.col("lack")), step,
                    F.col("sid").alias("to"), "n", "blocks")
    moved = (ranked.filter("k >= quota").drop("blocks", "sid")
             .withColumn("u", F.col("spare_at") + F.col("k") - F.col("quota"))
             .withColumn("cell", F.floor(F.col("u") / step)).join(lacking, "cell")
             .filter("lo <= u AND u < hi")
             .select("shard", "slot", F.col("to").alias("sid"), "blocks",
                     (F.col("n") + F.col("u") - F.col("lo")).alias("k")))
    return (kept.unionByName(moved)
            .withColumn("round", F.floor(F.col("k") / F.col("blocks")))
            .select("shard", "slot", "sid", permuted(
                F.pmod("k", "blocks"), F.col("blocks"), F.lit(seed), F.col("sid"), F.col("round"))
                .alias("block")))
