"""Exact dedup by recipes of content-defined chunks, with DataFrame functions only.

A text is cut where its own content says so, so equal passages give equal chunks wherever they
stand. Every chunk travels once, copies folded in the map tasks, and gets an identifier that is
verified against the chunk's content. From then on a document is its recipe, the ordered list of
identifiers: a hundredth of its size, and two texts are equal if and only if their recipes are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.staging import Scratch, picked

#: What is deleted before texts are compared.
BLANKS = r"[\x20\x09-\x0D]+"
#: A chunk ends behind the first of these marks at or after its shortest length.
MARKS = "[.!?。！？؟।]"
SHORTEST, LONGEST = 512, 4096


def normalised(text: Column) -> Column:
    """The text without blanks; NULL is an empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, "")


def cut(text: Column, shortest: int = SHORTEST, longest: int = LONGEST) -> Column:
    """The chunks of a text in order; an empty text has none."""
    pattern = f"(?s).{{{shortest - 1},{longest - 1}}}?{MARKS}|.{{1,{longest}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


@dataclass
class Recipes:
    """What dedup leaves.

    ``documents`` has a row per document, ``chunks`` is the store ``(hash, variant, chunk,
    n_places)``, put together when it is read, and ``recipes`` gives each ``row`` its ``hashes`` in order and, as ``(place,
    variant)``, those that stand for another than the first chunk of their hash.
    """

    documents: DataFrame
    chunks: DataFrame
    recipes: DataFrame

    def texts(self) -> DataFrame:
        """``(row, text)``: each normalised text put together again from the store."""
        places = self.recipes.select("row", "variants", F.posexplode("hashes").alias("place", "hash"))
        odd = F.filter("variants", lambda v: v["place"] == F.col("place"))
        places = places.select("row", "place", "hash",
                               F.coalesce(F.get(odd, 0)["variant"], F.lit(0)).alias("variant"))
        found = places.join(self.chunks.select("hash", "variant", "chunk"), ["hash", "variant"])
        whole = found.groupBy("row").agg(F.array_join(
            F.array_sort(F.collect_list(F.struct("place", "chunk")))["chunk"], "").alias("text"))
        return (self.recipes.select("row").join(whole, "row", "left")
                .select("row", F.coalesce("text", F.lit("")).alias("text")))


def _store(cut_texts: DataFrame, hashed: Callable[[Column], Column]) -> DataFrame:
    """``(hash, chunk, n_places)``: each chunk once, copies folded in the map tasks."""
    return (cut_texts.select(F.explode("chunks").alias("chunk"))
            .groupBy(hashed(F.col("chunk")).alias("hash"), "chunk")
            .agg(F.count(F.lit(1)).alias("n_places")))


def _variants(cut_texts: DataFrame, hashed: Callable[[Column], Column],
              scratch: Scratch) -> DataFrame:
    """The chunks that share a hash with another, numbered from 0; rarely any.

    This is where hashes are verified: each chunk travels once to be compared with those of its
    hash. What is shared is stored, so that Spark knows how little it is and sends it to the texts.
    """
    shared = scratch.write(_store(cut_texts, hashed).groupBy("hash")
                           .agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash"), "shared")
    order = Window.partitionBy("hash").orderBy("chunk")
    chunks = cut_texts.select(F.explode("chunks").alias("chunk")).withColumn("hash", hashed(F.col("chunk")))
    return scratch.write(
        chunks.join(shared, "hash").distinct()
        .withColumn("variant", (F.row_number().over(order) - 1).cast("int")), "variants")


def dedupe_texts(docs: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST,
                 hashed: Callable[[Column], Column] = F.xxhash64) -> Recipes:
    """Groups of texts that are equal but for blanks.

    ``docs`` needs ``doc_id`` (integer) and ``text``; other columns are ignored. Of a group the row
    with the most code points in its text stays, then that with the smallest ``doc_id``, NULL last;
    of repeated rows one stays. NULL is an empty text, and texts without anything but blanks are
    equal. ``documents`` has ``row, doc_id, keep_id, group_size, kept, text_sha256, n_chunks`` for
    every row; no rows give no rows.

    Chunks have ``shortest`` to ``longest`` code points; where no mark comes, as in scripts without
    any, they have ``longest``. That concerns only how much two different texts share.
    ``hashed`` may give different chunks one hash: they are told apart by content.

    Texts are cut and written once, and their chunks are shuffled once, to verify them. The largest group of copies
    is folded in the map tasks; in the join that follows it is on the side that adaptive execution
    splits.
    """
    scratch = Scratch(docs.sparkSession, "chunks")
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = picked(docs, "doc_id", "text").select(
        "doc_id", F.char_length(text).alias("n_chars"), normalised(F.col("text")).alias("plain"))
    whole = scratch.write(plain.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_chars",
        F.sha2("plain", 256).alias("text_sha256"), cut(F.col("plain"), shortest, longest)
        .alias("chunks")), "cut")

    variants = _variants(whole, hashed, scratch)
    # Stored like the variants themselves: without any, nothing is read for it again.
    odd = scratch.write(
        whole.select("row", F.posexplode("chunks").alias("place", "chunk"))
        .withColumn("hash", hashed(F.col("chunk"))).join(variants, ["hash", "chunk"])
        .filter("variant > 0").groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("place", "variant"))).alias("variants")), "odd")
    none = F.array().cast("array<struct<place:int,variant:int>>")
    recipes = scratch.write(
        whole.select("row", "doc_id", "n_chars", "text_sha256",
                     F.transform("chunks", lambda c: hashed(c)).alias("hashes")).join(odd, "row", "left")
        .withColumn("variants", F.coalesce("variants", none)), "recipes")

    best = F.min(F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), "doc_id", "row"))
    groups = scratch.write(
        recipes.groupBy("hashes", "variants").agg(best.alias("best"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select("hashes", "variants", F.col("best.doc_id").alias("keep_id"),
                                F.col("best.row").alias("keep_row"), "n"), "groups")
    alone = F.col("keep_row").isNull()
    documents = recipes.join(groups, ["hashes", "variants"], "left").select(
        "row", "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("bigint")).alias("group_size"),
        (alone | (F.col("keep_row") == F.col("row"))).alias("kept"), "text_sha256",
        F.size("hashes").alias("n_chunks"))
    numbered = _store(whole, hashed).join(variants, ["hash", "chunk"], "left").select(
        "hash", F.coalesce("variant", F.lit(0)).alias("variant"), "chunk", "n_places")
    return Recipes(documents, numbered, recipes.select("row", "hashes", "variants"))
