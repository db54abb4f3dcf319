"""The corpus pipeline: stages over ``documents``, each written before the next one reads it.

Every stage works on all rows that its predecessor kept. All but the last return the columns of
the documents; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.decontaminate import contaminated
from tidemark.llm.langid import UNKNOWN, is_held_out, predict, train
from tidemark.llm.lines import drop_repeated_lines
from tidemark.llm.minhash import near_duplicates
from tidemark.llm.mixing import mix_sources
from tidemark.llm.queries import table
from tidemark.llm.staging import Scratch

#: The stages need trained machines and pseudorandom draws, which SQL can't express.
ORACLE_SQL = None

#: Below this score a text is in no language that is known.
LEAST_SCORE = 0.05


def _as_row(docs: DataFrame):
    return F.struct(*[docs[f"`{c}`"] for c in docs.columns])


def _row_key(docs: DataFrame, *columns: str):
    """Tells rows apart where ids are missing or repeated."""
    return F.xxhash64(*[F.struct(docs[c].isNull(), docs[c]) for c in columns])


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no letters or in which no language is recognised."""
    model = train(docs.filter(~is_held_out(F.col("doc_id"))))
    whole = docs.select(_as_row(docs).alias("row"), docs["text"])
    found = predict(whole, model, ("row",))
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)) \
        .select("row.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; documents stay, even with no line left."""
    found = drop_repeated_lines(docs, carry=docs.columns)
    changed = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("bigint")}
    return found.select(*[changed[c].alias(c) if c in changed else F.col(f"carried.`{c}`")
                          for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates on five-word shingles stays."""
    found = near_duplicates(docs, n=5, percent=80).filter("NOT kept").select("doc_id")
    return docs.join(found, "doc_id", "left_anti").select(*[docs[f"`{c}`"] for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold the question and the answer of a benchmark item go."""
    keyed = docs.select(_row_key(docs, "doc_id", "text").alias("doc_id"), docs["text"])
    found = contaminated(keyed, table(spark, sf_dir, "benchmark")).select(
        F.col("doc_id").alias("__key")).distinct()
    return (docs.select(_as_row(docs).alias("row"), _row_key(docs, "doc_id", "text").alias("__key"))
            .join(found, "__key", "left_anti").select("row.*"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of the documents, a row for each document that it takes words of.

    ``text`` holds the words that are taken, repeats included, piece after piece, a line each.
    Adds ``size, source_size, target, taken`` and ``mixed``, which says in the same order where
    each piece goes: ``shard``, ``slot`` and ``place`` in its block, with its first word in the
    document and its number of words. Columns of these names are replaced.
    """
    new = ["size", "source_size", "target", "taken", "mixed"]
    kept = [c for c in docs.columns if c.lower() not in new]
    carry = [c for c in kept if c.lower() != "text"]
    found = mix_sources(docs, carry=carry).documents.filter("taken > 0")
    text = F.array_join(F.transform("mixed", lambda m: m["text"]), "\n")
    found = found.withColumn("__text", text)
    changed = {"text": F.col("__text"), "n_chars": F.char_length("__text").cast("bigint")}
    mixed = F.transform("mixed", lambda m: m.dropFields("text")).alias("mixed")
    return found.select(*[changed[c].alias(c) if c in changed else F.col(f"carried.`{c}`")
                          for c in kept], *new[:-1], mixed)


STAGES = [
    ("language", keep_known_languages),
    ("lines", drop_lines),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
