"""Chat formatting of logged conversations, with DataFrame functions only.

A log often holds a conversation several times, each record with the turns so far. Hashes of
all turn prefixes, rolling over position and content, tell which records are the beginning of longer ones; only the others are
rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.staging import Scratch, picked

# The marks of the rendered form.
BEGIN, END = "<|im_start|>", "<|im_end|>"


def _told(value: Column) -> Column:
    """A text that tells NULL from empty, and where it ends."""
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.char_length(value).cast("string"), F.lit(":"), value))


def _shown(value: Column) -> Column:
    """Marks inside a text are broken up, so that it can't end its own turn."""
    safe = F.coalesce(value, F.lit(""))
    for mark in (BEGIN, END):
        safe = F.replace(safe, F.lit(mark), F.lit(f"{mark[:2]} {mark[2:]}"))
    return safe


def format_chats(turns: DataFrame) -> DataFrame:
    """The maximal conversations of ``turns(conv_id, turn, role, text)``, rendered.

    Other columns are ignored. Turns are put in order of ``turn``, NULL first, then role and
    text; repeated rows are kept. A conversation whose turns are the first ones of another,
    longer one is left out; of equal ones that with the smallest id stays. What rows without an
    id belong to isn't known, so each is a conversation of one turn, which stays without an id
    only if no equal one has any. NULL and empty texts differ as turns and render alike.
    Returns ``conv_id, n_turns, n_records`` (equal records, itself included) and ``rendered``.
    No rows give no rows.

    Conversations are grouped once and written; then only hashes are shuffled, equal ones folded
    in the map tasks, so a first turn or a conversation that is logged very often is no hot key.
    Nor are rows without an id: equal ones are folded before they are shuffled.
    """
    scratch = Scratch(turns.sparkSession, "chat")
    said = picked(turns, "conv_id", "turn", "role", "text")
    so_far = (Window.partitionBy("conv_id").orderBy("turn", "role", "text")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    one = F.lit(1).cast("bigint")
    shown = F.concat(F.lit(BEGIN), _shown(F.col("role")), F.lit("\n"), _shown(F.col("text")),
                     F.lit(f"{END}\n")).alias("shown")

    def turn_hash(seed: int, place: Column) -> Column:
        return F.xxhash64(F.lit(seed), place, _told(F.col("role")), _told(F.col("text")))

    def rolling(seed: int) -> Column:
        return F.bit_xor(turn_hash(seed, F.col("place"))).over(so_far)

    named = said.filter("conv_id IS NOT NULL").withColumn("place", F.row_number().over(so_far))
    named = named.select("conv_id", F.struct(
        "place", F.struct(rolling(1).alias("a"), rolling(2).alias("b")).alias("hash"),
        shown).alias("t"))
    chats = named.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    chats = chats.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), one.alias("n"),
        F.col("turns")["hash"].alias("prefixes"),
        F.array_join(F.col("turns")["shown"], "").alias("rendered"))
    alone = (said.filter("conv_id IS NULL").select("conv_id", shown, F.struct(
        turn_hash(1, F.lit(1)).alias("a"), turn_hash(2, F.lit(1)).alias("b")).alias("hash"))
        .groupBy("hash").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"),
                             F.min("shown").alias("rendered")))
    chats = scratch.write(chats.unionByName(alone.select(
        "conv_id", one.alias("n_turns"), "n", F.array("hash").alias("prefixes"), "rendered")),
        "chats")
    whole = (chats.groupBy(F.element_at("prefixes", -1).alias("hash"))
             .agg(F.sum("n").alias("n_records"), F.min("conv_id").alias("first")))
    proper = chats.select(F.explode(F.slice(
        "prefixes", F.lit(1), F.size("prefixes") - 1)).alias("hash")).distinct()
    largest = scratch.write(whole.join(proper, "hash", "left_anti"), "maximal")
    return (chats.withColumn("last", F.element_at("prefixes", -1)).drop("prefixes", "n")
            .join(largest, F.col("conv_id").eqNullSafe(F.col("first"))
                  & (F.col("last") == F.col("hash")))
            .select("conv_id", "n_turns", "n_records", "rendered"))
