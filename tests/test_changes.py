"""Hashes, diffs, soft delete, upsert and effective dates on small tables."""

import random
from datetime import datetime

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from tidemark.functions.hashing import (
    deleted_hash, hash_keeping_nulls, hash_skipping_nulls, with_change_hash,
)
from tidemark.operators.diff import diff_snapshots, label_changes, label_changes_by_hash
from tidemark.operators.effective import refresh_current_flag, with_current_flag
from tidemark.operators.keys import (
    assign_surrogates, dealt_by_key, duplicate_keys, next_surrogate, one_row_per_key, require_unique,
)
from tidemark.operators.setops import rows_except, rows_intersect, union_by_name
from tidemark.operators.upsert import merge_upsert, soft_delete, sync_upsert

AS_OF = "2024-05-01 00:00:00"
LATER = "2024-06-01 00:00:00"
NOW, THEN = datetime(2024, 5, 1), datetime(2024, 1, 1)
STATE = ("k long, v string, start_date timestamp_ntz, end_date timestamp_ntz, "
         "creation_date timestamp_ntz, update_date timestamp_ntz, change_hash string")
SOURCE = "k long, v string, end_date timestamp_ntz, change_hash string"


@pytest.fixture
def state(spark):
    def make(*given):
        full = [(k, v, THEN, end, THEN, THEN, h) for k, v, end, h in given]
        return spark.createDataFrame(full, STATE)
    return make


@pytest.fixture
def source(spark):
    def make(*given):
        return spark.createDataFrame([(k, v, None, h) for k, v, h in given], SOURCE)
    return make


def test_hash_null_slots(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    skipping = [r[0] for r in df.select(hash_skipping_nulls("x", "y", "z")).collect()]
    keeping = [r[0] for r in df.select(hash_keeping_nulls("x", "y", "z")).collect()]
    assert skipping[0] == skipping[1]
    assert keeping[0] != keeping[1]
    assert all(len(h) == 40 for h in skipping + keeping)


def test_diff_null_key_counts_as_new(spark, rows):
    old = spark.createDataFrame([(None, "a"), (1, "x")], "k int, v string")
    new = spark.createDataFrame([(None, "b"), (1, "x"), (1, "x")], "k int, v string")
    parts = diff_snapshots(new, old, "k")
    assert rows(parts.new) == [(None, "b")]
    assert rows(parts.deleted) == [(None, "a")]
    assert rows(parts.modified) == []
    assert rows(parts.unmodified) == [(1, "x")]


@pytest.mark.parametrize("seed", range(4))
def test_diff_equals_set_operations(spark, rows, seed):
    """Keys repeat, are NULL, and half of all rows share one."""
    rng = random.Random(seed)
    def snapshot():
        return spark.createDataFrame(
            [(7 if rng.random() < .5 else rng.choice([None, *range(12)]),
              rng.choice([None, "a", "b", "c"])) for _ in range(40)], "k int, v string")
    new, old = snapshot(), snapshot()
    came = new.subtract(old)
    modified = came.join(old, "k", "left_semi")
    parts = diff_snapshots(new, old, "k")
    assert rows(parts.new) == rows(came.join(old, "k", "left_anti"))
    assert rows(parts.modified) == rows(modified)
    assert rows(parts.deleted) == rows(old.subtract(new).join(modified, "k", "left_anti"))
    assert rows(parts.unmodified) == rows(new.intersect(old))
    assert rows(rows_except(new, old)) == rows(came)
    assert rows(rows_intersect(new, old)) == rows(new.intersect(old))


def test_diff_by_hash_equals_diff(spark, rows):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, None), (4, "d")], "k int, v string")
    for df in (old, new):
        require_unique(df, ["k"])
    hashed = [with_change_hash(df, ["k", "v"], into="h") for df in (new, old)]
    assert rows(label_changes_by_hash(*hashed, "k", "h").drop("h")) == \
        rows(label_changes(new, old, "k"))


def test_diff_parts_rebuild_the_new_snapshot(spark, rows):
    old = spark.range(50).select("id", (F.col("id") % 7).alias("v"))
    new = spark.range(20, 80).select("id", (F.col("id") % 5).alias("v"))
    parts = diff_snapshots(new, old, "id")
    assert rows(parts.new.union(parts.modified).union(parts.unmodified)) == rows(new)


def test_union_by_name_fills_nulls(spark, rows):
    first = spark.createDataFrame([(1, "a")], "x int, y string")
    second = spark.createDataFrame([(True, 2)], "z boolean, x int")
    assert rows(union_by_name(first, second)) == [(1, "a", None), (2, None, True)]


def test_merge_inserts_updates_and_keeps(state, source, rows):
    merged = merge_upsert(state((1, "a", None, "h1"), (2, "b", None, "h2")),
                          source((2, "B", "h2x"), (3, "c", "h3")), ["k"], AS_OF, action_col="did")
    assert rows(merged) == [
        (1, "a", THEN, None, THEN, THEN, "h1", "same"),
        (2, "B", THEN, None, THEN, NOW, "h2x", "update"),
        (3, "c", NOW, None, NOW, NOW, "h3", "insert")]


def test_merge_null_keys_are_inserted_each_time(state, source, rows):
    once = merge_upsert(state(), source((None, "a", "h"), (None, "b", "g")), ["k"], AS_OF)
    twice = merge_upsert(once, source((None, "a", "h"), (None, "b", "g")), ["k"], AS_OF)
    assert rows(twice, "k", "v") == [(None, "a"), (None, "a"), (None, "b"), (None, "b")]


def test_merge_null_safe_keys_match(state, source, rows):
    merged = merge_upsert(state((None, "a", None, "h")), source((None, "b", "g")), ["k"], AS_OF,
                          null_safe=True)
    assert rows(merged, "k", "v") == [(None, "b")]


@pytest.mark.parametrize("ours, theirs", [(None, "h"), ("h", None), (None, None)])
def test_merge_null_hash_means_no_update(state, source, rows, ours, theirs):
    merged = merge_upsert(state((1, "a", None, ours)), source((1, "b", theirs)), ["k"], AS_OF)
    assert rows(merged, "k", "v") == [(1, "a")]


def test_merge_duplicate_source_keys(state, source, rows):
    twice = source((1, "low", "h1"), (1, "high", "h2"))
    with pytest.raises(SparkRuntimeException, match="duplicate source key"):
        merge_upsert(state((1, "a", None, "h")), twice, ["k"], AS_OF).collect()
    settled = merge_upsert(state((1, "a", None, "h")), twice, ["k"], AS_OF, on_duplicate="largest")
    assert rows(settled, "k", "v") == [(1, "high")]
    with pytest.raises(ValueError):
        merge_upsert(state(), twice, ["k"], AS_OF, on_duplicate="whatever")


def test_merge_updates_every_target_row_of_a_key(state, source, rows):
    merged = merge_upsert(state((1, "a", None, "h"), (1, "b", None, "h"), (2, "c", None, "h")),
                          source((1, "z", "g")), ["k"], AS_OF)
    assert rows(merged, "k", "v") == [(1, "z"), (1, "z"), (2, "c")]


def test_merge_twice_changes_nothing(state, source, rows):
    new = source((1, "b", "g"), (2, "c", "f"))
    once = merge_upsert(state((1, "a", None, "h")), new, ["k"], AS_OF)
    assert rows(merge_upsert(once, new, ["k"], LATER)) == rows(once)


def test_merge_maps_by_name(spark, rows):
    target = spark.createDataFrame([(1, "a", "t", "h")], "k int, v string, own string, hash string")
    source = spark.createDataFrame([("g", "b", 1), ("f", "c", 2)], "hash string, V string, k int")
    merged = merge_upsert(target, source, ["k"], AS_OF, hash_col="hash", stamp_on_update=(),
                          stamp_on_insert=(), keep_on_update=())
    assert rows(merged) == [(1, "b", "t", "g"), (2, "c", None, "f")]


def test_soft_delete_closes_open_rows_only(state, source, rows):
    before = state((1, "a", None, "h"), (2, "b", THEN, "old"), (3, "c", None, "h"),
                   (None, "n", None, "h"))
    after = soft_delete(before, source((1, "a", "h"), (1, "again", "h")), ["k"], AS_OF)
    gone = before.select(deleted_hash()).first()[0]
    assert rows(after, "k", "end_date", "update_date", "change_hash") == sorted([
        (1, None, THEN, "h"), (2, THEN, THEN, "old"), (3, NOW, NOW, gone),
        (None, NOW, NOW, gone)], key=repr)
    assert rows(soft_delete(after, source((1, "a", "h")), ["k"], LATER)) == rows(after)


def test_soft_delete_restamps_closed_rows_on_demand(state, source, rows):
    after = soft_delete(state((1, "a", THEN, "x"), (2, "b", THEN, "y")),
                        source((1, "a", "x")), ["k"], AS_OF, restamp_closed=True)
    assert rows(after, "k", "end_date") == [(1, NOW), (2, NOW)]


def test_closed_row_is_opened_again(state, source, rows):
    closed = sync_upsert(state((1, "a", None, "h")), source(), ["k"], AS_OF, action_col="did")
    assert rows(closed, "k", "end_date", "did") == [(1, NOW, "close")]
    opened = sync_upsert(closed.drop("did"), source((1, "a", "h")), ["k"], LATER)
    assert rows(opened, "k", "start_date", "end_date", "creation_date", "update_date",
                "change_hash") == [(1, THEN, None, THEN, datetime(2024, 6, 1), "h")]


@pytest.mark.parametrize("restamp", [False, True])
def test_sync_equals_soft_delete_then_merge(state, source, rows, restamp):
    before = state(*[(k if k % 5 else None, f"v{k}", THEN if k % 3 == 0 else None, f"h{k}")
                     for k in range(30)])
    new = source(*[(k if k % 9 else None, f"w{k}", f"h{k + k % 2}") for k in range(15, 45)])
    closed = soft_delete(before, new, ["k"], AS_OF, restamp_closed=restamp)
    composed = merge_upsert(closed, new, ["k"], AS_OF)
    assert rows(sync_upsert(before, new, ["k"], AS_OF, restamp_closed=restamp)) == rows(composed)


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_hot_keys_lose_nothing(spark, state, source, rows, broadcast):
    """Half of the target has one key and a quarter has none."""
    before = spark.range(4000).select(
        F.when(F.col("id") % 4 == 0, None).when(F.col("id") % 4 < 3, 7).otherwise(F.col("id"))
        .alias("k"), F.col("id").cast("string").alias("v"), F.lit("h").alias("change_hash"))
    new = spark.range(8).select(F.col("id").alias("k"), F.lit("new").alias("v"),
                                F.lit("g").alias("change_hash"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        merged = merge_upsert(before, new, ["k"], AS_OF, stamp_on_update=(), stamp_on_insert=(),
                              keep_on_update=())
        counts = dict(merged.groupBy("v").count().filter("v = 'new'").collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = [None if i % 4 == 0 else 7 if i % 4 < 3 else i for i in range(4000)]
    updated = sum(k is not None and k < 8 for k in keys)
    inserted = len(set(range(8)) - set(keys))
    assert counts == {"new": updated + inserted}


def test_flag_boundaries(spark, rows):
    df = spark.createDataFrame(
        [("start", NOW, None), ("end", THEN, NOW), ("open", THEN, None), ("none", None, None),
         ("past", THEN, datetime(2024, 2, 1)), ("future", datetime(2025, 1, 1), None)],
        "c string, start_date timestamp_ntz, end_date timestamp_ntz")
    flags = dict(with_current_flag(df, AS_OF).select("c", "is_current").collect())
    assert flags == {"start": "Y", "end": "Y", "open": "Y", "none": "N", "past": "N", "future": "N"}
    for before in "YN":
        after = dict(refresh_current_flag(df.withColumn("is_current", F.lit(before)), AS_OF)
                     .select("c", "is_current").collect())
        assert after == {**flags, "none": before}


def test_duplicate_keys(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert rows(duplicate_keys(df, ["k"])) == [(1, 2)]
    with pytest.raises(ValueError, match="NULL"):
        require_unique(df, ["k"])
    with pytest.raises(ValueError, match="duplicate"):
        require_unique(df.na.drop(), ["k"])


def test_one_row_per_key_keeps_keyless_rows(spark, rows):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 4), (None, "a", 1), (None, "a", 1)],
                               "k int, h string, n int")
    assert rows(one_row_per_key(df, ["k"], "h")) == [(1, "b", 4), (None, "a", 1), (None, "a", 1)]


@pytest.mark.parametrize("dealt", [False, True])
def test_one_row_per_key_of_dealt_rows_reads_them_once(spark, rows, dealt, tmp_path):
    spark.createDataFrame([(1, 2, "a", 5), (1, 2, "b", 4), (1, 2, "b", 3), (None, 2, "a", 1),
                           (None, 2, "a", 1), (1, None, "c", 7), (3, 2, None, 8)],
                          "k int, l int, h string, n int").write.parquet(str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    kept = one_row_per_key(dealt_by_key(stored, ["k", "l"]) if dealt else stored, ["k", "l"], "h",
                           dealt=dealt)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert rows(kept) == [(1, 2, "b", 4), (1, None, "c", 7), (3, 2, None, 8), (None, 2, "a", 1),
                          (None, 2, "a", 1)]
    if dealt:
        assert plan.count("FileScan") == plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("hot", [False, True])
def test_surrogates_follow_the_order(spark, rows, hot):
    df = spark.range(5000).repartition(7).select(
        (F.lit(3) if hot else F.col("id") % 100).alias("a"), F.col("id").alias("b"))
    numbered = assign_surrogates(df, "sk", ["a", "b"], 250_000).collect()
    ordered = sorted(numbered, key=lambda r: (r.a, r.b))
    assert [r.sk for r in ordered] == list(range(250_000, 255_000))


def test_surrogates_of_equal_rows_are_distinct(spark):
    df = spark.range(3000).select(F.lit(1).alias("a"))
    keys = {r.sk for r in assign_surrogates(df, "sk", ["a"], 1).collect()}
    assert keys == set(range(1, 3001))


def test_next_surrogate(spark):
    df = spark.createDataFrame([(250_010,), (250_002,)], "sk long")
    assert next_surrogate(df, "sk") == 250_011
    assert next_surrogate(df.filter("sk < 0"), "sk") == 250_000
