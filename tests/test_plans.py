"""What the plans look like: pushed filters, pruned columns, shuffles that are not there."""

import pytest
from pyspark.sql import functions as F

from tidemark.catalog import QUERIES
from tidemark.catalog.recipes import STAGING_KEYS, staging_source
from tidemark.catalog.runs import event_control
from tidemark.operators.columns import require_values
from tidemark.operators.diff import label_changes, label_changes_by_hash
from tidemark.operators.keys import assign_surrogates, failing_duplicates, one_row_per_key
from tidemark.operators.nested import rejoin_tables, split_tables
from tidemark.operators.upsert import merge_upsert, soft_delete, sync_upsert
from tidemark.plans.control import look_back
from tidemark.sources.sinks import write_bucketed

SF_DIR = "/root/testdata/sf0.001"
AS_OF = "2024-05-01 00:00:00"
PLAIN = dict(stamp_on_update=(), stamp_on_insert=(), keep_on_update=())


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def target(spark, tmp_path):
    path = str(tmp_path / "target")
    spark.range(1000).selectExpr("id AS k", "'a' AS v", "'wide' AS own", "'h' AS change_hash") \
        .write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def source(spark, tmp_path):
    path = str(tmp_path / "source")
    spark.range(990, 1010).selectExpr("id AS k", "'b' AS v", "'g' AS change_hash") \
        .write.parquet(path)
    return spark.read.parquet(path)


def test_small_source_leaves_target_unshuffled(target, source):
    plan = planned(merge_upsert(target, source, ["k"], AS_OF, on_duplicate="unique", **PLAIN))
    assert "SortMergeJoin" not in plan
    # The only exchanges by key are of keys that the source holds as well.
    for exchange in plan.split("Exchange hashpartitioning")[1:]:
        assert "own#" not in exchange.split("FileScan")[0]


def test_inserts_read_only_keys_of_the_target(target, source, no_broadcast):
    plan = planned(merge_upsert(target, source, ["k"], AS_OF, on_duplicate="unique", **PLAIN))
    assert plan.count("FullOuter") == 0
    assert "ReadSchema: struct<k:bigint>" in plan


def test_shuffled_merge_can_split_hot_keys(target, source, no_broadcast):
    """Adaptive execution splits skewed sides only if each is a plain sorted shuffle."""
    for how in ("error", "unique"):
        plan = planned(merge_upsert(target, source, ["k"], AS_OF, on_duplicate=how, **PLAIN))
        join = plan[plan.index("LeftOuter"):plan.index("LeftAnti")]
        assert "Aggregate" not in join


def test_hot_target_key_is_split(spark, tmp_path, no_broadcast):
    """A third of all rows on one key and a third on none: no task gets either whole."""
    path = str(tmp_path / "hot")
    spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 3 == 1, F.col("id")).alias("k"),
        F.sha2(F.col("id").cast("string"), 512).alias("v"), F.lit("h").alias("change_hash")) \
        .repartition(12).write.parquet(path)
    source = spark.range(-1, 30_000).selectExpr("id AS k", "'n' AS v", "'g' AS change_hash")
    options = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
               "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
               "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in options.items():
        spark.conf.set(key, value)
    try:
        merged = merge_upsert(spark.read.parquet(path), source, ["k"], AS_OF, **PLAIN)
        plan = executed(merged)
        assert merged.count() == 60_000 + 20_001 - 1
    finally:
        for key in options:
            spark.conf.unset(key)
    assert "SortMergeJoin(skew=true)" in plan


def test_diff_shuffles_rows_once(spark, no_broadcast):
    new = spark.range(100).selectExpr("id AS k", "id % 7 AS v")
    old = spark.range(50, 150).selectExpr("id AS k", "id % 5 AS v")
    assert executed(label_changes(new, old, "k")).count("ReusedExchange") == 1


def test_sync_shuffles_the_source_once(spark, target, source, no_broadcast):
    """The join that updates and the one that finds new rows share a shuffle (F13)."""
    state = target.selectExpr("k", "v", "CAST(NULL AS TIMESTAMP_NTZ) AS end_date",
                              "CAST(NULL AS TIMESTAMP_NTZ) AS update_date", "change_hash")
    after = sync_upsert(state, source, ["k"], AS_OF, on_duplicate="unique", stamp_on_insert=(),
                        keep_on_update=())
    assert executed(after).count("ReusedExchange") == 1
    found = {r.k: (r.v, r.end_date is None) for r in after.collect()}
    assert found == {k: ("a", False) if k < 990 else ("b", True) for k in range(1010)}


def test_dealt_source_is_shuffled_whole_once_and_without_its_hash(spark, no_broadcast):
    source = staging_source(spark, SF_DIR, dealt=True)
    exchanges = [x for x in planned(one_row_per_key(source, STAGING_KEYS, "change_hash", dealt=True))
                 .split("\n") if "Exchange hashpartitioning(custkey" in x]
    assert len(exchanges) == 1
    kept = one_row_per_key(source, STAGING_KEYS, "change_hash", dealt=True)
    plain = one_row_per_key(staging_source(spark, SF_DIR), STAGING_KEYS, "change_hash")
    assert sorted(kept.collect()) == sorted(plain.collect())


def test_look_back_is_pushed_to_the_scan(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    plan = planned(look_back(events, event_control(spark, SF_DIR), "purchase", "ts"))
    assert "GreaterThanOrEqual(ts,ScalarSubquery" in plan


def test_staging_join_reads_needed_columns_and_hints_nothing(spark):
    plan = planned(staging_source(spark, SF_DIR))
    assert "EqualTo(l_returnflag,N)" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
    assert "l_extendedprice" not in plan and "p_retailprice" not in plan


def test_surrogates_sort_in_ranges(spark):
    df = spark.range(1000).select(F.col("id").alias("a"))
    numbered = assign_surrogates(df, "sk", ["a"], 1)
    # Only the offsets, one row per partition, meet in one task.
    assert planned(numbered).count("SinglePartition") == 1


def test_bucketed_target_is_not_shuffled(spark, target, source, no_broadcast):
    write_bucketed(target, "bucketed_target", ["k"], 16, mode="overwrite")
    plan = planned(soft_delete(
        spark.table("bucketed_target").selectExpr(
            "k", "v", "CAST(NULL AS TIMESTAMP_NTZ) AS end_date",
            "CAST(NULL AS TIMESTAMP_NTZ) AS update_date", "change_hash"),
        source, ["k"], AS_OF))
    spark.sql("DROP TABLE bucketed_target")
    keyed = plan[plan.index("SortMergeJoin"):]
    left = keyed[:keyed.index("__source_k#", keyed.index("FileScan"))]
    assert "Exchange" not in left


def test_no_query_crosses_or_uses_python(spark):
    for name in ("staging_join", "merge_staging", "diff_all", "flatten_inline", "flatten_rejoin",
                 "control_advance", "union_by_name", "nest_struct"):
        plan = planned(QUERIES[name](spark, SF_DIR))
        for word in ("CartesianProduct", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
            assert word not in plan, (name, word)


def test_required_columns(spark):
    df = spark.createDataFrame([(1, None)], "a int, b int")
    assert require_values(df, ["a"]).collect() == [(1, None)]
    with pytest.raises(Exception, match="b is NULL"):
        require_values(df, ["b"]).collect()


def test_changes_by_hash_split_a_hot_key(spark, tmp_path, no_broadcast):
    """A key that a third of all rows have, though none should, is split over several tasks."""
    path = str(tmp_path / "hot")
    spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"),
        F.sha2(F.col("id").cast("string"), 512).alias("h")).repartition(12).write.parquet(path)
    old = spark.range(-1, 30_000).selectExpr("id AS k", "'x' AS h")
    options = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
               "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
               "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in options.items():
        spark.conf.set(key, value)
    try:
        labelled = label_changes_by_hash(spark.read.parquet(path), old, "k", "h")
        assert labelled.count() == 60_000 + 10_000
        plan = executed(labelled)
    finally:
        for key in options:
            spark.conf.unset(key)
    assert "SortMergeJoin(skew=true)" in plan and "FullOuter" not in plan


def test_rejoined_grandchildren_are_shuffled_once(spark, no_broadcast):
    df = spark.createDataFrame([(1, [("x", [1, 2])], [7, 8])],
                               "id int, a array<struct<x string, b array<int>>>, m array<int>")
    joined = rejoin_tables(split_tables(df, keep_positions=True))
    assert joined.columns == ["id", "a_pos", "a_x", "a_b_pos", "a_b", "m_pos", "m"]
    # Root and children by the record, then the rows so far and the grandchildren by their parent.
    assert planned(joined).count("Exchange hashpartitioning") == 5
    assert joined.count() == 4


def test_flattened_words_are_folded_without_a_sort(spark):
    """A sort of all words spills; only what is left of them may be sorted."""
    plan = planned(QUERIES["flatten_n"](spark, SF_DIR)).split("== Initial Plan ==")[0]
    below = plan[:plan.index("Generate explode")]
    assert "HashAggregate" in below
    assert "Sort" not in below[below.rindex("HashAggregate") + len("HashAggregate"):]


def test_checked_keys_are_not_put_into_one_task(spark, source):
    """By their few bytes all keys would be."""
    spread = failing_duplicates(source, ["k"]).rdd.getNumPartitions()
    assert spread == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1


def test_keys_of_a_whole_target_are_dealt_out(target, source, no_broadcast):
    """By number, or else millions of them, of a few bytes each, make one task."""
    merged = merge_upsert(target, source, ["k"], AS_OF, on_duplicate="unique", delta=False, **PLAIN)
    anti = planned(merged).split("LeftAnti")[1]
    assert "REPARTITION_BY_NUM" in anti
    assert merged.count() == 1010
