"""Sources, sinks, published versions, control windows, job descriptions and streaming."""

import json
import subprocess
import sys
import time
import uuid
from datetime import date, datetime
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from __spark_entry__ import queries
from tidemark.functions.dates import date_hour, run_clock, whole_seconds
from tidemark.functions.values import required
from tidemark.plans.control import (
    advance_window, changed_since, create_control, current_window, look_back, new_folders,
    new_loads,
    source_query,
)
from tidemark.plans.jobs import ingest
from tidemark.plans.spec import (
    fill_variables, load_spec, run_job, section_of,
)
from tidemark.session import scratch_path, shared_folder
from tidemark.sources import jdbc, publish
from tidemark.sources.readers import (
    dual, list_files, parse_payloads, read_json_lines, read_source, register_views, run_sql,
    session_options,
)
from tidemark.session import scratch_scope
from tidemark.sources.sinks import load_kind, load_path, stage, write_load, write_sink
from tidemark.streaming.files import append_new_files


@pytest.fixture
def database():
    return jdbc.Database(f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true",
                         "org.apache.derby.iapi.jdbc.AutoloadedDriver")


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_folder(spark))
    assert shared_folder(spark) in spark.sparkContext.getCheckpointDir()


def test_json_lines_from_two_folders_once_each(spark, tmp_path, rows):
    for name, text in (("a/x/1.json", '{"i": 1}\n{"i": 2}\n'), ("b/2.json", '{"i": 3}\n')):
        file = tmp_path / name
        file.parent.mkdir(parents=True)
        file.write_text(text)
    folders = [str(tmp_path / "a"), str(tmp_path / "b"), str(tmp_path / "a")]
    assert rows(read_json_lines(spark, folders)) == [(1,), (2,), (3,)]
    (tmp_path / "b" / "3.json").write_text('{"i": \n')
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_json_lines(spark, folders, "i long").collect()


def test_select_reaches_the_source_before_limit(spark, tmp_path):
    spark.range(10).selectExpr("id", "id * 2 AS twice").write.parquet(str(tmp_path / "t"))
    df = read_source(spark, "parquet", paths=str(tmp_path / "t"), columns=["twice"], limit=3)
    assert df.columns == ["twice"] and df.count() == 3
    assert "ReadSchema: struct<twice:bigint>" in df._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        read_source(spark, "jdbc", query="a", table="b")


def test_list_files_by_suffix(spark, tmp_path, rows):
    for name in ("p/1.csv", "p/q/2.csv", "p/3.txt"):
        file = tmp_path / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("x")
    found = list_files(spark, str(tmp_path / "p"), suffix=".csv")
    assert [r.path.rsplit("/", 1)[1] for r in found.orderBy("path").collect()] == ["1.csv", "2.csv"]


def test_payloads(spark, rows):
    df = spark.createDataFrame([(1, '[{"a": 1}, {"a": 2}]'), (2, "[]")], "id int, body string")
    assert rows(parse_payloads(df, "body", "array<struct<a int>>", keep=["id"])) == [(1, 1), (1, 2)]
    one = spark.createDataFrame([('{"a": 5}',)], "body string")
    assert rows(parse_payloads(one, "body", "a int")) == [(5,)]


def test_dual_and_views(spark, tmp_path, rows):
    dual(spark)
    assert rows(run_sql(spark, "SELECT r.value, 1 + 1 AS n FROM dual")) == [("dummy", 2)]
    spark.range(3).write.parquet(str(tmp_path / "t"))
    register_views(spark, {"cached_view": {"format": "parquet", "paths": str(tmp_path / "t"),
                                           "cache": True}})
    assert spark.catalog.isCached("cached_view")
    spark.catalog.uncacheTable("cached_view")


def test_jdbc_split_reads_every_row(spark, database, rows):
    df = spark.range(100).select(
        F.when(F.col("id") % 10 > 0, F.col("id")).alias("ID"),
        F.when(F.col("id") % 7 > 0, F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00.5' "
                                           "+ make_dt_interval(id, 1)")).alias("TS"),
        F.expr("date_add(DATE'2024-01-01', CAST(id % 5 AS INT))").alias("D"))
    jdbc.write_table(df, database, "T")
    for column in ("ID", "TS", "D"):
        read = jdbc.read_split(spark, database, "SELECT * FROM T", jdbc.Split(column, 4))
        assert rows(read) == rows(df)
        assert read.rdd.getNumPartitions() == 4
    narrow = jdbc.Split("ID", 3, bounds_query="SELECT 10 AS lo, 12 AS hi FROM SYSIBM.SYSDUMMY1")
    assert rows(jdbc.read_split(spark, database, "T", narrow)) == rows(df)


def test_jdbc_split_of_one_value_and_of_nothing(spark, database, rows):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1))], "ID int, TS timestamp_ntz")
    jdbc.write_table(df, database, "T")
    assert rows(jdbc.read_split(spark, database, "T", jdbc.Split("TS", 4))) == rows(df)
    jdbc.write_table(df.filter("ID > 5"), database, "EMPTY")
    nothing = jdbc.read_split(spark, database, "EMPTY", jdbc.Split("ID", 4))
    assert nothing.rdd.getNumPartitions() == 1 and nothing.count() == 0


def test_time_ranges_cover_everything():
    ranges = jdbc._time_ranges("c", date(2024, 1, 1), date(2024, 1, 9), 4)
    assert ranges == ["c < {d '2024-01-03'} OR c IS NULL",
                      "c >= {d '2024-01-03'} AND c < {d '2024-01-05'}",
                      "c >= {d '2024-01-05'} AND c < {d '2024-01-07'}", "c >= {d '2024-01-07'}"]


def test_load_kinds_and_paths():
    at = datetime(2024, 3, 4, 5)
    assert load_kind("Full") == "full" and load_kind("INCR") == "incr"
    with pytest.raises(ValueError):
        load_kind("other")
    assert load_path("/x/", "full", at) == "/x"
    assert load_path("/x", "Incr", at) == "/x/date=2024-03-04/hour=05/load=20240304050000"


def test_no_load_deletes_another_and_a_retry_replaces_itself(spark, tmp_path, rows):
    base = str(tmp_path / "t")
    for minute, n in ((5, 2), (50, 3), (50, 4)):
        write_load(spark.range(n), base, "incr", datetime(2024, 1, 1, 2, minute))
    landed = spark.read.parquet(base)
    assert sorted(landed.groupBy("hour", "load").count().collect()) == [
        (2, 20240101020500, 2), (2, 20240101025000, 4)]
    assert new_loads(landed, "20240101020500").count() == 4
    assert new_loads(landed, None).count() == 6


def test_partitioned_sink_gathers_folders(spark, tmp_path):
    """Eight tasks hold every folder, yet each folder gets one file."""
    path = tmp_path / "t"
    df = spark.range(800).repartition(8).select("id", (F.col("id") % 4).alias("p"))
    write_sink(df, "parquet", path=str(path), partition_by=["p"])
    assert len(list(path.glob("p=*/*.parquet"))) == 4


def test_published_versions(spark, tmp_path, rows):
    base = str(tmp_path / "d")
    assert publish.live_version(spark, base) is None
    with pytest.raises(ValueError):
        publish.read_live(spark, base)
    assert publish.replace_live(spark.range(1), base, view="live_d") == 1
    version = publish.write_next(spark.range(2), base)
    assert (version, spark.table("live_d").count()) == (2, 1)
    assert publish.read_live(spark, base).count() == 1
    publish.publish(spark, base, 2, view="live_d")
    assert spark.table("live_d").count() == 2
    publish.publish(spark, base, 1)
    assert publish.read_live(spark, base).count() == 1
    with pytest.raises(ValueError):
        publish.drop_version(spark, base, 1)
    assert publish.replace_live(spark.range(9), base, keep_previous=False) == 3
    assert not (tmp_path / "d" / "v=1").exists() and (tmp_path / "d" / "v=2").exists()
    with pytest.raises(ValueError, match="never written"):
        publish.publish(spark, base, 9)


def test_of_two_writers_the_second_fails(spark, tmp_path):
    base = str(tmp_path / "d")
    publish.replace_live(spark.range(1), base)
    first, second = (publish.write_next(spark.range(n), base) for n in (2, 3))
    assert first != second
    publish.publish(spark, base, first)
    with pytest.raises(publish.Outdated):
        publish.publish(spark, base, second)
    assert publish.read_live(spark, base).count() == 2


def test_catalog_view_is_seen_by_other_sessions(spark, tmp_path):
    base = str(tmp_path / "d")
    try:
        publish.replace_live(spark.range(2), base, view="live_for_all", catalog=True)
        assert spark.newSession().table("live_for_all").count() == 2
        publish.replace_live(spark.range(5), base, view="live_for_all", catalog=True)
        assert spark.newSession().table("live_for_all").count() == 5
    finally:
        spark.sql("DROP VIEW IF EXISTS live_for_all")


def test_options_hold_for_their_query_only(spark, rows):
    key = "spark.sql.legacy.timeParserPolicy"
    before = spark.conf.get(key)
    sql = "SELECT to_date('2024-1-5x', 'yyyy-MM-dd') AS d"
    parsed = run_sql(spark, sql, [f"SET {key}=LEGACY"])
    assert spark.conf.get(key) == before
    assert str(parsed.first()[0]) == "2024-01-05"
    with pytest.raises(Exception):
        spark.sql(sql).collect()
    job = {"job": {"spark_options": [f"set {key}=LEGACY"]}, "stages": [{"parsed": {"sql": sql}}]}
    assert str(run_job(spark, job)["parsed"].first()[0]) == "2024-01-05"


def test_views_in_the_described_form(spark, rows):
    spark.range(3).createOrReplaceTempView("described_base")
    assert register_views(spark, [{"described_a": ["Y", "described_base"]},
                                  {"described_b": ["N", "SELECT id + 1 AS id FROM described_base"]}]) == [
        "described_a"]
    assert spark.catalog.isCached("described_a") and rows(spark.table("described_b")) == [
        (1,), (2,), (3,)]
    spark.catalog.uncacheTable("described_a")


def test_what_an_application_staged_goes_with_it(tmp_path):
    program = ("import sys; from tidemark.session import build_session, scratch_path\n"
               "spark = build_session('t', 'local[1]', 1, {'spark.ui.enabled': 'false',"
               " 'spark.checkpoint.dir': sys.argv[1]})\n"
               "spark.range(9).write.parquet(scratch_path(spark, 'x'))\n"
               "import glob; print('staged', len(glob.glob(sys.argv[1] + '/tidemark/*/x-*')))\n"
               "raise SystemExit(3)")
    root = str(Path(__file__).resolve().parent.parent)
    run = subprocess.run([sys.executable, "-c", program, str(tmp_path)], cwd=root,
                         capture_output=True, text=True, timeout=120)
    assert run.returncode == 3 and "staged 1" in run.stdout
    deadline = time.time() + 30
    while list(tmp_path.glob("tidemark/*")) and time.time() < deadline:
        time.sleep(.5)
    assert not list(tmp_path.glob("tidemark/*"))


@pytest.mark.parametrize("name", ["staging_job", "spec_staging", "merge_by_file", "nest_by_bytes"])
def test_queries_leave_nothing_staged_once_consumed(spark, name):
    with scratch_scope(spark) as paths:
        assert queries()[name](spark, "/root/testdata/sf0.001").count() > 0
    assert not [p for p in paths if Path(p).exists()]


def test_scratch_scope_removes_what_was_staged(spark):
    with pytest.raises(ZeroDivisionError):
        with scratch_scope(spark) as paths:
            stage(spark.range(3))
            1 / 0
    assert len(paths) == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(paths[0])


def test_schema_refresh(spark, tmp_path, rows):
    base = str(tmp_path / "d")
    publish.replace_live(spark.createDataFrame([(1, "2")], "a int, b string"), base)
    schema = T.StructType().add("b", "long").add("c", "string")
    publish.refresh_schema(spark, base, schema)
    assert rows(publish.read_live(spark, base)) == [(2, None)]


def test_control_windows(spark, tmp_path):
    path = str(tmp_path / "control")
    create_control(spark, path)
    assert current_window(spark.read.parquet(path), "j") == (None, None)
    for day in (1, 2, 3):
        advance_window(spark, path, "j", datetime(2024, 1, day))
    advance_window(spark, path, "other", datetime(2025, 1, 1))
    control = spark.read.parquet(path)
    assert current_window(control, "j") == (datetime(2024, 1, 2), datetime(2024, 1, 3))
    df = spark.createDataFrame([(1, datetime(2023, 12, 25)), (2, datetime(2023, 12, 26)),
                                (3, datetime(2024, 5, 1))], "id int, ts timestamp_ntz")
    assert [r.id for r in look_back(df, control, "j", "ts").collect()] == [2, 3]
    assert look_back(df, control, "other", "ts").count() == 3
    assert look_back(df, control, "unknown", "ts").count() == 0


def test_changed_since_and_query_text(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2))],
                               "id int, ts timestamp_ntz")
    assert changed_since(df, "FULL", "ts", datetime(2024, 1, 1)).count() == 2
    assert changed_since(df, "incr", "ts", datetime(2024, 1, 1)).count() == 1
    text = "SELECT * FROM t WHERE ts > '{}'"
    assert source_query(text, "Full") == text
    assert source_query(text, "incr", datetime(2024, 1, 1)) == \
        "SELECT * FROM t WHERE ts > '2024-01-01 00:00:00'"
    assert source_query(text, "incr") == "SELECT * FROM t WHERE ts > '1900-01-01 00:00:00'"


def test_new_folders_are_strictly_later_and_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "2024-01-01", 22), (2, "2024-01-01", 23), (3, "2024-01-02", 0)],
                               "id int, date string, hour int")
    write_sink(df, "parquet", path=path, partition_by=["date", "hour"])
    picked = new_folders(spark.read.parquet(path), 2024010202)
    assert [r.id for r in picked.collect()] == [3]
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_ingest_advances_only_after_the_write(spark, tmp_path, rows):
    base, control = str(tmp_path / "out"), str(tmp_path / "control")
    events = spark.createDataFrame([(i, datetime(2024, 1, i)) for i in range(1, 7)],
                                   "id int, ts timestamp_ntz")
    def load(as_of, read):
        return ingest(spark, read, job="j", base=base, control_path=control, load_type="incr",
                      as_of=as_of, changed_col="ts")
    first = load(datetime(2024, 1, 3), lambda since: events.filter("ts <= '2024-01-03'"))
    def broken(since):
        return events.withColumn("id", F.raise_error(F.lit("source is down")).cast("int"))
    with pytest.raises(Exception, match="source is down"):
        load(datetime(2024, 1, 4), broken)
    seen = []
    second = load(datetime(2024, 1, 7), lambda since: seen.append(since) or events)
    assert seen == [datetime(2024, 1, 3)]
    assert [rows(spark.read.parquet(p), "id") for p in (first, second)] == [
        [(1,), (2,), (3,)], [(4,), (5,), (6,)]]


def test_variables_longest_first():
    section = {"$env_x": ["$env", "a$envb", 1, None], "n": {"m": "$environment"}}
    assert fill_variables(section, {"$env": "E", "$environment": "LONG", "$env_x": "K"}) == {
        "K": ["E", "aEb", 1, None], "n": {"m": "LONG"}}


def test_spec_sections_and_options(spark, tmp_path):
    spec = {"environment": {"dev": {"dynamic_vars": {"$db": "D"}}}, "control": {"name": "$db.c"}}
    file = tmp_path / "spec.json"
    file.write_text(json.dumps(spec))
    assert load_spec(spark, str(file)) == spec
    assert section_of(spec, "control", "dev") == {"name": "D.c"}
    assert section_of(spec, "stages", "dev") is None
    with pytest.raises(KeyError):
        section_of(spec, "control", "prod")
    key = "spark.sql.storeAssignmentPolicy"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError):
        with session_options(spark, [f"set {key}=LEGACY", "SET spark.tidemark.test = 5"]):
            assert spark.conf.get(key) == "LEGACY"
            assert spark.conf.get("spark.tidemark.test") == "5"
            raise RuntimeError
    assert spark.conf.get(key) == before
    assert spark.conf.get("spark.tidemark.test", None) is None


def test_job_releases_its_caches(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    results = run_job(spark, {"stages": [{"doubled": {
        "sources": [{"view": "numbers", "format": "parquet", "paths": str(tmp_path / "in"),
                     "cache": True}],
        "sql": "SELECT id * 2 AS id FROM numbers",
        "targets": [{"format": "parquet", "path": str(tmp_path / "out")},
                    {"format": "json", "path": str(tmp_path / "out2")}]}}]})
    assert not spark.catalog.isCached("numbers")
    assert results["doubled"].count() == spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_stream_picks_up_each_file_once(spark, tmp_path, rows):
    landed, sink, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    schema = spark.range(1).schema
    for start in (0, 10):
        spark.range(start, start + 10).write.mode("append").parquet(landed)
        append_new_files(spark, landed, schema, sink, offsets, max_files_per_batch=2)
    again = append_new_files(spark, landed, schema, sink, offsets)
    assert rows(again) == [(i,) for i in sorted(range(20), key=lambda i: repr((i,)))]


def test_dates(spark):
    df = spark.createDataFrame([(datetime(2022, 2, 14, 6, 7, 8, 900000),)], "ts timestamp_ntz")
    assert df.select(date_hour(F.col("ts")), whole_seconds(F.col("ts"))).first() == (
        2022021406, datetime(2022, 2, 14, 6, 7, 8))
    assert run_clock(spark).microsecond == 0


def test_required_values(spark):
    df = spark.createDataFrame([(1,), (None,)], "a int")
    checked = df.select(required(F.col("a"), "int", "a is NULL"))
    with pytest.raises(Exception, match="a is NULL"):
        checked.collect()


def test_even_ranges_split_a_hot_value(spark, database, rows):
    """Half of the rows have one value, a tenth has none, the others lie far apart."""
    df = spark.range(2000).select(
        F.col("id").alias("ID"),
        F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 2 == 1, 5)
        .otherwise(F.pow(F.col("id"), 3).cast("long")).alias("V"))
    df = df.withColumn("TS", F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00.5' + make_dt_interval(0, 0, 0, V / 1e5)"))
    jdbc.write_table(df, database, "SKEWED")
    for column in ("V", "TS"):
        read = jdbc.read_split(spark, database, "SELECT * FROM SKEWED", jdbc.Split(column, 8, even=True, also="ID"))
        assert rows(read) == rows(df)
        sizes = [n for n, in read.groupBy(F.spark_partition_id().alias("p")).count().select("count").collect()]
        assert max(sizes) <= 2 * 250 and 8 <= len(sizes) <= 20
        plain = jdbc.read_split(spark, database, "SKEWED", jdbc.Split(column, 8))
        assert max(r[1] for r in plain.groupBy(F.spark_partition_id()).count().collect()) > 1000
    alone = jdbc.read_split(spark, database, "SKEWED", jdbc.Split("V", 8, even=True))
    assert rows(alone) == rows(df)
    jdbc.write_table(df.filter("ID < 0"), database, "EMPTY_TOO")
    assert jdbc.read_split(spark, database, "EMPTY_TOO", jdbc.Split("V", 8, even=True)).count() == 0


def test_even_ranges_of_dates_and_of_nulls_alone(spark, database, rows):
    df = spark.range(100).select(F.col("id").alias("ID"), F.expr("date_add(DATE'2024-01-01', CAST(id % 5 AS INT))")
                                 .alias("D"), F.lit(None).cast("int").alias("N"))
    jdbc.write_table(df, database, "DATED")
    for split in (jdbc.Split("D", 3, even=True), jdbc.Split("N", 4, even=True, also="ID"),
                  jdbc.Split("N", 4, even=True), jdbc.Split("D", 1, even=True)):
        assert rows(jdbc.read_split(spark, database, "DATED", split)) == rows(df)
    split = jdbc.read_split(spark, database, "DATED", jdbc.Split("N", 4, even=True, also="ID"))
    assert split.rdd.getNumPartitions() == 4
