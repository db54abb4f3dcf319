"""Queries on control windows, incremental loads, job descriptions and scalar functions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.catalog.base import query, table
from tidemark.functions.dates import (
    date_hour, folder_ready_at, instant, is_effective, parse_date_hour, second_text,
    whole_seconds,
)
from tidemark.functions.values import blank_to_null, null_of
from tidemark.operators.columns import at
from tidemark.plans.control import (
    as_control_text, changed_since, latest_windows, look_back, new_folders, next_windows,
)
from tidemark.plans.jobs import ingest
from tidemark.plans.spec import run_job
from tidemark.session import scratch_path
from tidemark.sources.loads import load_history, read_loads
from tidemark.sources.sinks import write_load, write_sink
from tidemark.streaming.files import append_new_files

EVENTS_AS_OF = "2024-01-31 00:00:00"


def event_control(spark, sf_dir):
    """One window per event type and day, as if each type were a daily job."""
    return (table(spark, sf_dir, "events")
            .groupBy(at("event_type").alias("job_name"), F.to_date("ts").alias("day"))
            .agg(F.min("ts").alias("start_timestamp"), F.max("ts").alias("end_timestamp"),
                 F.max("ts").alias("recorded_at")))


_CONTROL_SQL = """
control AS (
  SELECT event_type AS job_name, min(ts) AS start_timestamp, max(ts) AS end_timestamp
  FROM events GROUP BY event_type, CAST(ts AS DATE)),
latest AS (
  SELECT * FROM control
  QUALIFY row_number() OVER (PARTITION BY job_name ORDER BY end_timestamp DESC) = 1)"""


@query("control_latest", f"""WITH {_CONTROL_SQL}
SELECT job_name, strftime(start_timestamp, '%Y-%m-%d %H:%M:%S') AS start_timestamp,
       strftime(end_timestamp, '%Y-%m-%d %H:%M:%S') AS end_timestamp FROM latest""")
def control_latest(spark, sf_dir):
    return as_control_text(latest_windows(event_control(spark, sf_dir)))


@query("control_advance", f"""WITH {_CONTROL_SQL}
SELECT job_name, strftime(end_timestamp, '%Y-%m-%d %H:%M:%S') AS start_timestamp,
       '{EVENTS_AS_OF}' AS end_timestamp FROM latest""")
def control_advance(spark, sf_dir):
    control = event_control(spark, sf_dir).drop("day")
    appended = control.unionByName(next_windows(control, EVENTS_AS_OF))
    return as_control_text(latest_windows(appended))


@query("lookback_filter", f"""WITH {_CONTROL_SQL}
SELECT event_id, event_type FROM events WHERE ts >= (
  SELECT start_timestamp - INTERVAL 7 DAY FROM latest WHERE job_name = 'purchase')""")
def lookback_filter(spark, sf_dir):
    return look_back(table(spark, sf_dir, "events"), event_control(spark, sf_dir),
                     "purchase", "ts").select("event_id", "event_type")


@query("incr_filter", """
SELECT 'incr' AS load, event_id FROM events WHERE ts > TIMESTAMP '2024-01-20 06:00:00'
UNION ALL SELECT 'full', event_id FROM events""")
def incr_filter(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    loads = [changed_since(events, kind, "ts", "2024-01-20 06:00:00")
             .select(F.lit(kind.lower()).alias("load"), "event_id") for kind in ("INCR", "Full")]
    return loads[0].unionAll(loads[1])


def _landed_events(spark, sf_dir):
    """Events as four loads a day would have left them in hourly folders."""
    path = scratch_path(spark, "events-landed")
    events = table(spark, sf_dir, "events").withColumns(
        {"date": F.to_date("ts"), "hour": F.hour("ts") - F.hour("ts") % 6})
    write_sink(events, "parquet", path=path, partition_by=["date", "hour"])
    return spark.read.parquet(path)


@query("incr_partitions", """
SELECT event_id, CAST(strftime(landed, '%Y%m%d%H') AS BIGINT) AS folder
FROM (SELECT *, time_bucket(INTERVAL 6 HOUR, ts) AS landed FROM events)
WHERE landed + INTERVAL 3 HOUR > TIMESTAMP '2024-01-20 03:00:00'""")
def incr_partitions(spark, sf_dir):
    return new_folders(_landed_events(spark, sf_dir), 2024012003).select(
        "event_id", date_hour(at("date").cast("timestamp_ntz")
                              + F.make_dt_interval(F.lit(0), at("hour"))).alias("folder"))


@query("ingest_incremental", """
SELECT CASE WHEN ts < TIMESTAMP '2024-01-15 10:05:00' THEN 20240115100500
            WHEN ts < TIMESTAMP '2024-01-15 10:50:00' THEN 20240115105000
            ELSE 20240131000000 END AS load, event_id, event_type FROM events""")
def ingest_incremental(spark, sf_dir):
    """Three loads, two of them in one hour, each of what the source held then."""
    base, control = scratch_path(spark, "ingested"), scratch_path(spark, "control")
    events = table(spark, sf_dir, "events")
    for as_of in (datetime(2024, 1, 15, 10, 5), datetime(2024, 1, 15, 10, 50),
                  datetime(2024, 1, 31)):
        ingest(spark, lambda since: events.filter(at("ts") < instant(as_of)),
               job="events", base=base, control_path=control, load_type="incr",
               as_of=as_of, changed_col="ts")
    return spark.read.parquet(base).select("load", "event_id", "event_type")


@query("ingest_once", """
SELECT CASE WHEN ts < TIMESTAMP '2024-01-15 10:05:00' THEN 1
            WHEN ts < TIMESTAMP '2024-01-20 00:00:00' THEN 2 ELSE 3 END AS number, event_id, event_type
FROM events""")
def ingest_once(spark, sf_dir):
    """Three loads, one of them tried twice, beside the folder of a run that ended before its record
    was made. Each event is in one load, whose number is found by its time."""
    base, control = scratch_path(spark, "ingested-once"), scratch_path(spark, "control")
    events = table(spark, sf_dir, "events")
    tries = [(datetime(2024, 1, 15, 10, 5), "a"), (datetime(2024, 1, 20), "b"),
             (datetime(2024, 1, 20), "b"), (datetime(2024, 1, 31), "c")]
    write_load(events, base, "incr", datetime(2024, 1, 15, 10, 5), token="lost")
    for as_of, token in tries:
        ingest(spark, lambda since: events.filter(at("ts") < instant(as_of)), job="events", base=base,
               control_path=control, load_type="incr", as_of=as_of, changed_col="ts", token=token)
    loads = load_history(spark, control, "events").select(
        at("number").cast("int").alias("number"), F.concat(F.lit("t-"), "token").alias("token"))
    return (read_loads(spark, control, "events").join(loads, "token")
            .select("number", "event_id", "event_type"))


@query("stream_incremental", "SELECT event_id, user_id, event_type FROM events")
def stream_incremental(spark, sf_dir):
    """Two runs over one folder that gains files in between; no file counts twice."""
    landed, sink, checkpoint = (scratch_path(spark, n) for n in ("landed", "sink", "offsets"))
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    early = at("ts") < instant("2024-01-15 00:00:00")
    for arrived in (early, ~early):
        write_sink(events.filter(arrived).drop("ts"), "parquet", "append", path=landed)
        append_new_files(spark, landed, events.drop("ts").schema, sink, checkpoint)
    return append_new_files(spark, landed, events.drop("ts").schema, sink, checkpoint)


@query("spec_job", """
SELECT n_name, count(*) AS n_customers FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_mktsegment = 'BUILDING' GROUP BY n_name""")
def spec_job(spark, sf_dir):
    out = scratch_path(spark, "spec-job")
    spec = {
        "global": {"format": "parquet"},
        "environment": {"test": {"dynamic_vars": {
            "$data": sf_dir, "$datasegment": "BUILDING", "$out": out}}},
        "job": {"name": "customers_per_nation", "environment": "test",
                "spark_options": ["set spark.sql.ansi.enabled=true",
                                  "set spark.sql.storeAssignmentPolicy=ANSI"]},
        "stages": [
            {"segment_customers": {
                "sources": [{"view": "customers", "format": "parquet",
                             "paths": "$data/customer.parquet"}],
                "sql": "SELECT * FROM customers WHERE c_mktsegment = '$datasegment'"}},
            {"per_nation": {
                "sources": [{"view": "nations", "format": "parquet", "cache": True,
                             "paths": "$data/nation.parquet"}],
                "sql": "SELECT n_name, count(*) AS n_customers FROM segment_customers "
                       "JOIN nations ON c_nationkey = n_nationkey GROUP BY n_name",
                "targets": [{"format": "parquet", "path": "$out", "write_mode": "overwrite",
                             "options": {"compression": "snappy"}}]}}]}
    run_job(spark, spec)
    return spark.read.parquet(out)


@query("fn_dates", """
SELECT event_id, CAST(strftime(ts, '%Y%m%d%H') AS BIGINT) AS date_hour,
       date_trunc('second', ts) AS whole, strftime(ts, '%Y-%m-%d %H:%M:%S') AS text,
       date_trunc('hour', ts) + INTERVAL 3 HOUR AS ready,
       date_trunc('second', ts) - INTERVAL 7 DAY AS week_before,
       CASE WHEN TIMESTAMP '2024-01-15 00:00:00' BETWEEN ts
            AND TIMESTAMP '4712-12-31 00:00:00' THEN 'Y' ELSE 'N' END AS in_force
FROM events""")
def fn_dates(spark, sf_dir):
    ts = at("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", date_hour(ts).alias("date_hour"), whole_seconds(ts).alias("whole"),
        second_text(ts).alias("text"), folder_ready_at(F.to_date(ts), F.hour(ts)).alias("ready"),
        (whole_seconds(ts) - F.make_dt_interval(F.lit(7))).alias("week_before"),
        F.when(is_effective("2024-01-15 00:00:00", ts, null_of("timestamp_ntz")), "Y")
        .otherwise("N").alias("in_force"))


@query("fn_nulls", """
SELECT event_id, coalesce(nullif(event_type, 'view'), 'none') AS nvl_kind,
       CASE WHEN event_type = 'view' THEN 'blank' ELSE 'filled' END AS blank_kind,
       CASE WHEN value BETWEEN 10 AND 20 THEN 'mid' WHEN value NOT BETWEEN 10 AND 20 THEN 'out'
            END AS band, coalesce(TRY_CAST(event_type AS BIGINT), user_id) AS tried
FROM events""")
def fn_nulls(spark, sf_dir):
    kind, value = at("event_type"), at("value")
    emptied = F.when(kind == "view", "").otherwise(kind)
    return table(spark, sf_dir, "events").select(
        "event_id", F.coalesce(F.nullif(kind, F.lit("view")), F.lit("none")).alias("nvl_kind"),
        F.when(blank_to_null(emptied).isNull(), "blank").otherwise("filled").alias("blank_kind"),
        F.when(value.between(10, 20), "mid").when(~value.between(10, 20), "out").alias("band"),
        F.coalesce(kind.try_cast("bigint"), at("user_id")).alias("tried"))


@query("fn_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       CAST(json_extract(props, '$.k') AS BIGINT) AS k_by_path FROM events""")
def fn_json(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k bigint")["k"].alias("k"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k_by_path"))


@query("fn_folders", """
SELECT event_id, strftime(landed, '%Y-%m-%d') AS date_part,
       CAST(hour(landed) AS INTEGER) AS hour_part, landed AS folder_start
FROM (SELECT *, time_bucket(INTERVAL 6 HOUR, ts) AS landed FROM events)""")
def fn_folders(spark, sf_dir):
    """Partition values taken from file paths."""
    folders = F.split(F.col("_metadata.file_path"), "/")
    def value(position):
        return F.element_at(F.split(F.element_at(folders, position), "="), 2)
    return (_landed_events(spark, sf_dir)
            .select("event_id", value(-3).alias("date_part"),
                    value(-2).cast("int").alias("hour_part"))
            .withColumn("folder_start", parse_date_hour(F.concat(
                F.replace(at("date_part"), F.lit("-"), F.lit("")),
                F.lpad(at("hour_part").cast("string"), 2, "0")))))
