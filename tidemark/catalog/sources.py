"""Queries on sources, sinks and published versions.

Each writes a given table in some format below the shared folder and reads it
back. The database queries load the tables into the database named by
``tidemark.jdbc.url`` and ``tidemark.jdbc.driver``; where these are unset they use
an embedded in-memory one, which only the driver's own process can see.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from tidemark.catalog.base import query, table
from tidemark.functions.dates import instant
from tidemark.operators.columns import at
from tidemark.plans.jobs import ingest_described
from tidemark.session import scratch_path
from tidemark.sources import jdbc
from tidemark.sources.publish import (
    publish, read_live, refresh_schema, replace_live, write_next,
)
from tidemark.sources.readers import (
    dual, external_table, list_files, parse_payloads, read_json_lines, read_parquet_prefix,
    read_source, register_views, run_sql,
)
from tidemark.sources.sinks import write_sink, write_text_gz

_ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_orderpriority"
_ORDERS_SQL = f"SELECT {_ORDERS} FROM orders"
_ORDERS_SCHEMA = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
                  "o_orderpriority string")


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(*_ORDERS.split(", "))


@query("src_files", """
SELECT 'csv' AS fmt, o_orderkey, o_orderstatus FROM orders UNION ALL
SELECT 'orc', o_orderkey, o_orderstatus FROM orders""")
def src_files(spark, sf_dir):
    parts = []
    for fmt, options in (("csv", {"header": "true"}), ("orc", {})):
        path = scratch_path(spark, f"orders-{fmt}")
        write_sink(_orders(spark, sf_dir), fmt, "overwrite", options, path=path)
        df = read_source(spark, fmt, options, paths=[path],
                         schema=_ORDERS_SCHEMA if fmt == "csv" else None)
        parts.append(df.select(F.lit(fmt).alias("fmt"), "o_orderkey", "o_orderstatus"))
    return parts[0].unionAll(parts[1])


def _json_folders(spark, sf_dir, options):
    """Orders in two folders, split by date, as JSON lines."""
    folders = []
    recent = at("o_orderdate") >= instant("1998-01-01 00:00:00")
    for label, keep in (("older", ~recent), ("recent", recent)):
        path = scratch_path(spark, f"orders-{label}")
        write_sink(table(spark, sf_dir, "orders").filter(keep).select(*_ORDERS.split(", ")),
                   "json", "overwrite", options, path=path)
        folders.append(path)
    return folders


@query("src_json", _ORDERS_SQL)
def src_json(spark, sf_dir):
    older, recent = _json_folders(spark, sf_dir, {})
    return read_json_lines(spark, [older, recent, older], _ORDERS_SCHEMA)


@query("src_json_gz", _ORDERS_SQL)
def src_json_gz(spark, sf_dir):
    """Without a schema, so that types are inferred from the data."""
    return read_json_lines(spark, _json_folders(spark, sf_dir, {"compression": "gzip"}))


@query("src_parquet_prefix", """
SELECT s_name AS name, s_nationkey AS nationkey, NULL AS segment FROM supplier UNION ALL
SELECT c_name, c_nationkey, c_mktsegment FROM customer""")
def src_parquet_prefix(spark, sf_dir):
    base = scratch_path(spark, "parties")
    suppliers = table(spark, sf_dir, "supplier").select(
        at("s_name").alias("name"), at("s_nationkey").alias("nationkey"))
    customers = table(spark, sf_dir, "customer").select(
        at("c_name").alias("name"), at("c_nationkey").alias("nationkey"),
        at("c_mktsegment").alias("segment"))
    write_sink(suppliers, "parquet", path=f"{base}/part/suppliers")
    write_sink(customers, "parquet", path=f"{base}/part/customers")
    return read_parquet_prefix(spark, base)


@query("src_glob", """
SELECT DISTINCT o_orderstatus AS status, 'part-' AS starts, '.parquet' AS ends FROM orders UNION ALL
SELECT DISTINCT o_orderstatus, 'part-', '.json' FROM orders WHERE o_orderstatus <> 'P'""")
def src_glob(spark, sf_dir):
    """The folders that hold files of a kind, from their paths alone, out of a mixed tree."""
    base = scratch_path(spark, "orders-by-status")
    orders = _orders(spark, sf_dir)
    write_sink(orders, "parquet", path=base, partition_by=["o_orderstatus"])
    write_sink(orders.filter("o_orderstatus <> 'P'"), "json", "append", path=base,
               partition_by=["o_orderstatus"])
    steps = F.split("path", "/")
    name = F.element_at(steps, -1)
    found = [list_files(spark, base, suffix=suffix, prefix="part-").select(
        F.element_at(F.split(F.element_at(steps, -2), "="), 2).alias("status"),
        F.substring(name, 1, 5).alias("starts"),
        F.regexp_extract(name, r"(\.[a-z]+)$", 1).alias("ends")).distinct()
        for suffix in (".parquet", ".json")]
    nothing = list_files(spark, base, suffix=".parquet", prefix="other-").select(
        "path", "path", "path")
    return found[0].unionAll(found[1]).unionAll(nothing)


@query("src_select_limit", """
SELECT event_type, user_id, event_id FROM events ORDER BY event_id LIMIT 500""")
def src_select_limit(spark, sf_dir):
    path = scratch_path(spark, "events-sorted")
    write_sink(table(spark, sf_dir, "events"), "parquet", path=path)
    columns = ["event_id", "event_type", "user_id"]
    return read_source(spark, "parquet", paths=path, columns=columns).orderBy("event_id").limit(500)


@query("external_table", """
SELECT event_id, user_id, nullif(CASE WHEN event_type = 'view' THEN '' ELSE event_type END, '')
  AS event_type, date_trunc('second', ts) AS created_at,
  CAST(json_extract(props, '$.k') AS BIGINT) AS rank
FROM events""")
def events_external(spark, sf_dir):
    path = scratch_path(spark, "events-raw")
    raw = table(spark, sf_dir, "events").select(
        at("event_id").cast("string").alias("id"), at("user_id").cast("string").alias("user_id"),
        F.when(at("event_type") == "view", "").otherwise(at("event_type")).alias("kind"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("created"), "props")
    write_sink(raw, "parquet", path=path)
    return external_table(spark, path, {
        "event_id": ("id", "bigint"), "user_id": ("user_id", "bigint"),
        "event_type": ("kind", "string"), "created_at": ("created", "timestamp_ntz"),
        "rank": (F.get_json_object("props", "$.k"), "bigint")})


@query("api_payload", """
SELECT event_id AS response, event_type AS kind, user_id AS id FROM events UNION ALL
SELECT event_id, 'props', CAST(json_extract(props, '$.k') AS BIGINT) FROM events""")
def api_payload(spark, sf_dir):
    """Landed bodies, each an array of two records."""
    path = scratch_path(spark, "responses")
    bodies = table(spark, sf_dir, "events").select(
        at("event_id").alias("response"), F.to_json(F.array(
            F.struct(at("event_type").alias("kind"), at("user_id").alias("id")),
            F.struct(F.lit("props").alias("kind"),
                     F.get_json_object("props", "$.k").cast("bigint").alias("id"))))
        .alias("body"))
    write_sink(bodies, "parquet", path=path)
    return parse_payloads(read_source(spark, "parquet", paths=path), "body",
                          "array<struct<kind string, id bigint>>", keep=["response"])


@query("dual", """
SELECT sha1('DELETED') AS deleted, count(*) AS n_orders, max(o_orderdate) AS last_order
FROM orders""")
def dual_relation(spark, sf_dir):
    dual(spark)
    table(spark, sf_dir, "orders").createOrReplaceTempView("dual_orders")
    return spark.sql("""SELECT sha1('DELETED') AS deleted,
                               (SELECT count(*) FROM dual_orders) AS n_orders,
                               (SELECT max(o_orderdate) FROM dual_orders) AS last_order
                        FROM dual""")


@query("temp_view_sql", """
SELECT c_mktsegment, count(*) AS n_orders, min(o_orderdate) AS first_order
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""")
def temp_view_sql(spark, sf_dir):
    register_views(spark, {
        f"view_{name}": {"format": "parquet", "paths": f"{sf_dir}/{name}.parquet"}
        for name in ("orders", "customer")})
    return run_sql(spark, """
        SELECT c_mktsegment, count(*) AS n_orders, min(o_orderdate) AS first_order
        FROM view_orders JOIN view_customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
                   ["set spark.sql.storeAssignmentPolicy=ANSI"])


@query("sink_roundtrip", "SELECT * FROM customer")
def sink_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "customer")
    customers = table(spark, sf_dir, "customer")
    first = at("c_mktsegment") == "BUILDING"
    write_sink(customers.filter(first), "parquet", "overwrite", {"compression": "snappy"},
               path=path)
    write_sink(customers.filter(~first), "parquet", "append", {"compression": "snappy"},
               path=path)
    return read_source(spark, "parquet", paths=path)


@query("sink_partitioned", """
SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events""")
def sink_partitioned(spark, sf_dir):
    path = scratch_path(spark, "events-by-day")
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.to_date("ts").alias("date"))
    write_sink(events, "parquet", path=path, partition_by=["date"])
    return read_source(spark, "parquet", paths=path).select(
        "event_id", "user_id", "event_type", at("date").cast("string").alias("day"))


@query("sink_text_gz", "SELECT event_id || '|' || event_type AS line FROM events")
def sink_text_gz(spark, sf_dir):
    path = scratch_path(spark, "event-lines")
    write_text_gz(table(spark, sf_dir, "events"), F.concat_ws("|", "event_id", "event_type"), path)
    return read_source(spark, "text", paths=path).select(at("value").alias("line"))


def _database(spark) -> jdbc.Database:
    url = spark.conf.get("tidemark.jdbc.url", None)
    if url:
        return jdbc.Database(url, spark.conf.get("tidemark.jdbc.driver"),
                             spark.conf.get("tidemark.jdbc.user", None),
                             spark.conf.get("tidemark.jdbc.password", None))
    return jdbc.Database(f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true",
                         "org.apache.derby.iapi.jdbc.AutoloadedDriver")


def _loaded(spark, sf_dir, name):
    """The given table in the database under a fresh name."""
    database, relation = _database(spark), f"{name}_{uuid.uuid4().hex[:12]}"
    jdbc.write_table(table(spark, sf_dir, name), database, relation)
    return database, relation


@query("src_jdbc", "SELECT s_suppkey, s_nationkey FROM supplier WHERE s_acctbal > 0")
def src_jdbc(spark, sf_dir):
    database, relation = _loaded(spark, sf_dir, "supplier")
    return jdbc.read_query(spark, database, f'SELECT "s_suppkey", "s_nationkey" '
                                            f'FROM {relation} WHERE "s_acctbal" > 0')


@query("src_jdbc_table", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def src_jdbc_table(spark, sf_dir):
    database, relation = _loaded(spark, sf_dir, "supplier")
    return (read_source(spark, "jdbc", database.options(), table=relation)
            .select("s_suppkey", "s_name", "s_nationkey"))


@query("src_jdbc_partitioned", "SELECT event_id, user_id, event_type FROM events")
def src_jdbc_partitioned(spark, sf_dir):
    database, relation = _loaded(spark, sf_dir, "events")
    return jdbc.read_split(spark, database,
                           f'SELECT "event_id", "user_id", "event_type" FROM {relation}',
                           jdbc.Split('"event_id"', 8))


@query("src_jdbc_partitioned_ts", "SELECT event_id, date_trunc('second', ts) AS ts FROM events")
def src_jdbc_partitioned_ts(spark, sf_dir):
    database, relation = _loaded(spark, sf_dir, "events")
    rows = jdbc.read_split(spark, database, f'SELECT "event_id", "ts" FROM {relation}',
                           jdbc.Split('"ts"', 8, session_init="VALUES 1"))
    return rows.select("event_id", F.date_trunc("second", "ts").cast("timestamp_ntz").alias("ts"))


@query("src_jdbc_even", "SELECT event_id, user_id, event_type FROM events")
def src_jdbc_even(spark, sf_dir):
    """Half of all rows have one value of the split column; they are cut by another."""
    database, relation = _loaded(spark, sf_dir, "events")
    hot = f'SELECT src.*, CASE WHEN MOD("event_id", 2) = 0 THEN 7 ELSE "user_id" END AS u FROM {relation} src'
    rows = jdbc.read_split(spark, database, hot, jdbc.Split("u", 8, even=True, also='"event_id"'))
    return rows.select("event_id", "user_id", "event_type")


@query("sink_jdbc", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def sink_jdbc(spark, sf_dir):
    database, relation = _database(spark), f"customer_{uuid.uuid4().hex[:12]}"
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    first = at("c_mktsegment") == "BUILDING"
    jdbc.write_table(customers.filter(first), database, relation, "overwrite", max_connections=8)
    jdbc.write_table(customers.filter(~first), database, relation, "append", max_connections=8)
    return jdbc.read_table(spark, database, relation)


@query("ingest_described", """
SELECT event_id, user_id, event_type, date_trunc('second', ts) AS ts, 20240115000000 AS load
FROM events UNION ALL
SELECT event_id, user_id, event_type, date_trunc('second', ts), 20240131000000 FROM events
WHERE ts > TIMESTAMP '2024-01-15 00:00:00'""")
def ingest_described_events(spark, sf_dir):
    """Two incremental loads of a database table, described by a specification; the first run
    of a job takes all rows."""
    database, relation = _loaded(spark, sf_dir, "events")
    control = scratch_path(spark, "control")
    spec = {
        "environment": {"test": {"dynamic_vars": {
            "$url": database.url, "$relation": relation, "$bucket": "landing"}}},
        "Source2Target": {
            "sources": {"app": {"app.events": {
                "sourcequery": 'SELECT "event_id", "user_id", "event_type", "ts" FROM $relation '
                               """WHERE "ts" > {{ts '{}'}}""",
                "load_type": "Incr", "jdbcUrl": "$url",
                "connectionProperties": {"driver": database.driver},
                "partition_flag": "Y",
                "partition_info": {"partition_column": '"event_id"', "num_partitions": 8,
                                   "fetch_size": 1000, "part_col_datatype": "int"}}}},
            "targets": {"s3": {"app.events": {
                "target_bucket_name": "$bucket", "target_key_name": "incr/app/events/",
                "target_partition_by": None, "target_write_mode": "overwrite",
                "target_file_format": "parquet",
                "writer_spark_options": {"target_compression_type": "snappy"}}}}}}
    root = scratch_path(spark, "store") + "/"
    for as_of in (datetime(2024, 1, 15), datetime(2024, 1, 31)):
        ingest_described(spark, spec, "app", "app.events", environment="test",
                         control_path=control, as_of=as_of, root=root)
    return spark.read.parquet(f"{root}landing/incr/app/events/").select(
        "event_id", "user_id", "event_type",
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("ts"), "load")


@query("publish_swap", """
SELECT 'while loading' AS seen, s_suppkey, s_nationkey FROM supplier UNION ALL
SELECT 'after commit', s_suppkey, s_nationkey + 100 FROM supplier""")
def publish_swap(spark, sf_dir):
    """Readers keep the first version until the second, already complete, is published."""
    base = scratch_path(spark, "supplier-published")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    replace_live(suppliers, base)
    version = write_next(suppliers.withColumn("s_nationkey", at("s_nationkey") + 100), base)
    during = read_live(spark, base)
    publish(spark, base, version, view="supplier_live")
    after = spark.table("supplier_live")
    return (during.select(F.lit("while loading").alias("seen"), "*")
            .unionAll(after.select(F.lit("after commit").alias("seen"), "*")))


@query("publish_schema_refresh", """
SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, 'none' AS remark FROM supplier""")
def publish_schema_refresh(spark, sf_dir):
    base = scratch_path(spark, "supplier-refreshed")
    replace_live(table(spark, sf_dir, "supplier"), base)
    wanted = spark.createDataFrame([], "s_suppkey string, s_name string, remark string").schema
    refresh_schema(spark, base, wanted, view="supplier_refreshed")
    return spark.table("supplier_refreshed").withColumn(
        "remark", F.coalesce("remark", F.lit("none")))
