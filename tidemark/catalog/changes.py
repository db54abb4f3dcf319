"""Queries on change hashes, diffs, soft delete, upsert and effective dates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.catalog.base import query, table
from tidemark.catalog.recipes import (
    AS_OF, HASHED, NEXT_AS_OF, ORDER_STATE_SQL, SNAPSHOTS_SQL, STAGING_KEYS, STAGING_SQL,
    SHIPPED_FROM, nvl_hash_sql, order_source, order_state, orders_after, orders_before,
    staging_source, staging_source_sql, staging_table,
)
from tidemark.functions.dates import instant
from tidemark.functions.hashing import deleted_hash, hash_keeping_nulls, with_change_hash
from tidemark.functions.values import label_of
from tidemark.operators.columns import at
from tidemark.operators.diff import diff_snapshots, label_changes, label_changes_by_hash
from tidemark.operators.effective import open_rows, refresh_current_flag, with_current_flag
from tidemark.operators.keys import assign_surrogates, duplicate_keys, one_row_per_key
from tidemark.operators.setops import rows_except, rows_intersect, union_by_name
from tidemark.operators.upsert import merge_upsert, soft_delete
from tidemark.plans.jobs import (
    dimension_state, publish_dimension, publish_staging, publish_upsert, run_described, staging_state,
)
from tidemark.session import scratch_path
from tidemark.sources.publish import read_live, replace_live
from tidemark.sources.sinks import stage


def _nulled_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus",
        F.nullif(at("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("o_orderpriority"),
        "o_orderdate")


_NULLED_SQL = """(SELECT o_orderkey, o_orderstatus,
  nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority, o_orderdate FROM orders)"""


@query("change_hash_ws", f"""
SELECT o_orderkey, sha1(concat_ws('|~|', CAST(o_orderkey AS VARCHAR), o_orderstatus,
       o_orderpriority, CAST(o_orderdate AS VARCHAR))) AS change_hash FROM {_NULLED_SQL}""")
def change_hash_ws(spark, sf_dir):
    return (with_change_hash(_nulled_orders(spark, sf_dir), HASHED, keep_nulls=False)
            .select("o_orderkey", "change_hash"))


@query("change_hash_nvl", f"""
SELECT o_orderkey, {nvl_hash_sql(*HASHED)} AS change_hash FROM {_NULLED_SQL}""")
def change_hash_nvl(spark, sf_dir):
    return (with_change_hash(_nulled_orders(spark, sf_dir), HASHED)
            .select("o_orderkey", "change_hash"))


@query("case_label", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'FINISHED' WHEN o_orderstatus = 'O'
  THEN 'OPEN' ELSE '' END AS kind FROM orders""")
def case_label(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", label_of(at("o_orderstatus"), {"F": "FINISHED", "O": "OPEN"}).alias("kind"))


def _class_sql(condition: str) -> str:
    return f"WITH {SNAPSHOTS_SQL} {condition}"


@query("diff_new", _class_sql("""
SELECT * FROM (SELECT * FROM after EXCEPT SELECT * FROM before)
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM before)"""))
def diff_new(spark, sf_dir):
    return diff_snapshots(orders_after(spark, sf_dir), orders_before(spark, sf_dir),
                          "o_orderkey").new


_MODIFIED_SQL = """(SELECT * FROM (SELECT * FROM after EXCEPT SELECT * FROM before)
  WHERE o_orderkey IN (SELECT o_orderkey FROM before))"""


@query("diff_deleted", _class_sql(f"""
SELECT * FROM (SELECT * FROM before EXCEPT SELECT * FROM after)
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {_MODIFIED_SQL})"""))
def diff_deleted(spark, sf_dir):
    return diff_snapshots(orders_after(spark, sf_dir), orders_before(spark, sf_dir),
                          "o_orderkey").deleted


@query("diff_modified", _class_sql(f"SELECT * FROM {_MODIFIED_SQL}"))
def diff_modified(spark, sf_dir):
    return diff_snapshots(orders_after(spark, sf_dir), orders_before(spark, sf_dir),
                          "o_orderkey").modified


@query("diff_unmodified", _class_sql("SELECT * FROM after INTERSECT SELECT * FROM before"))
def diff_unmodified(spark, sf_dir):
    return diff_snapshots(orders_after(spark, sf_dir), orders_before(spark, sf_dir),
                          "o_orderkey").unmodified


_DIFF_ALL_SQL = _class_sql("""
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
       CASE WHEN a.o_orderkey IS NULL THEN b.o_orderstatus ELSE a.o_orderstatus END
         AS o_orderstatus,
       CASE WHEN a.o_orderkey IS NULL THEN b.o_orderpriority ELSE a.o_orderpriority END
         AS o_orderpriority,
       CASE WHEN a.o_orderkey IS NULL THEN b.o_orderdate ELSE a.o_orderdate END AS o_orderdate,
       CASE WHEN b.o_orderkey IS NULL THEN 'new' WHEN a.o_orderkey IS NULL THEN 'deleted'
            WHEN a.o_orderstatus = b.o_orderstatus
             AND a.o_orderpriority IS NOT DISTINCT FROM b.o_orderpriority
             AND a.o_orderdate = b.o_orderdate THEN 'unmodified' ELSE 'modified' END
         AS change_type
FROM after a FULL JOIN before b ON a.o_orderkey = b.o_orderkey""")


@query("diff_all", _DIFF_ALL_SQL)
def diff_all(spark, sf_dir):
    return label_changes(orders_after(spark, sf_dir), orders_before(spark, sf_dir), "o_orderkey")


@query("diff_all_by_hash", _DIFF_ALL_SQL)
def diff_all_by_hash(spark, sf_dir):
    after, before = (with_change_hash(df(spark, sf_dir), HASHED)
                     for df in (orders_after, orders_before))
    return label_changes_by_hash(after, before, "o_orderkey", "change_hash").drop("change_hash")


@query("set_except", _class_sql("""
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM after EXCEPT
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM before"""))
def set_except(spark, sf_dir):
    columns = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    return rows_except(orders_after(spark, sf_dir).select(columns),
                       orders_before(spark, sf_dir).select(columns))


@query("set_intersect", _class_sql("""
SELECT o_orderstatus, o_orderpriority, o_orderdate FROM after INTERSECT
SELECT o_orderstatus, o_orderpriority, o_orderdate FROM before"""))
def set_intersect(spark, sf_dir):
    columns = ["o_orderstatus", "o_orderpriority", "o_orderdate"]
    return rows_intersect(orders_after(spark, sf_dir).select(columns),
                          orders_before(spark, sf_dir).select(columns))


@query("union_by_name", """
SELECT c_name AS name, c_nationkey AS nationkey, c_mktsegment AS mktsegment FROM customer
UNION ALL BY NAME SELECT s_nationkey AS nationkey, s_name AS name FROM supplier""")
def union_of_files(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        at("c_name").alias("name"), at("c_nationkey").alias("nationkey"),
        at("c_mktsegment").alias("mktsegment"))
    suppliers = table(spark, sf_dir, "supplier").select(
        at("s_nationkey").alias("nationkey"), at("s_name").alias("name"))
    return union_by_name(customers, suppliers)


@query("staging_join", staging_source_sql())
def staging_join(spark, sf_dir):
    return staging_source(spark, sf_dir)


def _closed_sql(close: str) -> str:
    return f"""
WITH {ORDER_STATE_SQL}
SELECT s.* REPLACE (
         CASE WHEN {close} THEN TIMESTAMP '{AS_OF}' ELSE s.end_date END AS end_date,
         CASE WHEN {close} THEN TIMESTAMP '{AS_OF}' ELSE s.update_date END AS update_date,
         CASE WHEN {close} THEN sha1('DELETED') ELSE s.change_hash END AS change_hash)
FROM state s"""


_GONE = "NOT EXISTS (SELECT 1 FROM src n WHERE n.o_orderkey = s.o_orderkey)"


@query("soft_delete", _closed_sql(f"(s.end_date IS NULL AND {_GONE})"))
def soft_delete_orders(spark, sf_dir):
    return soft_delete(order_state(spark, sf_dir), order_source(spark, sf_dir),
                       ["o_orderkey"], AS_OF)


@query("soft_delete_restamp", _closed_sql("""NOT EXISTS (SELECT 1 FROM src n
  WHERE n.o_orderkey = s.o_orderkey AND s.end_date IS NULL)"""))
def soft_delete_restamp(spark, sf_dir):
    return soft_delete(order_state(spark, sf_dir), order_source(spark, sf_dir),
                       ["o_orderkey"], AS_OF, restamp_closed=True)


def _merged_sql(state: str, source: str, keys: list[str], kept: list[str], updated: list[str],
                as_of: str) -> str:
    """Upsert as a full join: state ``s``, source ``n``."""
    match = " AND ".join(f"s.{k} = n.{k}" for k in keys)
    new, hit = f"s.{keys[0]} IS NULL", f"(n.{keys[0]} IS NOT NULL AND s.change_hash <> n.change_hash)"
    stamp = f"TIMESTAMP '{as_of}'"
    columns = [f"coalesce(s.{k}, n.{k}) AS {k}" for k in keys]
    columns += [f"CASE WHEN {new} THEN {stamp} ELSE s.{c} END AS {c}" for c in kept]
    columns += [f"CASE WHEN {new} OR {hit} THEN n.{c} ELSE s.{c} END AS {c}" for c in updated]
    columns += [f"CASE WHEN {new} OR {hit} THEN {stamp} ELSE s.update_date END AS update_date"]
    return f"SELECT {', '.join(columns)} FROM {state} s FULL JOIN {source} n ON {match}"


@query("merge_staging", f"""WITH {ORDER_STATE_SQL}
{_merged_sql('state', 'src', ['o_orderkey'], ['start_date', 'creation_date'],
             ['o_orderstatus', 'o_orderpriority', 'o_orderdate', 'end_date', 'change_hash'],
             AS_OF)}""")
def merge_staging(spark, sf_dir):
    return merge_upsert(order_state(spark, sf_dir), order_source(spark, sf_dir),
                        ["o_orderkey"], AS_OF)


def _published_orders(spark, sf_dir, rows):
    """A published table whose files hold ranges of keys."""
    base = scratch_path(spark, "orders-published")
    replace_live(rows(spark, sf_dir).repartitionByRange(16, "o_orderkey"), base)
    return base


@query("merge_by_file", f"""WITH {ORDER_STATE_SQL}
{_merged_sql('state', 'src', ['o_orderkey'], ['start_date', 'creation_date'],
             ['o_orderstatus', 'o_orderpriority', 'o_orderdate', 'end_date', 'change_hash'],
             AS_OF)}""")
def merge_by_file(spark, sf_dir):
    base = _published_orders(spark, sf_dir, order_state)
    publish_upsert(spark, base, order_source(spark, sf_dir), ["o_orderkey"], AS_OF,
                   cluster_by=["o_orderkey"])
    return read_live(spark, base)


@query("merge_dup_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def merge_dup_keys(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("merge_one_per_key", f"""
SELECT * FROM ({staging_source_sql()})
QUALIFY row_number() OVER (PARTITION BY {', '.join(STAGING_KEYS)} ORDER BY change_hash DESC) = 1
""")
def merge_one_per_key(spark, sf_dir):
    return one_row_per_key(stage(staging_source(spark, sf_dir)), STAGING_KEYS, "change_hash")


_STAGING_RUN_SQL = f"""
WITH {STAGING_SQL},
closed AS (
  SELECT s.* EXCLUDE (gone) REPLACE (
    CASE WHEN gone THEN TIMESTAMP '{AS_OF}' ELSE end_date END AS end_date,
    CASE WHEN gone THEN TIMESTAMP '{AS_OF}' ELSE update_date END AS update_date,
    CASE WHEN gone THEN sha1('DELETED') ELSE change_hash END AS change_hash)
  FROM (SELECT state.*, state.end_date IS NULL AND NOT EXISTS (
          SELECT 1 FROM src WHERE {' AND '.join(f'src.{k} = state.{k}' for k in STAGING_KEYS)})
          AS gone FROM state) s)
{_merged_sql('closed', 'src', STAGING_KEYS, ['start_date', 'creation_date'],
             ['part_brand', 'nation_name', 'order_kind', 'end_date', 'change_hash'], AS_OF)}"""


@query("staging_job", _STAGING_RUN_SQL)
def staging_job(spark, sf_dir):
    """The flagship: join, hash, soft delete and upsert into the staging table."""
    return staging_state(staging_table(spark, sf_dir),
                         staging_source(spark, sf_dir, shipped_from=SHIPPED_FROM, dealt=True),
                         STAGING_KEYS, AS_OF, on_duplicate="largest", dealt=True)


DIMENSION_HASHED = [*HASHED, "start_date", "end_date", "is_current"]
DIMENSION_KEYS = ["o_orderkey", "start_date"]


def order_dimension(spark, sf_dir):
    """A dimension in which flags were last set before some rows came to their end."""
    return (order_state(spark, sf_dir)
            .withColumns({"order_id": at("o_orderkey") + 250_000, "is_current": F.lit("Y")})
            .withColumn("change_hash", hash_keeping_nulls(*DIMENSION_HASHED)))


def order_control(spark, sf_dir):
    """One finished window per order status, ending with its last order."""
    last = F.max("o_orderdate")
    return (table(spark, sf_dir, "orders").groupBy(at("o_orderstatus").alias("job_name"))
            .agg(last.alias("start_timestamp"), last.alias("end_timestamp"),
                 last.alias("recorded_at")))


_DIMENSION_SQL = f"""
{ORDER_STATE_SQL},
dimension AS (
  SELECT * REPLACE ({nvl_hash_sql(*DIMENSION_HASHED)} AS change_hash)
  FROM (SELECT *, o_orderkey + 250000 AS order_id, 'Y' AS is_current FROM state)),
closed AS (
  SELECT s.* REPLACE (
    CASE WHEN s.end_date IS NULL AND {_GONE} THEN TIMESTAMP '{AS_OF}' ELSE s.end_date END
      AS end_date,
    CASE WHEN s.end_date IS NULL AND {_GONE} THEN TIMESTAMP '{AS_OF}' ELSE s.update_date END
      AS update_date,
    CASE WHEN s.end_date IS NULL AND {_GONE} THEN sha1('DELETED') ELSE s.change_hash END
      AS change_hash) FROM state s),
staging AS ({_merged_sql('closed', 'src', ['o_orderkey'], ['start_date', 'creation_date'],
                         ['o_orderstatus', 'o_orderpriority', 'o_orderdate', 'end_date',
                          'change_hash'], AS_OF)}),
refreshed AS (
  SELECT * REPLACE (
    CASE WHEN TIMESTAMP '{NEXT_AS_OF}' BETWEEN start_date
              AND coalesce(end_date, TIMESTAMP '4712-12-31 00:00:00') THEN 'Y' ELSE 'N' END
      AS is_current) FROM dimension),
recent AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority, o_orderdate, start_date, end_date,
         CASE WHEN TIMESTAMP '{NEXT_AS_OF}' BETWEEN start_date
              AND coalesce(end_date, TIMESTAMP '4712-12-31 00:00:00') THEN 'Y' ELSE 'N' END
           AS is_current
  FROM staging WHERE update_date >= (SELECT max(o_orderdate) - INTERVAL 7 DAY FROM orders
                                     WHERE o_orderstatus = 'F')),
dsrc AS (SELECT *, {nvl_hash_sql(*DIMENSION_HASHED)} AS change_hash FROM recent),
merged AS (
  SELECT coalesce(s.o_orderkey, n.o_orderkey) AS o_orderkey,
         coalesce(s.start_date, n.start_date) AS start_date,
         coalesce(s.order_id, (SELECT max(order_id) FROM dimension)
           + row_number() OVER (PARTITION BY s.order_id IS NULL
                                ORDER BY n.o_orderkey, n.start_date)) AS order_id,
         coalesce(s.creation_date, TIMESTAMP '{NEXT_AS_OF}') AS creation_date,
         CASE WHEN s.o_orderkey IS NULL OR (n.o_orderkey IS NOT NULL
                   AND s.change_hash <> n.change_hash)
              THEN TIMESTAMP '{NEXT_AS_OF}' ELSE s.update_date END AS update_date,
         {', '.join(f'''CASE WHEN s.o_orderkey IS NULL OR (n.o_orderkey IS NOT NULL
                   AND s.change_hash <> n.change_hash) THEN n.{c} ELSE s.{c} END AS {c}'''
                    for c in ('o_orderstatus', 'o_orderpriority', 'o_orderdate', 'end_date',
                              'is_current', 'change_hash'))}
  FROM refreshed s FULL JOIN dsrc n
    ON s.o_orderkey = n.o_orderkey AND s.start_date = n.start_date)"""


def _order_staging(spark, sf_dir):
    return staging_state(order_state(spark, sf_dir), order_source(spark, sf_dir),
                         ["o_orderkey"], AS_OF)


def _dimension_after(spark, sf_dir):
    return dimension_state(order_dimension(spark, sf_dir), _order_staging(spark, sf_dir),
                           order_control(spark, sf_dir), job="F", keys=DIMENSION_KEYS,
                           hashed=DIMENSION_HASHED, surrogate="order_id", as_of=NEXT_AS_OF)


@query("dim_job", f"WITH {_DIMENSION_SQL} SELECT * FROM merged")
def dim_job(spark, sf_dir):
    return _dimension_after(spark, sf_dir)


@query("sync_by_file", f"WITH {_DIMENSION_SQL} SELECT * FROM staging")
def sync_by_file(spark, sf_dir):
    """The staging job on a published table, of which only files with changed rows are rewritten."""
    base = _published_orders(spark, sf_dir, order_state)
    publish_staging(spark, base, order_source(spark, sf_dir), ["o_orderkey"], AS_OF)
    return read_live(spark, base)


@query("dim_by_file", f"WITH {_DIMENSION_SQL} SELECT * FROM merged")
def dim_by_file(spark, sf_dir):
    """The dimension job on a published dimension, file by file."""
    base = _published_orders(spark, sf_dir, order_dimension)
    publish_dimension(spark, base, _order_staging(spark, sf_dir), order_control(spark, sf_dir),
                      job="F", keys=DIMENSION_KEYS, hashed=DIMENSION_HASHED, surrogate="order_id",
                      as_of=NEXT_AS_OF, cluster_by=["o_orderkey"])
    return read_live(spark, base)


@query("report_open_rows", f"""WITH {ORDER_STATE_SQL}
SELECT o_orderkey, o_orderstatus, o_orderpriority, start_date, creation_date AS create_date,
       update_date FROM state WHERE end_date IS NULL""")
def report_open_rows(spark, sf_dir):
    return open_rows(order_state(spark, sf_dir)).select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "start_date",
        at("creation_date").alias("create_date"), "update_date")


_FLAG_SQL = f"""CASE WHEN TIMESTAMP '{AS_OF}' BETWEEN start_date
  AND coalesce(end_date, TIMESTAMP '4712-12-31 00:00:00') THEN 'Y' ELSE 'N' END"""


@query("merge_dim", f"""WITH {ORDER_STATE_SQL},
dimension AS (
  SELECT * REPLACE ({nvl_hash_sql(*DIMENSION_HASHED)} AS change_hash)
  FROM (SELECT *, o_orderkey + 250000 AS order_id, 'Y' AS is_current FROM state)),
loaded AS (
  SELECT *, {nvl_hash_sql(*DIMENSION_HASHED)} AS change_hash
  FROM (SELECT *, {_FLAG_SQL} AS is_current FROM (
          SELECT a.*, a.o_orderdate AS start_date,
                 CAST(NULL AS TIMESTAMP) AS end_date FROM after a)))
SELECT d.*, m.* FROM ({_merged_sql('dimension', 'loaded', DIMENSION_KEYS, ['creation_date'],
                                   ['o_orderstatus', 'o_orderpriority', 'o_orderdate', 'end_date',
                                    'is_current', 'change_hash'], AS_OF)}) m
LEFT JOIN (SELECT o_orderkey AS k, order_id FROM dimension) d0 ON d0.k = m.o_orderkey
CROSS JOIN LATERAL (SELECT coalesce(CAST(d0.order_id AS VARCHAR), 'new') AS order_id) d""")
def merge_dim(spark, sf_dir):
    source = with_change_hash(
        with_current_flag(orders_after(spark, sf_dir).withColumns({
            "start_date": at("o_orderdate"),
            "end_date": F.lit(None).cast("timestamp_ntz")}), AS_OF), DIMENSION_HASHED)
    merged = merge_upsert(order_dimension(spark, sf_dir), source, DIMENSION_KEYS, AS_OF,
                          stamp_on_insert=("creation_date", "update_date"),
                          keep_on_update=("creation_date", "order_id"))
    return merged.withColumn("order_id",
                             F.coalesce(at("order_id").cast("string"), F.lit("new")))


@query("refresh_flag", f"""WITH {ORDER_STATE_SQL}
SELECT o_orderkey, CASE WHEN o_orderpriority IS NULL THEN 'N' ELSE 'Y' END AS was_current,
       {_FLAG_SQL} AS is_current FROM state""")
def refresh_flag(spark, sf_dir):
    flagged = order_state(spark, sf_dir).withColumn(
        "was_current", F.when(at("o_orderpriority").isNull(), "N").otherwise("Y"))
    return (refresh_current_flag(flagged.withColumn("is_current", at("was_current")), AS_OF)
            .select("o_orderkey", "was_current", "is_current"))


@query("current_flag", f"""WITH {ORDER_STATE_SQL}
SELECT o_orderkey, {_FLAG_SQL} AS is_current FROM state""")
def current_flag(spark, sf_dir):
    return (with_current_flag(order_state(spark, sf_dir), AS_OF)
            .select("o_orderkey", "is_current"))


@query("surrogate_key", """
SELECT o_orderkey, o_custkey, 249999 + row_number() OVER (ORDER BY o_custkey, o_orderkey)
  AS order_id FROM orders""")
def surrogate_key(spark, sf_dir):
    return assign_surrogates(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"),
                             "order_id", ["o_custkey", "o_orderkey"], 250_000)


@query("fn_hash", """
SELECT o_orderkey, sha1(o_orderstatus) AS plain, sha1('DELETED') AS deleted,
       concat_ws('|~|', o_orderstatus, nullif(o_orderpriority, '4-NOT SPECIFIED'), 'end') AS joined,
       o_orderstatus || '|~|' || coalesce(nullif(o_orderpriority, '4-NOT SPECIFIED'), '') AS slots
FROM orders""")
def fn_hash(spark, sf_dir):
    priority = F.nullif(at("o_orderpriority"), F.lit("4-NOT SPECIFIED"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.sha1("o_orderstatus").alias("plain"), deleted_hash().alias("deleted"),
        F.concat_ws("|~|", at("o_orderstatus"), priority, F.lit("end")).alias("joined"),
        F.concat(at("o_orderstatus"), F.lit("|~|"), F.coalesce(priority, F.lit("")))
        .alias("slots"))


_FIRST_RUN, _SECOND_RUN = "2002-06-01 00:00:00", "2002-06-20 00:00:00"


def _described_runs(spark, sf_dir, with_dimension=True):
    """A staging job and a dimension job over two consecutive periods, as described."""
    staging, dimension, control = (scratch_path(spark, n) for n in ("stg", "dim", "control"))
    for base, extra in ((staging, ""), (dimension, ", order_id bigint, is_current string")):
        replace_live(spark.createDataFrame([], "o_orderkey bigint, o_orderstatus string, "
                     "o_orderpriority string, o_orderdate timestamp_ntz, start_date timestamp_ntz, "
                     "end_date timestamp_ntz, creation_date timestamp_ntz, "
                     f"update_date timestamp_ntz, change_hash string{extra}"), base)
    spec = {
        "global": {"transform": {"keys": ["o_orderkey"]}},
        "environment": {"test": {"dynamic_vars": {"$stg": staging, "$dim": dimension,
                                                  "$control": control}}},
        "job": {"environment": "test", "spark_options": ["set spark.sql.ansi.enabled=true"]},
        "control": {"path": "$control", "name": "orders_staging"},
        "stages": [{"orders_staging": {
            "views": [{"described_orders": ["Y", "orders_of_period"]}],
            "sql": "SELECT *, CAST(NULL AS TIMESTAMP_NTZ) AS end_date FROM described_orders",
            "transform": {"kind": "upsert", "target": "$stg", "hashed": HASHED,
                          "view": "described_staging"}}}]}
    on_staging = {**spec, "control": {"path": "$control", "name": "orders_dimension"}, "stages": [
        {"orders_dimension": {
            "sql": "SELECT * FROM described_staging",
            "transform": {"kind": "dimension", "target": "$dim", "keys": DIMENSION_KEYS,
                          "hashed": DIMENSION_HASHED, "surrogate": "order_id"}}}]}
    for rows, as_of in ((orders_before, _FIRST_RUN), (orders_after, _SECOND_RUN)):
        rows(spark, sf_dir).createOrReplaceTempView("orders_of_period")
        for described in (spec, on_staging) if with_dimension else (spec,):
            run_described(spark, described, datetime.fromisoformat(as_of))
    return read_live(spark, staging), read_live(spark, dimension)


_TWO_RUNS_SQL = f"""
{SNAPSHOTS_SQL},
b AS (SELECT *, {nvl_hash_sql(*HASHED)} AS h FROM before),
a AS (SELECT *, {nvl_hash_sql(*HASHED)} AS h FROM after),
staging AS (
  SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey,
    coalesce(a.o_orderstatus, b.o_orderstatus) AS o_orderstatus,
    CASE WHEN a.o_orderkey IS NULL THEN b.o_orderpriority ELSE a.o_orderpriority END AS o_orderpriority,
    coalesce(a.o_orderdate, b.o_orderdate) AS o_orderdate,
    CASE WHEN b.o_orderkey IS NULL THEN TIMESTAMP '{_SECOND_RUN}' ELSE TIMESTAMP '{_FIRST_RUN}' END AS start_date,
    CASE WHEN a.o_orderkey IS NULL THEN TIMESTAMP '{_SECOND_RUN}' END AS end_date,
    CASE WHEN b.o_orderkey IS NULL THEN TIMESTAMP '{_SECOND_RUN}' ELSE TIMESTAMP '{_FIRST_RUN}' END AS creation_date,
    CASE WHEN a.h = b.h THEN TIMESTAMP '{_FIRST_RUN}' ELSE TIMESTAMP '{_SECOND_RUN}' END AS update_date,
    coalesce(a.h, sha1('DELETED')) AS change_hash
  FROM b FULL JOIN a ON a.o_orderkey = b.o_orderkey)"""


@query("spec_staging", f"WITH {_TWO_RUNS_SQL} SELECT * FROM staging")
def spec_staging(spark, sf_dir):
    return _described_runs(spark, sf_dir, with_dimension=False)[0]


@query("spec_dimension", f"""WITH {_TWO_RUNS_SQL}
SELECT o_orderkey, o_orderstatus, o_orderpriority, o_orderdate, start_date, end_date, creation_date,
  update_date, 249999 + row_number() OVER (ORDER BY creation_date, o_orderkey) AS order_id, 'Y' AS is_current
FROM staging""")
def spec_dimension(spark, sf_dir):
    return _described_runs(spark, sf_dir)[1].drop("change_hash")
