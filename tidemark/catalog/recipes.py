"""Frames that several queries share, each next to the same relation in SQL.

Two snapshots of ``orders`` stand for the state before and after a period: the
earlier one ends before 2001, the later one has purged the first months of 1995
and finished the pending orders of 2000.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog.base import table
from tidemark.functions.dates import instant
from tidemark.functions.hashing import deleted_hash, hash_keeping_nulls
from tidemark.functions.values import label_of, null_of
from tidemark.operators.columns import at
from tidemark.operators.keys import dealt_by_key, one_row_per_key
from tidemark.sources.sinks import stage

AS_OF = "2002-06-01 00:00:00"
NEXT_AS_OF = "2002-06-02 00:00:00"
EARLIER_RUN = "2001-01-01 00:00:00"

HASHED = ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate"]


def nvl_hash_sql(*columns: str) -> str:
    slots = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)
    return f"sha1(concat_ws('|~|', {slots}))"


def orders_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "orders")
            .filter(at("o_orderdate") < instant("2001-01-01 00:00:00"))
            .select("o_orderkey", "o_orderstatus",
                    F.nullif(at("o_orderpriority"), F.lit("4-NOT SPECIFIED"))
                    .alias("o_orderpriority"), "o_orderdate"))


def orders_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    finished = (at("o_orderstatus") == "P") & (at("o_orderdate") >= instant("2000-01-01 00:00:00"))
    return (table(spark, sf_dir, "orders")
            .filter(at("o_orderdate") >= instant("1995-07-01 00:00:00"))
            .select("o_orderkey",
                    F.when(finished, "F").otherwise(at("o_orderstatus")).alias("o_orderstatus"),
                    F.nullif(at("o_orderpriority"), F.lit("4-NOT SPECIFIED"))
                    .alias("o_orderpriority"), "o_orderdate"))


SNAPSHOTS_SQL = """
before AS (
  SELECT o_orderkey, o_orderstatus,
         nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority, o_orderdate
  FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01 00:00:00'),
after AS (
  SELECT o_orderkey,
         CASE WHEN o_orderstatus = 'P' AND o_orderdate >= TIMESTAMP '2000-01-01 00:00:00'
              THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
         nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority, o_orderdate
  FROM orders WHERE o_orderdate >= TIMESTAMP '1995-07-01 00:00:00')"""


def order_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staging table as earlier runs left it: finished orders of 1995 were closed."""
    closed = (at("o_orderstatus") == "F") & (at("o_orderdate") < instant("1996-01-01 00:00:00"))
    return (orders_before(spark, sf_dir)
            .withColumns({"start_date": at("o_orderdate"),
                          "end_date": F.when(closed, instant("2002-01-01 00:00:00")),
                          "creation_date": at("o_orderdate"),
                          "update_date": at("o_orderdate"),
                          "change_hash": F.when(closed, deleted_hash())
                          .otherwise(hash_keeping_nulls(*HASHED))}))


def order_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_after(spark, sf_dir).withColumns({
        "end_date": null_of("timestamp_ntz"), "change_hash": hash_keeping_nulls(*HASHED)})


ORDER_STATE_SQL = SNAPSHOTS_SQL + f""",
state AS (
  SELECT *, o_orderdate AS start_date,
         CASE WHEN o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1996-01-01 00:00:00'
              THEN TIMESTAMP '2002-01-01 00:00:00' END AS end_date,
         o_orderdate AS creation_date, o_orderdate AS update_date,
         CASE WHEN o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1996-01-01 00:00:00'
              THEN sha1('DELETED') ELSE {nvl_hash_sql(*HASHED)} END AS change_hash
  FROM before),
src AS (
  SELECT *, CAST(NULL AS TIMESTAMP) AS end_date, {nvl_hash_sql(*HASHED)} AS change_hash
  FROM after)"""

STAGING_KEYS = ["custkey", "partkey", "part_name", "supplier_name"]
STAGING_HASHED = STAGING_KEYS[:3] + ["part_brand", "supplier_name", "nation_name", "order_status"]
ORDER_KINDS = {"F": "FINISHED", "O": "OPEN"}


def staging_source(spark: SparkSession, sf_dir: str, shipped_from: str | None = None,
                   shipped_before: str | None = None, dealt: bool = False) -> DataFrame:
    """Five tables joined on equal keys, distinct, labelled and hashed.

    Rows are made distinct on the plain columns, before the hash is computed; the
    hash covers the raw status that the label is made from. If ``dealt``, copies are folded
    while rows are ids, and whole rows are shuffled once, without their hash, by ``STAGING_KEYS``.
    """
    lines = table(spark, sf_dir, "lineitem").filter(at("l_returnflag") == "N")
    if shipped_from:
        lines = lines.filter(at("l_shipdate") >= instant(shipped_from))
    if shipped_before:
        lines = lines.filter(at("l_shipdate") < instant(shipped_before))
    orders, part, supplier, nation = (table(spark, sf_dir, n)
                                      for n in ("orders", "part", "supplier", "nation"))
    sold = lines.join(orders, at("l_orderkey") == at("o_orderkey"))
    if dealt:
        sold = sold.select("o_custkey", "l_partkey", "l_suppkey", "o_orderstatus").distinct()
    rows = (sold.join(part, at("l_partkey") == at("p_partkey"))
            .join(supplier, at("l_suppkey") == at("s_suppkey"))
            .join(nation, at("s_nationkey") == at("n_nationkey"))
            .select(at("o_custkey").alias("custkey"), at("p_partkey").alias("partkey"),
                    at("p_name").alias("part_name"), at("p_brand").alias("part_brand"),
                    at("s_name").alias("supplier_name"), at("n_name").alias("nation_name"),
                    at("o_orderstatus").alias("order_status")))
    return ((dealt_by_key(rows, STAGING_KEYS) if dealt else rows).distinct()
            .withColumns({"order_kind": label_of(at("order_status"), ORDER_KINDS),
                          "end_date": null_of("timestamp_ntz"),
                          "change_hash": hash_keeping_nulls(*STAGING_HASHED)})
            .drop("order_status"))


def staging_source_sql(shipped: str = "") -> str:
    return f"""
  SELECT DISTINCT o_custkey AS custkey, p_partkey AS partkey, p_name AS part_name,
         p_brand AS part_brand, s_name AS supplier_name, n_name AS nation_name,
         CASE WHEN o_orderstatus = 'F' THEN 'FINISHED'
              WHEN o_orderstatus = 'O' THEN 'OPEN' ELSE '' END AS order_kind,
         CAST(NULL AS TIMESTAMP) AS end_date,
         {nvl_hash_sql('o_custkey', 'p_partkey', 'p_name', 'p_brand', 's_name', 'n_name',
                       'o_orderstatus')} AS change_hash
  FROM lineitem, orders, part, supplier, nation
  WHERE l_orderkey = o_orderkey AND l_partkey = p_partkey AND l_suppkey = s_suppkey
    AND s_nationkey = n_nationkey AND l_returnflag = 'N' {shipped}"""


SHIPPED_BEFORE, SHIPPED_FROM = "2001-01-01 00:00:00", "1995-07-01 00:00:00"


def staging_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored staging table of an earlier run, which had closed the rows of one nation."""
    closed = at("nation_name") == "NATION_3"
    earlier = staging_source(spark, sf_dir, shipped_before=SHIPPED_BEFORE, dealt=True)
    rows = one_row_per_key(earlier, STAGING_KEYS, "change_hash", dealt=True)
    return stage(rows.withColumns({
        "start_date": instant(EARLIER_RUN),
        "end_date": F.when(closed, instant(EARLIER_RUN)),
        "creation_date": instant(EARLIER_RUN), "update_date": instant(EARLIER_RUN),
        "change_hash": F.when(closed, deleted_hash()).otherwise(at("change_hash"))}), "staging-table")


STAGING_SQL = f"""
old_rows AS ({staging_source_sql(f"AND l_shipdate < TIMESTAMP '{SHIPPED_BEFORE}'")}),
new_rows AS ({staging_source_sql(f"AND l_shipdate >= TIMESTAMP '{SHIPPED_FROM}'")}),
state AS (
  SELECT * REPLACE (
           CASE WHEN nation_name = 'NATION_3' THEN TIMESTAMP '{EARLIER_RUN}' END AS end_date,
           CASE WHEN nation_name = 'NATION_3' THEN sha1('DELETED')
                ELSE change_hash END AS change_hash),
         TIMESTAMP '{EARLIER_RUN}' AS start_date, TIMESTAMP '{EARLIER_RUN}' AS creation_date,
         TIMESTAMP '{EARLIER_RUN}' AS update_date
  FROM old_rows
  QUALIFY row_number() OVER (PARTITION BY {', '.join(STAGING_KEYS)}
                             ORDER BY change_hash DESC) = 1),
src AS (
  SELECT * FROM new_rows
  QUALIFY row_number() OVER (PARTITION BY {', '.join(STAGING_KEYS)}
                             ORDER BY change_hash DESC) = 1)"""
