"""Queries on flattening, nesting and column sets.

The nested input is built row by row from ``documents``: a struct of properties,
an array with a struct per line of the text, holding an array of words, and a map.
Arrays are NULL for one source and the map for another.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.base import query, table
from tidemark.operators.columns import (
    at, clean_names, column_bounds, drop_null_columns, narrow_decimals, null_profile,
    rename_columns,
)
from tidemark.operators.nested import (
    explode_arrays, flatten_level, flatten_levels, inline_tables, nest_rows, normalize_any,
    normalize_path, rejoin_tables, split_tables, to_documents, widen_arrays,
)


def nested_documents(spark, sf_dir):
    lines = F.transform(F.filter(F.split("text", "\n"), lambda x: x != ""), lambda x: F.struct(
        x.alias("text"), F.struct(F.length(x).alias("chars"), F.split(x, " ").alias("words"))
        .alias("shape")))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.struct("lang", F.struct("source", at("n_chars").alias("chars")).alias("origin"))
        .alias("meta"),
        F.when(at("source") != "src0", lines).alias("lines"),
        F.when(at("source") != "src1",
               F.create_map(F.lit("lang"), at("lang"), F.lit("source"), at("source")))
        .alias("tags"))


_DOCS_SQL = """
docs AS (
  SELECT doc_id, lang AS meta_lang, source AS meta_origin_source, n_chars AS meta_origin_chars,
         CASE WHEN source <> 'src0'
              THEN list_filter(string_split(text, chr(10)), lambda x: x <> '') END AS lines,
         CASE WHEN source <> 'src1' THEN [0, 1] END AS tag_pos
  FROM documents),
line_rows AS (
  SELECT doc_id, unnest(lines) AS lines_text, unnest(range(len(lines))) AS lines_pos FROM docs),
lines_outer AS (
  SELECT d.doc_id, meta_lang, meta_origin_source, meta_origin_chars,
         CAST(coalesce(l.lines_pos, -1) AS INTEGER) AS lines_pos, l.lines_text,
         CAST(coalesce(length(l.lines_text), -1) AS INTEGER) AS lines_shape_chars
  FROM docs d LEFT JOIN line_rows l ON l.doc_id = d.doc_id),
tag_rows AS (
  SELECT doc_id, meta_lang, meta_origin_source, meta_origin_chars, unnest(tag_pos) AS tags_pos
  FROM docs),
tags_outer AS (
  SELECT d.doc_id, d.meta_lang, d.meta_origin_source, d.meta_origin_chars,
         coalesce(t.tags_pos, -1) AS tags_pos,
         CASE t.tags_pos WHEN 0 THEN 'lang' WHEN 1 THEN 'source' END AS tags_key,
         CASE t.tags_pos WHEN 0 THEN d.meta_lang WHEN 1 THEN d.meta_origin_source END
           AS tags_value
  FROM docs d LEFT JOIN tag_rows t ON t.doc_id = d.doc_id)"""


def _or_minus_one(df, *columns):
    return df.withColumns({c: F.coalesce(at(c), F.lit(-1)) for c in columns})


@query("flatten_root", f"""WITH {_DOCS_SQL}
SELECT doc_id, meta_lang, meta_origin_source, meta_origin_chars FROM docs""")
def flatten_root(spark, sf_dir):
    return split_tables(nested_documents(spark, sf_dir))["root"]


@query("flatten_array_child", f"WITH {_DOCS_SQL} SELECT * FROM lines_outer")
def flatten_array_child(spark, sf_dir):
    child = split_tables(nested_documents(spark, sf_dir))["root_lines"]
    return _or_minus_one(child, "lines_pos", "lines_shape_chars")


@query("flatten_array_grandchild", f"""WITH {_DOCS_SQL}
SELECT doc_id, CAST(length(lines_text) AS INTEGER) AS lines_shape_chars,
       CAST(unnest(range(len(string_split(lines_text, ' ')))) AS INTEGER) AS lines_shape_words_pos,
       unnest(string_split(lines_text, ' ')) AS lines_shape_words FROM line_rows""")
def flatten_array_grandchild(spark, sf_dir):
    words = split_tables(nested_documents(spark, sf_dir), outer=False)[
        "root_lines_lines_shape_words"]
    return words.select("doc_id", "lines_shape_chars", "lines_shape_words_pos", "lines_shape_words")


@query("flatten_map_child", f"WITH {_DOCS_SQL} SELECT * FROM tags_outer")
def flatten_map_child(spark, sf_dir):
    child = split_tables(nested_documents(spark, sf_dir))["root_tags"]
    return _or_minus_one(child, "tags_pos")


_REJOINED_SQL = f"""WITH {_DOCS_SQL},
words AS (
  SELECT doc_id, CAST(lines_pos AS INTEGER) AS lines_pos, unnest(string_split(lines_text, ' ')) AS word,
         CAST(unnest(range(len(string_split(lines_text, ' ')))) AS INTEGER) AS pos FROM line_rows)
SELECT l.doc_id, l.meta_lang, l.lines_pos, l.lines_shape_chars, coalesce(w.pos, -1) AS lines_shape_words_pos,
       w.word AS lines_shape_words, t.tags_pos, t.tags_key, t.tags_value
FROM lines_outer l JOIN tags_outer t ON l.doc_id = t.doc_id
LEFT JOIN words w ON w.doc_id = l.doc_id AND w.lines_pos = l.lines_pos"""


def _flat_words(wide):
    return _or_minus_one(wide, "lines_pos", "lines_shape_chars", "lines_shape_words_pos",
                         "tags_pos").select(
        "doc_id", "meta_lang", "lines_pos", "lines_shape_chars", "lines_shape_words_pos",
        "lines_shape_words", "tags_pos", "tags_key", "tags_value")


@query("flatten_rejoin", _REJOINED_SQL)
def flatten_rejoin(spark, sf_dir):
    tables = split_tables(nested_documents(spark, sf_dir), keep_positions=True)
    return _flat_words(rejoin_tables(tables, ["doc_id"]))


@query("flatten_inline", _REJOINED_SQL)
def flatten_inline(spark, sf_dir):
    return _flat_words(inline_tables(nested_documents(spark, sf_dir)))


@query("flatten_level", f"""WITH {_DOCS_SQL}
SELECT doc_id, meta_lang, meta_origin_source, meta_origin_chars,
       coalesce(array_to_string(list_transform(lines, lambda x:
         x || '/' || length(x) || '/' || len(string_split(x, ' '))), '|'), 'none') AS lines
       , CASE WHEN tag_pos IS NULL THEN 'none' ELSE meta_lang || '/' || meta_origin_source END AS tags
FROM docs""")
def flatten_one_level(spark, sf_dir):
    flat = flatten_level(nested_documents(spark, sf_dir))
    flat = flat.withColumn("tags", F.coalesce(F.array_join(F.map_values("tags"), "/"), F.lit("none")))
    text = F.transform("lines", lambda x: F.concat_ws(
        "/", x["text"], x["shape_chars"], F.size(x["shape_words"])))
    return flat.withColumn("lines", F.coalesce(F.array_join(text, "|"), F.lit("none")))


@query("explode_all", f"""WITH {_DOCS_SQL},
pairs AS (SELECT doc_id, lines, string_split(meta_origin_source, 'c') AS parts FROM docs)
SELECT p.doc_id, part, coalesce(l.lines_text, 'none') AS line
FROM (SELECT doc_id, unnest(parts) AS part FROM pairs) p
LEFT JOIN line_rows l ON l.doc_id = p.doc_id""")
def explode_all(spark, sf_dir):
    two = nested_documents(spark, sf_dir).select(
        "doc_id", F.col("lines.text").alias("line"),
        F.split("meta.origin.source", "c").alias("part"))
    return explode_arrays(two).withColumn("line", F.coalesce(at("line"), F.lit("none")))


@query("flatten_n", f"""WITH {_DOCS_SQL}
SELECT doc_id, meta_lang, meta_origin_source, meta_origin_chars, lines_shape_chars,
       count(*) AS n_words, CAST(coalesce(sum(length(word)), -1) AS BIGINT) AS n_word_chars,
       coalesce(max(tag), 'none') AS tag
FROM (SELECT l.*, w.word, CASE WHEN meta_origin_source <> 'src1' THEN meta_origin_source END AS tag
      FROM lines_outer l
      LEFT JOIN LATERAL (SELECT unnest(string_split(l.lines_text, ' ')) AS word) w ON TRUE)
GROUP BY ALL""")
def flatten_n(spark, sf_dir):
    flat = flatten_levels(nested_documents(spark, sf_dir), 2)
    line = ["doc_id", "meta_lang", "meta_origin_source", "meta_origin_chars", "lines_shape_chars"]
    # Spark sorts all rows for the largest text of a group. So words are folded by hash first, and
    # the largest is taken of what is left.
    folded = flat.groupBy(*line, at("tags")["source"].alias("tag")).agg(
        F.count(F.lit(1)).alias("n_words"),
        F.sum(F.length("lines_shape_words")).alias("n_word_chars"))
    return _or_minus_one(folded.groupBy(*line).agg(
        F.sum("n_words").alias("n_words"), F.sum("n_word_chars").alias("n_word_chars"),
        F.coalesce(F.max("tag"), F.lit("none")).alias("tag")),
        "lines_shape_chars", "n_word_chars")


@query("flatten_wide", "SELECT vec_id, " + ", ".join(
    f"CAST(floor(CAST(embedding[{i + 1}] AS DOUBLE) * 1000000) AS BIGINT) AS embedding_{i}"
    for i in range(64)) + ", label FROM embeddings")
def flatten_wide(spark, sf_dir):
    wide = widen_arrays(table(spark, sf_dir, "embeddings"))
    return wide.select("vec_id", *[
        F.floor(at(c).cast("double") * 1_000_000).alias(c)
        for c in wide.columns if c.startswith("embedding_")], "label")


@query("normalize_path", f"""WITH {_DOCS_SQL}
SELECT lines_text AS text, CAST(length(lines_text) AS INTEGER) AS shape_chars,
       len(string_split(lines_text, ' ')) AS n_words FROM line_rows""")
def normalize_lines(spark, sf_dir):
    """Records of one path; a field that is NULL everywhere goes."""
    records = nested_documents(spark, sf_dir).withColumn("lines", F.transform(
        "lines", lambda x: x.withField("unused", F.lit(None).cast("string"))))
    flat = normalize_path(records, "lines")
    words = F.size("shape_words").cast("bigint").alias("n_words")
    return flat.select(*[at(c) if c != "shape_words" else words for c in flat.columns])


@query("normalize_any", f"""WITH {_DOCS_SQL}
SELECT doc_id, meta_lang, meta_origin_source, meta_origin_chars FROM docs""")
def normalize_whole(spark, sf_dir):
    """Lines and tags are NULL in some rows, so only the other columns stay."""
    return normalize_any(nested_documents(spark, sf_dir))


@query("clean_names", """
SELECT o_orderkey AS order_key, o_orderstatus AS order_state_code,
       coalesce(nullif(o_orderpriority, '5-LOW'), '') AS order_state_prio_text FROM orders""")
def clean_order_names(spark, sf_dir):
    odd = table(spark, sf_dir, "orders").select(
        at("o_orderkey").alias("order key"),
        F.struct(at("o_orderstatus").alias("code"),
                 F.nullif(at("o_orderpriority"), F.lit("5-LOW")).alias("prio.text"))
        .alias("order:state"))
    cleaned = clean_names(odd)
    return cleaned.select("order_key", at("order_state")["code"].alias("order_state_code"),
                          F.coalesce(at("order_state")["prio_text"], F.lit(""))
                          .alias("order_state_prio_text"))


@query("nest_struct", """
SELECT l_orderkey, part, count(*) AS n_items,
       string_agg(l_linenumber || ':' || l_partkey || ':' || l_suppkey, ','
                  ORDER BY l_linenumber, l_partkey, l_suppkey) AS items
FROM (SELECT *, CAST((row_number() OVER (PARTITION BY l_orderkey
        ORDER BY l_linenumber, l_partkey, l_suppkey) - 1) // 3 AS INTEGER) AS part FROM lineitem)
GROUP BY l_orderkey, part""")
def nest_lines(spark, sf_dir):
    """Parts of three rows, so that many orders have several."""
    nested = nest_rows(table(spark, sf_dir, "lineitem"), ["l_orderkey"],
                       ["l_linenumber", "l_partkey", "l_suppkey"], "items", part_size=3)
    text = F.transform("items", lambda x: F.concat_ws(
        ":", x["l_linenumber"], x["l_partkey"], x["l_suppkey"]))
    return nested.select("l_orderkey", "part", F.size("items").cast("bigint").alias("n_items"),
                         F.array_join(text, ",").alias("items"))


@query("nest_by_bytes", """
WITH sized AS (
  SELECT *, length('{"turn":' || turn || ',"role":' || CAST(to_json(role) AS VARCHAR) || ',"n_chars":'
    || length(text) || '}') AS bytes FROM conversations),
placed AS (
  SELECT *, coalesce(sum(bytes) OVER (PARTITION BY conv_id ORDER BY turn, role, length(text)
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM sized)
SELECT conv_id, CAST(ahead // 100 AS INTEGER) AS part, count(*) AS n_turns,
       string_agg(turn, ',' ORDER BY turn, role, length(text)) AS turns
FROM placed GROUP BY ALL""")
def nest_turns_by_bytes(spark, sf_dir):
    """Parts of about a hundred bytes, so that conversations have several."""
    turns = table(spark, sf_dir, "conversations").withColumn("n_chars", F.length("text"))
    nested = nest_rows(turns, ["conv_id"], ["turn", "role", "n_chars"], "turns", part_bytes=100)
    return nested.select("conv_id", "part", F.size("turns").cast("bigint").alias("n_turns"),
                         F.concat_ws(",", F.transform("turns", lambda t: t["turn"].cast("string")))
                         .alias("turns"))


@query("nest_and_flatten", """
SELECT conv_id, turn, role, text FROM conversations""")
def nest_and_flatten(spark, sf_dir):
    """Nesting and flattening again gives the rows that were there."""
    nested = nest_rows(table(spark, sf_dir, "conversations"), ["conv_id"],
                       ["turn", "role", "text"], "turns", part_size=1000)
    flat = split_tables(nested, positions=False)["root_turns"]
    return flat.select("conv_id", at("turns_turn").alias("turn"), at("turns_role").alias("role"),
                       at("turns_text").alias("text"))


@query("to_json_doc", """
SELECT '{"event_id":' || event_id || CASE WHEN event_type <> 'error'
         THEN ',"event_type":"' || event_type || '"' ELSE '' END
       || ',"props":' || replace(props, ' ', '') || ',"user_id":' || user_id || '}' AS document
FROM events""")
def event_documents(spark, sf_dir):
    """Nested text may be laid out over several lines."""
    events = table(spark, sf_dir, "events").select(
        "event_id", F.nullif(at("event_type"), F.lit("error")).alias("event_type"),
        F.when(at("event_id") % 2 == 0, F.replace(at("props"), F.lit(":"), F.lit(":\n")))
        .otherwise(at("props")).alias("props"), "user_id")
    return to_documents(events, json_columns=["props"])


def _sparse_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif(at("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
        F.lit(None).cast("string").alias("remark"), "o_orderstatus")


_SPARSE_SQL = """(SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority,
  CAST(NULL AS VARCHAR) AS remark, o_orderstatus FROM orders)"""


@query("null_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_values FROM {_SPARSE_SQL}"
    for c in ("o_orderkey", "priority", "remark", "o_orderstatus")))
def profile_orders(spark, sf_dir):
    return null_profile(_sparse_orders(spark, sf_dir))


@query("drop_null_cols", f"SELECT o_orderkey, priority, o_orderstatus FROM {_SPARSE_SQL}")
def drop_null_cols(spark, sf_dir):
    return drop_null_columns(_sparse_orders(spark, sf_dir), "all")


@query("drop_any_null_cols", f"SELECT o_orderkey, o_orderstatus FROM {_SPARSE_SQL}")
def drop_any_null_cols(spark, sf_dir):
    return drop_null_columns(_sparse_orders(spark, sf_dir), "any")


@query("rename_cols", """
SELECT o_orderkey AS order_id, o_custkey AS o_orderstatus, o_orderstatus AS status FROM orders""")
def rename_cols(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return rename_columns(orders, ["o_orderkey", "absent", "o_custkey", "o_orderstatus"],
                          ["order_id", "nothing", "o_orderstatus", "status"])


@query("decimal_narrow", """
SELECT o_orderkey, o_custkey, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) AS price
FROM orders""")
def decimal_narrow(spark, sf_dir):
    return narrow_decimals(table(spark, sf_dir, "orders").select(
        "o_orderkey", at("o_custkey").cast("decimal(38,0)").alias("o_custkey"),
        at("o_totalprice").cast("decimal(14,2)").alias("price")))


@query("partition_bounds", """
SELECT min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders""")
def partition_bounds(spark, sf_dir):
    return column_bounds(table(spark, sf_dir, "orders"), "o_orderkey")


@query("fn_arrays", """
SELECT vec_id, len(embedding) AS n,
       CAST(len(list_filter(embedding, lambda x: x > 0)) AS INTEGER) AS n_positive,
       CAST(floor(CAST(embedding[1] AS DOUBLE) * 1000000) AS BIGINT) AS head,
       label AS s_label, CAST(vec_id AS VARCHAR) AS s_id FROM embeddings""")
def fn_arrays(spark, sf_dir):
    packed = F.struct(at("label").alias("label"), at("vec_id").cast("string").alias("id"))
    return (table(spark, sf_dir, "embeddings")
            .select("vec_id", "embedding", F.array(packed).alias("records"))
            .select("vec_id", F.size("embedding").cast("bigint").alias("n"),
                    F.size(F.filter("embedding", lambda x: x > 0)).alias("n_positive"),
                    F.floor(F.get("embedding", F.lit(0)).cast("double") * 1_000_000)
                    .alias("head"), F.explode("records").alias("s"))
            .select("vec_id", "n", "n_positive", "head", at("s")["label"].alias("s_label"),
                    at("s")["id"].alias("s_id")))
