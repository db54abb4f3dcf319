"""The registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.chat import format_chats
from tidemark.llm.chunks import dedupe_texts
from tidemark.llm.decontaminate import contaminated
from tidemark.llm.fingerprints import fingerprint_versions
from tidemark.llm.importance import resample
from tidemark.llm.langid import identify
from tidemark.llm.lines import drop_repeated_lines
from tidemark.llm.minhash import near_duplicates
from tidemark.llm.mixing import mix_sources
from tidemark.llm.negatives import mine_negatives
from tidemark.llm.pii import find_personal_data
from tidemark.llm.repeats import remove_repeats
from tidemark.llm.warc import archive_pages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if oracle:
            ORACLE[name] = oracle
        return run
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_NEAR_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 2 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM words),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, s FROM sets),
items AS (SELECT doc_id, n_shingles AS n, unnest(s) AS x FROM sizes),
rare AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY df, x) AS r FROM (
    SELECT doc_id, n, x, count(*) OVER (PARTITION BY x) AS df FROM items)),
heads AS (SELECT * FROM rare WHERE r <= n - CAST(ceil(0.8 * n) AS BIGINT) + 1),
pairs AS (
  SELECT DISTINCT a.doc_id AS u, b.doc_id AS v FROM heads a JOIN heads b ON a.x = b.x
  AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
counted AS (
  SELECT u, v, len(list_intersect(a.s, b.s)) AS k, a.n_shingles AS na, b.n_shingles AS nb
  FROM pairs JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v),
links AS (
  SELECT u, v FROM counted WHERE 100 * k >= 80 * (na + nb - k)
  UNION ALL SELECT v, u FROM counted WHERE 100 * k >= 80 * (na + nb - k)),
reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents
  UNION SELECT r.node, l.v FROM reach r JOIN links l ON l.u = r.seen)
SELECT s.doc_id, s.n_shingles, min(r.seen) AS component_id, s.doc_id = min(r.seen) AS kept
FROM sizes s JOIN reach r ON r.node = s.doc_id GROUP BY s.doc_id, s.n_shingles
"""


@query("op4_minhash", _NEAR_SQL)
def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups on two-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), n=2, percent=80)


@query("op8_mixing")
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by source."""
    return mix_sources(table(spark, sf_dir, "documents")).documents


_LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, line, translate(trim(line, e' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS k FROM (
    SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS line FROM (
      SELECT doc_id, string_split(coalesce(text, ''), e'\n') AS l FROM documents))),
keys AS (SELECT k, min(doc_id) AS first, max(doc_id) AS last FROM lines WHERE length(k) >= 10 GROUP BY k),
marked AS (
  SELECT l.*, coalesce(first < last AND doc_id <> first, false) AS gone
  FROM lines l LEFT JOIN keys USING (k))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, e'\n' ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op6_lines", _LINES_SQL)
def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines held by several documents."""
    return (drop_repeated_lines(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")))


@query("op7_language")
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return identify(table(spark, sf_dir, "documents"))


_LEAKS_SQL = r"""
WITH cut AS (
  SELECT item_id, trim(text, e' \t\n\x0b\x0c\r') AS t,
    length(t) - length(regexp_extract(t, '[^\n]*$')) AS head FROM benchmark),
plain AS (
  SELECT 0 AS kind, doc_id AS id, text FROM documents
  UNION ALL SELECT 1, item_id, substr(t, 1, head) FROM cut
  UNION ALL SELECT 2, item_id, substr(t, head + 1) FROM cut),
words AS (
  SELECT kind, id, list_filter(string_split_regex(lower(text), '[\x09-\x0D\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+'),
    lambda x: x <> '') AS w FROM plain WHERE text IS NOT NULL),
parts AS (SELECT kind, id, least(5, len(w)) AS n, w FROM words WHERE kind > 0),
grams AS (
  SELECT DISTINCT kind, id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (
    SELECT kind, id, n, w, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i FROM parts)),
held AS (
  SELECT DISTINCT id AS doc_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (
    SELECT id, w, n, unnest(range(1, CAST(greatest(len(w) - n + 2, 1) AS BIGINT))) AS i
    FROM words, (SELECT DISTINCT n FROM grams) WHERE kind = 0)),
shares AS (
  SELECT doc_id, g.id AS item_id, kind, count(*) AS k FROM grams g JOIN held h ON h.n = g.n AND h.g = g.g
  GROUP BY ALL),
sizes AS (SELECT kind, id AS item_id, count(*) AS m FROM grams GROUP BY ALL),
rated AS (SELECT doc_id, s.item_id, s.kind, k / m AS share FROM shares s JOIN sizes z
  ON s.item_id = z.item_id AND s.kind = z.kind)
SELECT q.doc_id, q.item_id, q.share AS question_overlap, a.share AS answer_overlap
FROM rated q JOIN rated a ON q.kind = 1 AND a.kind = 2 AND q.doc_id = a.doc_id AND q.item_id = a.item_id
WHERE q.share >= 0.7 AND a.share >= 0.7
"""


@query("op1_decontaminate", _LEAKS_SQL)
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items."""
    return (contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
            .select("doc_id", "item_id", "question_overlap", "answer_overlap"))


@query("op2_personal_data")
def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return find_personal_data(table(spark, sf_dir, "documents"))


_CHAT_SQL = r"""
WITH chats AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(length(role) || ':' || role || length(text) || ':' || text || e'\x1e', ''
      ORDER BY turn, role, text) AS told,
    string_agg('<|im_start|>' || replace(replace(role, '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>')
      || e'\n' || replace(replace(text, '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>')
      || e'<|im_end|>\n', '' ORDER BY turn, role, text) AS rendered
  FROM (SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS own FROM conversations)
  GROUP BY conv_id, own),
whole AS (
  SELECT told, min(conv_id) AS conv_id, min(n_turns) AS n_turns, count(*) AS n_records,
    min(rendered) AS rendered FROM chats GROUP BY told)
SELECT conv_id, n_turns, n_records, rendered FROM whole w WHERE NOT EXISTS (
  SELECT 1 FROM whole o WHERE o.n_turns > w.n_turns AND starts_with(o.told, w.told))
"""


@query("op3_chat", _CHAT_SQL)
def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maximal conversations, rendered."""
    return format_chats(table(spark, sf_dir, "conversations"))


@query("op10_fingerprints")
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprint_versions(table(spark, sf_dir, "documents"))


@query("op9_repeats")
def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 400 bytes that begin more than once, all copies removed."""
    return (remove_repeats(table(spark, sf_dir, "documents"), length=400, keep_first=False)
            .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))


_WARC_SQL = r"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (
  SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM d),
bits AS (
  SELECT *, list_transform(range(0, 32), lambda i: CAST(('0x' || h[(i * 5) // 4 + 1:(i * 5) // 4 + 2]) AS INTEGER)) AS x
  FROM f)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((x[i + 1] >> (3 - (i * 5) % 4)) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM bits
"""


@query("op5_warc", _WARC_SQL)
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, read back from the archives."""
    return (archive_pages(table(spark, sf_dir, "pages"))
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


_COPIES_SQL = r"""
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS t
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS kept, sha256(t) AS text_sha256
FROM plain
"""


@query("op11_exact", _COPIES_SQL)
def op11_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents equal but for blanks."""
    return (dedupe_texts(table(spark, sf_dir, "documents")).documents
            .select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS a, v.vec_id AS b, a.label = v.label AS same,
    CAST(list_inner_product(a.q, v.q) AS BIGINT) AS score
  FROM v a JOIN v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
p AS (
  SELECT a, b, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.b) AS INTEGER) AS rank,
  n.b AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
"""


@query("op12_negatives", _NEGATIVES_SQL)
def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector."""
    return mine_negatives(table(spark, sf_dir, "embeddings"))


_IMPORTANCE_SQL = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
texts AS (
  SELECT 0 AS kind, doc_id, text FROM documents UNION ALL SELECT 1, 0, text FROM benchmark),
words AS (
  SELECT kind, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
    lambda x: x <> '') AS w FROM texts),
counted AS (
  SELECT kind, doc_id, w, count(*) AS n FROM (SELECT kind, doc_id, unnest(w) AS w FROM words) GROUP BY ALL),
hashed AS (
  SELECT w, xor(list_reduce([4294967295] || list_transform(range(octet_length(encode(w))),
    lambda i: CAST('0x' || substr(hex(encode(w)), 2 * i + 1, 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT w FROM counted), crc),
placed AS (SELECT kind, doc_id, bucket, n FROM counted JOIN hashed USING (w)),
totals AS (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE kind = 0), 0) AS s,
    coalesce(sum(n) FILTER (WHERE kind = 1), 0) AS t FROM placed GROUP BY bucket),
sums AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM totals),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(totals.t AS DOUBLE) + 1) * (CAST(sums.s AS DOUBLE) + 10000)
    / ((CAST(totals.s AS DOUBLE) + 1) * (CAST(sums.t AS DOUBLE) + 10000)))) AS BIGINT) AS gain FROM totals, sums),
weights AS (SELECT doc_id, CAST(sum(n * gain) AS BIGINT) AS weight FROM placed JOIN gains USING (bucket)
  WHERE kind = 0 GROUP BY doc_id),
scored AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
      / 4294967296))) AS BIGINT) AS score
  FROM words LEFT JOIN weights USING (doc_id) WHERE kind = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS r,
    count(*) FILTER (WHERE n_features >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_features >= 20 AND r <= 10 * n // 100 THEN r END AS rank FROM ranked
"""


@query("op13_importance", _IMPORTANCE_SQL)
def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn towards the benchmark's words."""
    return (resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
            .select("doc_id", "n_features", "weight", "score", "rank"))
