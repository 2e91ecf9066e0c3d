"""The thin queries over the corpus operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eqscene.llm._common import read_table, whole_text
from eqscene.llm.decontaminate import find_contamination, is_contaminated
from eqscene.llm.fingerprints import fingerprint_with_next
from eqscene.llm.hard_negatives import mine
from eqscene.llm.line_dedup import FUZZY_FROM, dedup_lines
from eqscene.llm.order_minhash import near_duplicates
from eqscene.llm.pii import pseudonymise
from eqscene.llm.quality import score_quality
from eqscene.llm.sentencepiece_lattice import encode
from eqscene.llm.sharding import assign_shards
from eqscene.llm.suffix_dedup import remove_repeats
from eqscene.llm.token_ids import through_files
from eqscene.llm.toxicity import score_toxicity
from eqscene.llm.whitening import whiten


#: Of the query alone, so that it gives the same pseudonyms each time; a real key is the caller's.
TEST_KEY = "key of the test query"


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(read_table(spark, sf_dir, "documents"), 16)


def _op1_sql(n: int = 16) -> str:
    """The same words, in DuckDB: list positions break ties towards the lower shard."""
    words = ", ".join(
        f"('0x' || substr(md5(k || ':{i // 4}'), {8 * (i % 4) + 1}, 8))::BIGINT" for i in range(n + 1)
    )
    crc_table = (
        "list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), "
        "lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END))"
    )
    return f"""
WITH t AS (SELECT {crc_table} AS crc_t),
d AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS k, coalesce(text, '') AS x,
         hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT *, [{words}] AS w FROM d),
s AS (
  SELECT doc_id, strlen(x) + 1 AS size, h,
         list_position(w[:{n}], list_max(w[:{n}])) - 1 AS shard,
         list_position(w, list_max(w)) - 1 AS grown_shard,
         substr(md5(k || ':cell'), 1, 3) AS cell FROM w)
SELECT doc_id, size::BIGINT AS size,
       xor(4294967295, list_reduce(
         list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
         lambda c, b: xor(c >> 8, crc_t[xor(c & 255, b) + 1]))) AS text_crc32,
       'key' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY cell, doc_id) - 1 AS slot,
       grown_shard::INT AS grown_shard
FROM s, t"""


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_with_next(read_table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, TEST_KEY).select("doc_id", "n_values", "text")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, counts=True).select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.char_length(whole_text()).cast("long").alias("kept_chars"),
        F.sha2(whole_text(), 256).alias("kept_sha256"),
    )


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded, and decoded again: the digest is that of the text with marks as spaces."""
    coded = encode(read_table(spark, sf_dir, "documents"), decoded=True)
    return coded.select("doc_id", "n_tokens", "token_ids", F.sha2("text", 256).alias("decoded_sha256"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = through_files(read_table(spark, sf_dir, "documents"))
    return coded.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS m, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
g AS (
  SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS s
  FROM (SELECT d.*, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM win))),
h AS (SELECT doc_id, i, g.m, item_id FROM g JOIN win USING (m, s)),
p AS (SELECT doc_id, count(*) AS n_hit FROM (
  SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS at FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)"""


OP8_SQL = f"""
WITH l AS (
  SELECT doc_id, i - 1 AS line_no, a[i] AS line FROM (
    SELECT doc_id, a, unnest(range(1, len(a) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents))),
u AS (
  SELECT line, min((doc_id, line_no)) AS first, length(line) AS n
  FROM l WHERE regexp_matches(line, '\\S') GROUP BY line),
f AS (
  SELECT DISTINCT b.line FROM u a JOIN u b
    ON a.first < b.first AND abs(a.n - b.n) <= 1 AND least(a.n, b.n) >= {FUZZY_FROM}
   AND (left(a.line, least(a.n, b.n) // 2) = left(b.line, least(a.n, b.n) // 2)
        OR right(a.line, least(a.n, b.n) - least(a.n, b.n) // 2) = right(b.line, least(a.n, b.n) - least(a.n, b.n) // 2))
  WHERE len(list_filter(range(0, least(a.n, b.n) + 1), lambda i: left(a.line, i) = left(b.line, i)
    AND substr(a.line, i + 1 + (a.n >= b.n)::INT) = substr(b.line, i + 1 + (b.n >= a.n)::INT))) > 0),
k AS (
  SELECT l.doc_id, l.line_no, l.line,
         coalesce((l.doc_id, l.line_no) <> u.first, false) OR f.line IS NOT NULL AS gone
  FROM l LEFT JOIN u ON l.line = u.line LEFT JOIN f ON l.line = f.line)
SELECT doc_id, count(*) AS n_lines, count_if(gone)::BIGINT AS n_removed,
       length(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), ''))::BIGINT AS kept_chars,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '')) AS kept_sha256
FROM k GROUP BY doc_id"""


OP11_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id))::INT AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
 AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_fingerprints": op3_fingerprints,
    "op4_quality": op4_quality,
    "op5_pii": op5_pii,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_line_dedup": op8_line_dedup,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_toxicity": op10_toxicity,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_token_ids": op12_token_ids,
    "op13_whitening": op13_whitening,
}

ORACLES: dict[str, str] = {
    "op1_sharding": _op1_sql(),
    "op7_decontamination": OP7_SQL,
    "op8_line_dedup": OP8_SQL,
    "op11_hard_negatives": OP11_SQL,
}
