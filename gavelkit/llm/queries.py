"""Registered queries: each applies one operator to its whole table and returns the digest columns of its contract."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelkit.llm import alignment, ann, decontam, forest, idfile, jaccard, language, pieces, secret_scan, sharding, token_counts, warc, whitening

SHARDS, SHARD_KEY = 40, "shuffle-1"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def teaching_rows(docs: DataFrame) -> DataFrame:
    """Documents that may teach: the checksum of their id isn't 2 modulo 4; a null id has none and doesn't teach."""
    return docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2).select("text", "lang")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = language.fit(teaching_rows(table(spark, sf_dir, "documents")))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    out = language.with_language(docs, model)
    return out.select("doc_id", held.alias("held_out"), F.col("language.lang").alias("lang_pred"), "language.score", "language.margin", "language.rejected")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pieces.with_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))
    ids = F.col("pieces.ids")
    return out.select("doc_id", (F.octet_length(ids) / 4).cast("bigint").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2(F.col("pieces.decoded").cast("binary"), 256).alias("decoded_sha256"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = token_counts.with_token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", "counts.n_pretokens", "counts.n_tokens", "counts.log_prob")


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 16).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    out = sharding.shard_rows(rows, ["doc_id", "size", "text_crc32"], SHARDS, SHARD_KEY)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = secret_scan.with_spans(docs).withColumn("span", F.arrays_zip("secrets.kind", "secrets.start", "secrets.end"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("span", lambda s: s["kind"].isin("assign", "access", "hex"))
    count = lambda kind: F.size(F.filter("span", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return out.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("span")).alias("spans"))


def op9_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = idfile.round_trip(spark, docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(spark, table(spark, sf_dir, "pages"))
    return records.select(
        warc.page_number(F.col("record_id")).alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        warc.page_number(F.col("refers_to")).alias("refers_to"),
    )


def op11_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.similar(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path
    return alignment.aligned(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))[0]


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whitened(table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").cast("bigint"))


def _round(i: int, half: str, side: str) -> str:
    return f"CAST('0x' || substr(md5('{SHARD_KEY}:{i}:' || {half}), 1, 12) AS BIGINT) % {side}"


def _shards_sql() -> str:
    inner = "SELECT n, step, rows, a, b, p // b AS l, p % b AS r FROM walk WHERE step = 0 OR p >= rows"
    for i in range(1, sharding.ROUNDS + 1):
        halves = f"(l + {_round(i, 'r', 'a')}) % a AS l, r" if i % 2 else f"l, (r + {_round(i, 'l', 'b')}) % b AS r"
        inner = f"SELECT n, step, rows, a, b, {halves} FROM ({inner})"
    return f"""
WITH RECURSIVE crc_table AS (
  SELECT i AS b, 0 AS k, i AS c FROM range(256) t(i)
  UNION ALL SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_table WHERE k < 8),
steps AS (SELECT list(c ORDER BY b) AS t FROM crc_table WHERE k = 8),
sized AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 16 AS BIGINT) AS size,
    CAST(xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen(coalesce(text, ''))), lambda i: CAST('0x' || substr(hex(encode(coalesce(text, ''))), 2 * i + 1, 2) AS BIGINT))),
      lambda x, y: xor(x >> 8, t[CAST(xor(x & 255, y) AS BIGINT) + 1])), 4294967295) AS BIGINT) AS text_crc32
  FROM documents, steps),
numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS n FROM sized),
total AS (SELECT count(*) AS rows, CAST(floor(sqrt(count(*) - 1)) AS BIGINT) + 1 AS a FROM documents),
sides AS (SELECT rows, a, (rows + a - 1) // a AS b FROM total),
walk AS (
  SELECT n, n AS p, 0 AS step, rows, a, b FROM numbered, sides
  UNION ALL SELECT n, l * b + r, step + 1, rows, a, b FROM ({inner}))
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(p % {SHARDS} AS INTEGER) AS shard, CAST(p // {SHARDS} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM numbered JOIN walk USING (n) WHERE step > 0 AND p < rows"""


QUERIES = {f.__name__: f for f in (op1_language_id, op2_decontamination, op3_pieces, op4_nearest, op5_token_counts, op6_shards, op7_jaccard, op8_secrets, op9_id_files, op10_warc, op11_near_dedup, op12_alignment, op13_whitening)}
_WARC_SQL = """
WITH digits AS (SELECT page_id, html, sha1(coalesce(html, '')) AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS largest FROM pages)
SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(h, CAST(1 + 10 * (k // 8) AS INTEGER), 10) AS BIGINT) >> CAST(35 - 5 * (k % 8) AS INTEGER)) & 31 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> largest THEN largest END AS refers_to
FROM digits"""

_DECONTAM_SQL = """
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[k:k + 12], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k FROM i WHERE len(w) > 0)),
grams AS (SELECT r, k, n, array_to_string(w[k:k + n - 1], ' ') AS g FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hits AS (SELECT r, k, grams.n, item_id FROM grams JOIN win ON grams.g = win.g AND grams.n = win.n),
per AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM hits) GROUP BY r),
names AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN per USING (r) LEFT JOIN names USING (r)"""

ORACLES = {"op2_decontamination": _DECONTAM_SQL, "op6_shards": _shards_sql(), "op10_warc": _WARC_SQL}
