"""The corpus operators as queries over whole tables, and their SQL where it has any."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stockline.llm.context_mixing import score_texts
from stockline.llm.conversations import damaged, repair_conversations
from stockline.llm.decontaminate import find_passages
from stockline.llm.token_counts import count_tokens
from stockline.llm.bpe import encode_decode
from stockline.llm.near_text import near_groups
from stockline.llm.near_vectors import near_vectors
from stockline.llm.quality import score_quality
from stockline.llm.personal import KINDS, find_personal, joined
from stockline.llm.html_text import extract_text
from stockline.llm.manifest import audit_rows
from stockline.llm.sql import conversations_sql, manifest_sql
from stockline.llm.url_filter import Rule, judge_sql, judge_urls
from stockline.llm.warc import read_warc, write_warc
from stockline.session import fresh_folder

URL_RULES: list[Rule] = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
    ("com", "/de/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = write_warc(table(spark, sf_dir, "pages"), fresh_folder(spark, "warc"))
    return read_warc(spark, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_near_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), shingle=2).select("doc_id", "n_shingles", "component_id", "kept")


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def held_out() -> Column:
    """Whether a row's label is kept from fitting."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").filter(~held_out()))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op7_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal(table(spark, sf_dir, "documents"), ["doc_id"])
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    counts = [count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op11_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0, F.lit(True))
    return score_texts(table(spark, sf_dir, "documents"), learn)


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    return repair_conversations(damaged(table(spark, sf_dir, "conversations"), code))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_rows(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0)


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
WARC_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM d),
b AS (SELECT *, array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda s:
  substr('{_BASE32}', 1 + ((('0x' || substr(hex, 1 + 5 * i::INT, 5))::INT >> s::INT) & 31), 1)), '')), '') AS payload_digest FROM f)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id IS NOT DISTINCT FROM first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to FROM b"""

QUERIES = {"op1_warc": op1_warc, "op2_html_text": op2_html_text, "op3_url_filter": op3_url_filter,
    "op4_decontaminate": op4_decontaminate,
    "op5_token_counts": op5_token_counts,
    "op10_bpe": op10_bpe,
    "op9_near_text": op9_near_text,
    "op6_near_vectors": op6_near_vectors,
    "op8_quality": op8_quality,
    "op7_personal": op7_personal,
    "op11_context_mixing": op11_context_mixing,
    "op12_conversations": op12_conversations,
    "op13_manifest": op13_manifest,
}
ORACLE_SQL = {"op1_warc": WARC_SQL, "op3_url_filter": judge_sql(URL_RULES), "op12_conversations": conversations_sql(),
    "op13_manifest": manifest_sql()}
