"""From raw documents to token ids: five stages, each written as Parquet and read by the next.

quality      documents that the additive model rejects go
near_copies  of each group of near copies (five-word shingles, similarity 0.8) one row of the smallest id stays
benchmark    documents that hold a passage of a benchmark item go
personal     personal data in the texts that stay is replaced by its kind in brackets
tokens       texts are encoded and decoded; ids and decoded text are returned as digests

All stages but the last return the columns of documents. Rows without an id take part in all stages but never count
as copies; of an id with several texts each text is judged by itself, and equal rows count once. Stages one and four are models and the last needs a vocabulary, so there is no SQL for the whole.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stockline.llm.bpe import encode_decode
from stockline.llm.common import stored
from stockline.llm.decontaminate import find_passages
from stockline.llm.near_text import near_groups
from stockline.llm.personal import find_personal, redacted
from stockline.llm.quality import good_documents
from stockline.llm.queries import held_out, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good_documents(docs, table(spark, sf_dir, "labels").filter(~held_out()))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = stored(near_groups(docs, ids_link=False).select("doc_id", "row_key", "n_shingles", "chosen"), "groups")
    gone = groups.filter("not chosen").select(F.col("row_key").alias("gone_row"), F.col("doc_id").alias("gone_doc"))

    def same(rows: DataFrame) -> Column:
        return (F.xxhash64(docs["doc_id"], docs["text"]) == rows["gone_row"]) & (docs["doc_id"] == rows["gone_doc"])

    rest = docs.join(gone, same(gone), "left_anti")
    repeated = groups.filter("chosen and n_shingles > 0 and doc_id is not null").groupBy("row_key", "doc_id").count().filter("count > 1")
    repeated = stored(repeated.select(F.col("row_key").alias("gone_row"), F.col("doc_id").alias("gone_doc")), "repeated")
    if repeated.isEmpty():
        return rest
    once = rest.join(repeated, same(repeated), "left_semi").dropDuplicates(["doc_id", "text"])
    return rest.join(repeated, same(repeated), "left_anti").unionByName(once)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = find_passages(docs, table(spark, sf_dir, "benchmark"))
    gone = stored(found.filter("n_hit > 0").select(F.col("row_key").alias("gone_row"), F.col("doc_id").alias("gone_doc")).distinct(), "leaks")
    same = (F.xxhash64(docs["doc_id"], docs["text"]) == gone["gone_row"]) & docs["doc_id"].eqNullSafe(gone["gone_doc"])
    return docs.join(gone, same, "left_anti")


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = f"c{docs.columns.index('text')}"
    found = find_personal(plain, plain.columns, text)
    clean = found.withColumn(text, redacted(text, "spans")).select(plain.columns).toDF(*docs.columns)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("near_copies", near_copies), ("benchmark", benchmark), ("personal", personal), ("tokens", tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
