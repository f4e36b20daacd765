"""The operators of this package as named queries over the test tables, and the same in DuckDB SQL where it can be said."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspan.llm import (
    bpe,
    decontaminate,
    fingerprints,
    html_extract,
    language_id,
    licenses,
    ngram_join,
    oracle,
    pii,
    resampling,
    secret_scan,
    sentencepiece_bpe,
    url_filter,
    whitening,
)
from tillspan.llm.common import table

# The rules of the contract.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language_id.learn(documents.where(~language_id.held_out(F.col("doc_id"))))
    found = language_id.predict(documents, model)
    return found.select(
        "doc_id",
        F.coalesce(language_id.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
        "rejected",
    )


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_spans(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_spans(table(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_near_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.near_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("near_items", F.array_join("near_items", ","))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(str(rule) for rule in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"), rules)


def op8_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(VOCABULARY)
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(documents, ranks, public_tokenizers.PATTERN, back="decoded").select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.learn(pages))


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    # Documents are files of the directory of their source.
    path = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    found = licenses.license_scan(documents.select(F.col("doc_id").alias("id"), path.alias("path"), "text"))
    return found.withColumnRenamed("id", "doc_id")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = sentencepiece_bpe.read_model(PIECES)
    return sentencepiece_bpe.encode(documents, vocabulary, spelled="spelled", back="decoded").select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("spelled", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_ngram_jaccard_join,
        op3_document_fingerprints,
        op4_secret_scans,
        op5_pii,
        op6_benchmark_decontamination,
        op6_near_passages,
        op7_url_filters,
        op8_byte_level_bpe,
        op9_html_extraction,
        op10_license_scans,
        op11_importance_resampling,
        op12_sentencepiece,
        op13_embedding_whitening,
    )
}
ORACLE_SQL = oracle.SQL
