"""A corpus pipeline from five operators: known languages, one of each group of near copies, no benchmark passages, no
personal data, and tokens of what is left.

Every stage takes the documents its predecessor kept, as rows of (doc_id, text, lang, source, n_chars) or whatever other
columns come along, and returns them with the same columns; the last one returns tokens. Rows with a NULL or empty text
leave with the first stage, which can't tell their language.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspan.llm import bpe, decontaminate, language_id, ngram_join, pii
from tillspan.llm.common import Scratch, table
from tillspan.llm.queries import VOCABULARY

# Near copies share so many hundredths of their shingles of so many words; op2's own values bind op2 alone.
NEAR_WORDS = 5
NEAR_PERCENT = 80


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language that leads clearly go."""
    model = language_id.learn(docs.where(~language_id.held_out(F.col("doc_id"))))
    return language_id.keep_known(docs, model)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return ngram_join.one_of_each(docs, n=NEAR_WORDS, percent=NEAR_PERCENT)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go, also with one that has a few words put in."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), slack=decontaminate.SLACK)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in a text is replaced by the name of its kind; every document stays."""
    return pii.mask_pii(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, and the ids as little-endian 32-bit numbers."""
    ranks = bpe.read_ranks(VOCABULARY)
    encoded = bpe.encode(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language_id", known_language),
    ("ngram_jaccard_join", distinct_texts),
    ("benchmark_decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("byte_level_bpe", tokens),
]

# Compression, personal data and byte pairs are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
