"""A training-data pipeline over ``documents``: each stage is stored and read again by the next.

All stages but the last return the columns of ``documents``; the last returns the tokens of every
document that the mix takes, as often as it takes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.llm import bloom_dedup, bpe, fair_mix, jaccard_join, language_id
from emberlog.llm.workload import vocabulary_path
from emberlog.session import stored

MIN_LANGUAGE_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled documents that are not held out; texts without a clear language go."""
    model = language_id.train(docs.filter(F.col("doc_id").isNotNull() & ~language_id.held_out(F.col("doc_id"))))
    found = language_id.identify(docs, model)
    return found.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("lang_score") >= MIN_LANGUAGE_SCORE)).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return bloom_dedup.keep_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents with similar five-word shingles the one with the smallest id stays."""
    return jaccard_join.keep_one(docs, k=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return fair_mix.take(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to it again."""
    tokenizer = bpe.Tokenizer.read(spark, vocabulary_path())
    found = bpe.encode(docs, tokenizer, decoded=True)
    return found.select("doc_id", "lang", "source", "n_chars", "n_tokens", "token_ids", (F.col("decoded_text") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("bpe", tokenize),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
