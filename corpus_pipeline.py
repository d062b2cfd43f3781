"""Corpus pipeline: language ID, near-duplicate join, substring dedup, decontamination, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's documents. All but the last return the columns of documents. Rows without a
doc_id leave the pipeline in the first stage, as no decision on them could be named.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textforge.llm.common import small_side
from textforge.session import ensure_conf, materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str, least: float = 0.0) -> DataFrame:
    """Keeps documents with a language (operator 4), which becomes their ``lang``; those without a letter go. A document that
    switches between languages has a low score for each and stays; ``least`` would reject by score."""
    from textforge.llm.language_crf import identify

    found = identify(docs, keep=["text", "source", "n_chars"]).filter((F.col("lang_pred") != "und") & (F.col("score") >= least))
    return found.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that with the smallest doc_id, of each group linked by shingles (operator 1)."""
    from textforge.llm.ngram_join import join_documents

    joined = materialize(join_documents(docs, size=5, percent=80).select("doc_id", "component_id"), "pipeline-components")
    gone = joined.filter("doc_id <> component_id").select("doc_id")
    return docs.filter("doc_id is not null").join(small_side(gone, gone.count()), "doc_id", "left_anti").select(*COLUMNS)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes strings of 100 bytes or more that start earlier out of the texts (operator 6); a character that is cut goes."""
    from textforge.llm.suffix_dedup import dedup

    kept = dedup(docs, length=100, with_text=True, keep=["lang", "source"]).withColumnRenamed("kept_text", "text")
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that share no ten words with the benchmark (operator 8)."""
    from textforge.llm.decontaminate import decontaminate

    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    hit = materialize(decontaminate(docs, items, window=10).filter("n_hit > 0").select("doc_id"), "pipeline-contaminated")
    return docs.join(small_side(hit, hit.count()), "doc_id", "left_anti").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 tokens (operator 5)."""
    from textforge.llm.packing import pack

    return pack(docs, seq_len=2048, vocabulary="word_bpe_49k.json", end_id=0)


def configured(stage):
    """The stage with the session settings that the operators rely on."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ensure_conf(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [(stage.__name__, configured(stage)) for stage in (language_id, near_duplicates, substrings, decontamination, packing)]
ORACLE_SQL = None  # a trained model and a tokenizer are beyond SQL; tests hold every stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
