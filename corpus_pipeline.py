"""From raw documents to packed training sequences: five stages, each over all that the one before it kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwatch.llm.exact import drop_exact_duplicates
from sparkwatch.llm.packing import pack_tokens
from sparkwatch.llm.pii import sanitise
from sparkwatch.llm.quality import score_quality
from sparkwatch.llm.queries import TOKENIZER
from sparkwatch.llm.simhash import drop_near_duplicates
from sparkwatch.session import shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
KEEP_SCORE = 0.3  # documents below it are rejected


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from all labels of these documents, doesn't reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_quality(docs, labels, score_col="__score").filter(F.col("__score") >= KEEP_SCORE).select(COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return drop_exact_duplicates(docs).select(COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return drop_near_duplicates(docs).select(COLUMNS)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and what reveals it are replaced in the texts; n_chars follows."""
    return sanitise(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1,024 tokens."""
    return pack_tokens(docs, TOKENIZER)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("pii", personal), ("packing", packing)]
ORACLE_SQL = None  # neither the classifier nor the tokenizer can be said in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again by the next one."""
    root = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
