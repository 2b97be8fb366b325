"""Landed article feeds: JSON payloads with a status and an array of articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _text(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


ARTICLE_SCHEMA = T.StructType(
    _text("status")
    + [
        T.StructField(
            "articles",
            T.ArrayType(
                T.StructType(
                    _text("title", "description", "content", "author")
                    + [T.StructField("source", T.StructType(_text("name")))]
                    + _text("publishedAt", "url")
                )
            ),
        )
    ]
)


def articles_of(payloads: DataFrame) -> DataFrame:
    """One row per article of the payloads that report success, with its place in the payload."""
    ok = payloads.filter(F.col("status") == "ok")
    rows = ok.select(F.posexplode("articles").alias("feed_position", "a"))
    return rows.select(
        "feed_position",
        F.col("a.title").alias("title"),
        F.col("a.description").alias("description"),
        F.col("a.content").alias("content"),
        F.col("a.author").alias("author"),
        F.col("a.source.name").alias("source"),
        F.col("a.publishedAt").alias("published_at"),
        F.col("a.url").alias("url"),
    )


def read_article_feed(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All articles of the payload files under ``path``; one payload per line unless ``multi_line``."""
    return articles_of(spark.read.schema(ARTICLE_SCHEMA).option("multiLine", multi_line).json(path))


def stream_article_feed(
    spark: SparkSession, path: str, multi_line: bool = False, max_files: int | None = None
) -> DataFrame:
    """The same as a stream over files as they land."""
    reader = spark.readStream.schema(ARTICLE_SCHEMA).option("multiLine", multi_line)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return articles_of(reader.json(path))
