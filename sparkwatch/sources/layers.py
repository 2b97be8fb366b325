"""Batch scans: raw files under an enforced schema, and the layers of the warehouse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import AsOf, today


def read_raw_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """CSV files with a header under a fixed schema; several paths and globs are read as one table.

    A value that does not parse becomes null, the rest of its row is kept.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").schema(schema)
    return reader.csv([paths] if isinstance(paths, str) else list(paths))


def with_lineage(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Add the file each row was read from. Apply it directly to a file scan."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def with_load_date(df: DataFrame, as_of: AsOf = None, name: str = "ingestion_date") -> DataFrame:
    return df.withColumn(name, today(as_of))


def read_layer(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A partitioned Parquet layer. With a schema no file needs to be opened to plan the scan."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)
