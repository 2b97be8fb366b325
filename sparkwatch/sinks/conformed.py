"""Tables with a reject store: one write, good and rejected rows apart by partition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.conform import REASONS, apply_defaults, conform
from .layers import write_layer
from .snapshots import path_exists

OUTCOME = "outcome"  # layout column: good or rejected
RAW = "raw"  # of a rejected row: what it held, as JSON


def conformed(df: DataFrame, schema: T.StructType, lengths: Mapping[str, int] | None = None, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """The columns of ``schema`` by defaults and casts, then outcome, reject_reasons and raw.

    Rejected rows keep what they held; good rows have null in the last two.
    """
    filled = apply_defaults(df, defaults) if defaults else df
    packed = filled.withColumn("__raw", F.to_json(F.struct(*[F.col(f"`{c}`") for c in filled.columns])))
    checked = conform(packed, T.StructType([*schema.fields, T.StructField("__raw", T.StringType())]), lengths)
    bad = F.size(REASONS) > 0
    return checked.select(
        *schema.names,
        F.when(bad, F.col(REASONS)).alias(REASONS),
        F.when(bad, F.col("__raw")).alias(RAW),
        F.when(bad, "rejected").otherwise("good").alias(OUTCOME),
    )


def write_conformed(
    df: DataFrame,
    schema: T.StructType,
    path: str,
    partition_by: Sequence[str] = (),
    lengths: Mapping[str, int] | None = None,
    defaults: Mapping[str, object] | None = None,
    **kwargs,
) -> dict[str, int]:
    """Write ``df`` as ``schema`` demands, rejected rows beside the good ones; the counts {good, rejected}.

    The rows are counted by observation on their way; there is one job.
    """
    seen = Observation()
    rows = df if OUTCOME in df.columns else conformed(df, schema, lengths, defaults)
    counted = rows.observe(seen, *[F.count_if(F.col(OUTCOME) == o).alias(o) for o in ("good", "rejected")])
    write_layer(counted, path, [OUTCOME, *partition_by], **kwargs)
    return dict(seen.get)


def read_good(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The good rows of a table."""
    return _read(spark, f"{path}/{OUTCOME}=good", schema)


def read_rejected(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rejected rows with reject_reasons and raw."""
    more = [T.StructField(REASONS, T.ArrayType(T.StringType())), T.StructField(RAW, T.StringType())]
    return _read(spark, f"{path}/{OUTCOME}=rejected", T.StructType([*schema.fields, *more]))


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)
