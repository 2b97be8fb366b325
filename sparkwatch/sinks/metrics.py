"""Run metrics as a table: one row per run, stage and metric."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

def write_metrics(spark: SparkSession, run_id: str, stage: str, metrics: Mapping[str, object], path: str) -> None:
    """Store the metrics of one stage; a repeated run replaces its own rows."""
    rows = []
    for name, value in metrics.items():
        number = value if isinstance(value, int) else None
        rows.append(
            F.struct(
                F.lit(name).alias("metric"),
                F.lit(number).cast("long").alias("number"),
                F.lit(None if number is not None else str(value)).cast("string").alias("text"),
            )
        )
    df = spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))
    df.write.mode("overwrite").parquet(f"{path}/run_id={run_id}/stage={stage}")
