"""The keys that earlier runs of a job have accepted, kept by run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bitmaps import bitmap_of, marked
from ..operators.dedup import dedup_either, hashed_key
from ..operators.joins import skew_join
from ..session import ensure_checkpoint_dir
from .snapshots import list_folders, path_exists

SCHEMA = "kind int, key string, run string"


def earlier_keys(spark: SparkSession, path: str, run: str) -> DataFrame | None:
    """(kind, key) accepted by the complete runs whose id comes before this one's."""
    folders = [f for f in list_folders(spark, path, "run=") if f < f"run={run}" and path_exists(spark, f"{path}/{f}/_SUCCESS")]
    if not folders:
        return None
    return spark.read.schema(SCHEMA).option("basePath", path).parquet(*[f"{path}/{f}" for f in folders]).select("kind", "key")


def dedup_across_runs(
    df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[str | Column], path: str, run: str
) -> DataFrame:
    """``dedup_either`` over this run and all earlier ones: the rows of this run that are accepted.

    Equals going through the rows of all runs, one run after the other. ``path`` keeps the keys of accepted rows, a folder per
    run. Runs are ordered by their ids. A run reads the folders before its own and replaces its own, so a
    replay accepts the same rows and stores them once. Of the stored keys only those are moved that a bitmap of this run's
    keys (4 MB) may hold. ``df`` is read several times: pass a table or a checkpoint.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    names = [f"__key{i}" for i in range(len(keys))]
    placed = df.withColumns({n: hashed_key(k) for n, k in zip(names, keys)})
    known = earlier_keys(spark, path, run)
    if known is not None:
        own = placed.select(F.inline(F.array(*[F.struct(F.lit(i).alias("kind"), F.col(n).alias("key")) for i, n in enumerate(names)])))
        met = marked(known, "key", bitmap_of(own, "key")).filter("__hit").select("kind", "key").distinct().checkpoint()
        for i, n in enumerate(names):
            placed = skew_join(placed, met.filter(F.col("kind") == i).select(F.col("key").alias(n)), [n], "left_anti")
    accepted = dedup_either(placed.drop(*names), keys, order_by).checkpoint()
    rows = [F.struct(F.lit(i).alias("kind"), hashed_key(k).alias("key")) for i, k in enumerate(keys)]
    accepted.select(F.inline(F.array(*rows))).write.mode("overwrite").parquet(f"{path}/run={run}")
    return accepted
