"""Joins against dimensions and key sets that stay safe at any size and under any key skew.

The right-hand side holds at most one row per key. It is broadcast only when its size is known to be
small: either the optimizer's estimate is under Spark's own threshold, or a counting job has measured
it. Beyond that the join shuffles, and hot left-hand keys are taken out of the shuffle: a key that
holds more than ``share`` of all rows can occur at most ``1 / share`` times, so the hot part of the
right-hand side has a proven bound and can be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import normalize_name
from ..session import ensure_checkpoint_dir

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 0.001
# below this many left-hand rows even a single hot key is a small task
SKEW_MIN_ROWS = 5_000_000
HOWS = ("inner", "left", "left_semi", "left_anti")


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan (what Spark's own broadcast choice uses)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def auto_broadcast_bytes(df: DataFrame) -> int:
    raw = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if raw.startswith("-"):  # switched off
        return -1
    return int(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(raw))


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: text by its length, 16 for anything else (arrays and structs by their JSON text)."""
    total = F.lit(0).cast("long")
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = F.octet_length(c)
        elif isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            size = F.octet_length(F.to_json(F.struct(c)))
        else:
            size = F.lit(16)
        total = total + F.coalesce(size, F.lit(0)).cast("long")
    return total


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of ``df`` by one aggregation."""
    return tuple(df.agg(F.count(F.lit(1)), F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first())


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measured, not guessed."""
    n, size = measured_size(df)
    return n <= max_rows and size <= max_bytes


def hot_keys(df: DataFrame, on: Sequence[str], share: float = HOT_SHARE, rows: int | None = None) -> DataFrame:
    """Keys holding more than ``share`` of all rows; never more than ``1 / share`` of them."""
    on = list(on)
    limit = (df.count() if rows is None else rows) * share
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
    return counts.filter(F.col("__n") > F.lit(limit)).select(*on)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    share: float = HOT_SHARE,
    min_rows: int = SKEW_MIN_ROWS,
) -> DataFrame:
    """Shuffle join with the hot left-hand keys split off and joined by broadcast instead.

    ``right`` must hold at most one row per key. Null keys match nothing. Below ``min_rows`` rows on the
    left nothing is split. The left side is read up to three times, so pass a table or a checkpoint.
    """
    if how not in HOWS:
        raise ValueError(f"how must be one of {HOWS}")
    on = list(on)
    rows = left.count()
    if rows < min_rows:
        return left.join(right, on, how)
    ensure_checkpoint_dir(left.sparkSession)
    hot = hot_keys(left, on, share, rows).na.drop(subset=on).withColumn("__hot", F.lit(True)).checkpoint()
    keyless = reduce(or_, [F.col(c).isNull() for c in on])
    if hot.isEmpty():
        cold = left
        parts = []
    else:
        marked = left.join(F.broadcast(hot), on, "left")
        cold = marked.filter(F.col("__hot").isNull()).drop("__hot")
        hot_left = marked.filter(F.col("__hot").isNotNull()).drop("__hot")
        hot_right = right.join(F.broadcast(hot.drop("__hot")), on, "left_semi")
        parts = [hot_left.join(F.broadcast(hot_right), on, how)]
    parts.insert(0, cold.filter(~keyless).join(right, on, how))
    # rows without a key cannot match; keep them out of the shuffle, where they would all meet in one task
    if how in ("left", "left_anti"):
        parts.append(cold.filter(keyless))
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def join_dim(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    derived: bool = False,
    costly: bool = False,
) -> DataFrame:
    """Join a dimension with one row per key: broadcast when its size is proven small, else split by skew.

    ``derived`` says that the dimension is the outcome of a query, not a stored table: it is then written to
    the checkpoint folder once, instead of being worked out again for the measurement and for the join.
    ``costly`` says the same of the fact side, which the split join reads more than once.
    """
    on = [on] if isinstance(on, str) else list(on)
    if estimated_bytes(dim) <= auto_broadcast_bytes(dim):
        return fact.join(dim, on, how)
    if derived:
        ensure_checkpoint_dir(dim.sparkSession)
        dim = dim.checkpoint()
    if fits_broadcast(dim, max_rows, max_bytes):
        return fact.join(F.broadcast(dim), on, how)
    if fact.isStreaming:
        # a stream cannot be counted beforehand; AQE does not apply, the batch path is foreachBatch
        return fact.join(dim, on, how)
    if costly:
        ensure_checkpoint_dir(fact.sparkSession)
        fact = fact.checkpoint()
    return skew_join(fact, dim, on, how)


def lookup_key(
    df: DataFrame,
    name: str | Column,
    dim: DataFrame,
    dim_name: str,
    dim_key: str,
    out: str,
    how: str = "left",
    fold: bool = False,
) -> DataFrame:
    """Resolve a name to a key by its normalised form; a miss gives a null key (or no row with ``inner``).

    Dimension names that fall together once normalised keep the greatest (name, key).
    """
    lookup = (
        dim.select(
            normalize_name(dim_name, fold).alias("__norm"),
            F.struct(F.col(dim_name).alias("n"), F.col(dim_key).alias("k")).alias("__row"),
        )
        .groupBy("__norm")
        .agg(F.max("__row")["k"].alias(out))
    )
    # a missing name is the empty string on both sides, as in the dictionary lookup this stands for
    probe = df.withColumn("__norm", normalize_name(name, fold))
    return join_dim(probe, lookup, "__norm", how, derived=True, costly=True).drop("__norm")
