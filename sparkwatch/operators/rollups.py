"""Pre-aggregated rollups and the serving queries on top of the star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import dedup
from .joins import join_dim
from .scd import CURRENT, START, current


def build_rollup(df: DataFrame, dims: Sequence[str], aggs: Mapping[str, Column] | None = None) -> DataFrame:
    """Grouped additive measures; by default a row count named ``alert_count``."""
    aggs = aggs or {"alert_count": F.count(F.lit(1))}
    return df.groupBy(*dims).agg(*[expr.alias(name) for name, expr in aggs.items()])


def merge_rollup(old: DataFrame, delta: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Add the rollup of new rows to a stored one; equals the rollup of all rows for additive measures."""
    measures = [c for c in old.columns if c not in set(dims)]
    union = old.unionByName(delta.select(*old.columns))
    return union.groupBy(*dims).agg(*[F.sum(m).cast(old.schema[m].dataType).alias(m) for m in measures])


def rollup_delta(old: DataFrame | None, new: DataFrame, dims: Sequence[str], measure: str = "alert_count") -> DataFrame:
    """By how much the rollup changes when the rows ``old`` are replaced by ``new``: new rows count 1, replaced ones -1."""
    signed = new.select(*dims, F.lit(1).cast("long").alias(measure))
    if old is not None:
        signed = signed.unionByName(old.select(*dims, F.lit(-1).cast("long").alias(measure)))
    return signed.groupBy(*dims).agg(F.sum(measure).alias(measure)).filter(F.col(measure) != 0)


def one_per_key(dim: DataFrame, key: str) -> DataFrame:
    """The row that stands for each key: of the current versions, the one of the last load."""
    rows = current(dim) if CURRENT in dim.columns else dim
    return dedup(rows, [key], [F.desc(c) for c in ("load_seq", START) if c in dim.columns])


def trend_by_year(
    fact: DataFrame, dims: Sequence[tuple[DataFrame, str]], by: Sequence[str], year: str, measure: str
) -> DataFrame:
    """Yearly totals by dimension attributes.

    The fact is aggregated per key first, so only (year, key) groups meet the dimensions. Of a dimension with
    history each key counts once, by its current version.
    """
    keys = [k for _, k in dims]
    small = fact.groupBy(year, *keys).agg(F.sum(measure).alias("__m"))
    for dim, key in dims:
        small = join_dim(small, one_per_key(dim, key).select(key, *[c for c in by if c in dim.columns]), [key], derived=True)
    return small.groupBy(year, *by).agg(F.sum("__m").alias(measure))


def geo_totals(fact: DataFrame, location: DataFrame, key: str, by: Sequence[str], measure: str) -> DataFrame:
    small = fact.groupBy(key).agg(F.sum(measure).alias("__m"))
    return join_dim(small, one_per_key(location, key).select(key, *by), [key], derived=True).groupBy(*by).agg(F.sum("__m").alias(measure))


def alerts_against_history(
    alerts: DataFrame, fact: DataFrame, keys: Sequence[str], measure: str = "outbreak_count"
) -> DataFrame:
    """Live alert counts beside historical totals per key, zero where one side has none."""
    live = alerts.groupBy(*keys).agg(F.count(F.lit(1)).alias("alert_count"))
    past = fact.groupBy(*keys).agg(F.sum(measure).alias("history_count"))
    zero = F.lit(0).cast("long")
    return live.join(past, list(keys), "full").select(
        *keys,
        F.coalesce("alert_count", zero).alias("alert_count"),
        F.coalesce(F.col("history_count").cast("long"), zero).alias("history_count"),
    )
