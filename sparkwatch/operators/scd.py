"""Type 2 slowly changing dimensions as pure DataFrame operators: (dimension, load) -> next snapshot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import AsOf, today
from .dedup import dedup

START, END, CURRENT = "start_date", "end_date", "is_current"
MODES = ("always", "on_change")


def open_versions(df: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Start a version today with no end, marked current."""
    return df.withColumns({START: today(as_of), END: F.lit(None).cast("date"), CURRENT: F.lit(1)})


def current(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col(CURRENT) == 1)


def _is_current() -> Column:
    return F.coalesce(F.col(CURRENT) == 1, F.lit(False))


def expire(dim: DataFrame, incoming: DataFrame, key: str | Sequence[str], as_of: AsOf = None) -> DataFrame:
    """Close the current versions whose key is in the load, changed or not; history passes by untouched."""
    keys = [key] if isinstance(key, str) else list(key)
    hits = incoming.select(*keys).na.drop().distinct().withColumn("__hit", F.lit(True))
    closed = dim.filter(_is_current()).join(hits, keys, "left")
    hit = F.col("__hit").isNotNull()
    closed = closed.withColumns(
        {CURRENT: F.when(hit, F.lit(0)).otherwise(F.col(CURRENT)), END: F.when(hit, today(as_of)).otherwise(F.col(END))}
    )
    return closed.select(*dim.columns).unionByName(dim.filter(~_is_current()))


def scd2_merge(
    dim: DataFrame,
    incoming: DataFrame,
    key: str | Sequence[str],
    tracked: Sequence[str],
    as_of: AsOf = None,
    mode: str = "on_change",
) -> DataFrame:
    """The dimension after a load: expire what the load replaces and open its new versions.

    ``always`` opens a new version for every key in the load; ``on_change`` only where the key is new or a
    ``tracked`` column differs (nulls compare as values). One full join of the current slice, which has one
    row per key, against the deduplicated load; history is appended without being joined.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    keys = [key] if isinstance(key, str) else list(key)
    cols = dim.columns
    load = dedup(incoming.na.drop(subset=keys), keys)
    new_rows = open_versions(load, as_of)
    missing = [c for c in cols if c not in new_rows.columns]
    new_rows = new_rows.withColumns({c: F.lit(None).cast(dim.schema[c].dataType) for c in missing})

    types = {f.name: f.dataType for f in dim.schema.fields}

    def packed(df: DataFrame, name: str) -> DataFrame:
        fields = [F.col(c).cast(types[c]).alias(c) for c in cols]
        return df.select(*[F.col(k).alias(f"__{k}") for k in keys], F.struct(*fields).alias(name))

    old = packed(dim.filter(_is_current()), "o")
    new = packed(new_rows, "n")
    both = old.join(new, [f"__{k}" for k in keys], "full")

    o, n = F.col("o"), F.col("n")
    differs = reduce(or_, [~o[c].eqNullSafe(n[c]) for c in tracked], F.lit(False))
    replaced = o.isNotNull() & n.isNotNull() & (F.lit(True) if mode == "always" else differs)
    opened = n.isNotNull() & (o.isNull() | replaced)
    closed = o.withField(CURRENT, F.lit(0).cast(types[CURRENT])).withField(END, today(as_of).cast(types[END]))
    versions = F.array(F.when(replaced, closed).otherwise(o), F.when(opened, n))
    merged = both.select(F.inline(F.filter(versions, lambda v: v.isNotNull())))
    return merged.select(*cols).unionByName(dim.filter(~_is_current()))
