"""Projection and value repair. Each operator adds one projection and skips columns that are absent."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import is_blank
from ..functions.times import AsOf, as_timestamp


def _present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in cols if c in have]


def project(df: DataFrame, mapping: Mapping[str, str], trim: bool = True) -> DataFrame:
    """Select and rename (source -> target), trimming text; everything else is pruned."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for source in _present(df, list(mapping)):
        c = F.col(source)
        if trim and isinstance(types[source], T.StringType):
            c = F.trim(c)
        cols.append(c.alias(mapping[source]))
    return df.select(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def with_measure(df: DataFrame, name: str, value: int = 1) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def with_stamp(df: DataFrame, name: str, as_of: AsOf = None) -> DataFrame:
    return df.withColumn(name, as_timestamp(as_of))


def standardize(df: DataFrame, upper: Sequence[str] = (), trim: Sequence[str] = ()) -> DataFrame:
    """Trim and upper-case some columns, only trim others, in one projection."""
    changes = {c: F.trim(F.upper(c)) for c in _present(df, upper)}
    changes.update({c: F.trim(c) for c in _present(df, trim) if c not in changes})
    return df.withColumns(changes) if changes else df


def repair_like(df: DataFrame, col: str, repairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Replace a value by that of the first LIKE pattern it fits; other values stay."""
    if col not in df.columns or not repairs:
        return df
    fixed = [F.when(F.col(col).like(pattern), F.lit(value)) for pattern, value in repairs]
    return df.withColumn(col, F.coalesce(*fixed, F.col(col)))


def fill_from_groups(df: DataFrame, target: str, key: str, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Where ``target`` is null and ``key`` belongs to a group, set the label of the first such group."""
    if target not in df.columns or key not in df.columns or not groups:
        return df
    labels = [F.when(F.col(key).isin(list(keys)), F.lit(label)) for label, keys in groups.items()]
    return df.withColumn(target, F.coalesce(F.col(target), *labels))


def fallback(df: DataFrame, target: str, others: Sequence[str | Column], default: str, upper: bool = False) -> DataFrame:
    """Where ``target`` is null or blank take the first non-null other column, then the default.

    With ``upper`` the result is upper-cased, whichever value it came from.
    """
    if target not in df.columns:
        return df
    cols = [F.col(o) if isinstance(o, str) else o for o in others if not isinstance(o, str) or o in df.columns]
    value = F.when(is_blank(target), F.coalesce(*cols, F.lit(default))).otherwise(F.col(target))
    return df.withColumn(target, F.upper(value) if upper else value)
