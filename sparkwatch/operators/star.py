"""Star schema builders: dimensions with hash keys, and the fact table that points at them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import hash_key
from ..functions.times import AsOf
from .dedup import dedup
from .joins import join_dim
from .quality import require
from .standardize import fallback, with_stamp


@dataclass(frozen=True)
class Fallback:
    """Value for a null or blank column: the first non-null other column, else the default."""

    target: str
    others: tuple[str | Column, ...] = ()
    default: str = "UNKNOWN"
    upper: bool = False


@dataclass(frozen=True)
class DimSpec:
    """One dimension: its natural key, attributes, surrogate key and repairs."""

    natural_key: str
    key: str
    attributes: tuple[str, ...]
    normalize: bool = False
    order_by: tuple[str | Column, ...] = ()
    fallbacks: tuple[Fallback, ...] = ()

    def key_expr(self) -> Column:
        return hash_key(self.natural_key, normalize=self.normalize)


@dataclass(frozen=True)
class FactSpec:
    """The fact: columns taken from the records, the hashed id over keys and columns, and the measure."""

    key: str
    columns: Mapping[str, str]
    id_columns: tuple[str, ...]
    measure: str
    stamp: str = "ingestion_timestamp"
    order_by: tuple[str, ...] = field(default=())


def build_dim(df: DataFrame, spec: DimSpec) -> DataFrame:
    """Prune, take one declared row per natural key, drop null keys, add the hash key and fallbacks.

    A dimension has few distinct rows: they are collected by hashing first, so that only these are sorted.
    """
    dim = require(df.select(spec.natural_key, *spec.attributes), [spec.natural_key]).distinct()
    dim = dedup(dim, [spec.natural_key], spec.order_by).withColumn(spec.key, spec.key_expr())
    for f in spec.fallbacks:
        dim = fallback(dim, f.target, f.others, f.default, f.upper)
    return dim.select(spec.key, spec.natural_key, *spec.attributes)


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, DimSpec]]) -> DataFrame:
    """Inner join of each dimension on its natural key, bringing in only the surrogate key."""
    for dim, spec in dims:
        fact = join_dim(fact, dim.select(spec.natural_key, spec.key), [spec.natural_key], "inner", derived=True)
    return fact


def with_keys(fact: DataFrame, specs: Sequence[DimSpec]) -> DataFrame:
    """The same result as ``star_join`` for dimensions built from these very records, without a join.

    Such a dimension holds every non-null natural key exactly once and its surrogate key is a function of
    the natural key, so the inner join only drops null keys.
    """
    fact = require(fact, [s.natural_key for s in specs])
    return fact.withColumns({s.key: s.key_expr() for s in specs})


def build_fact(
    df: DataFrame,
    dims: Sequence[tuple[DataFrame | None, DimSpec]],
    spec: FactSpec,
    as_of: AsOf = None,
) -> DataFrame:
    """Resolve the keys, hash the id, stamp, and keep one row per id.

    Give a dimension as None when it was built from ``df``: its key is then computed instead of joined.
    """
    keyed = with_keys(df, [s for d, s in dims if d is None])
    keyed = star_join(keyed, [(d, s) for d, s in dims if d is not None])
    fact = keyed.select(
        *[s.key for _, s in dims],
        *[F.col(source).alias(target) for source, target in spec.columns.items()],
        F.lit(1).alias(spec.measure),
    ).withColumn(spec.key, hash_key(list(spec.id_columns)))
    fact = with_stamp(dedup(fact, [spec.key], spec.order_by), spec.stamp, as_of)
    return fact.select(spec.key, *[c for c in fact.columns if c != spec.key])
