"""Deduplication with a declared winner.

``row_number() = 1`` is planned as a group limit: every map task first cuts each key down to its own
best row, so a key that holds a large part of all rows reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .joins import HOT_SHARE, SKEW_MIN_ROWS, skew_join


def total_order(df: DataFrame, first: Sequence[str | Column] = (), skip: Sequence[str] = ()) -> list[Column]:
    """``first``, then every other orderable column ascending, so that only equal rows can tie."""
    named = {f for f in first if isinstance(f, str)} | set(skip)
    rest = [
        F.col(f"`{f.name}`")
        for f in df.schema.fields
        if f.name not in named and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    return [F.col(f) if isinstance(f, str) else f for f in first] + rest


def _first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    ranked = df.withColumn("__rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("__rn") == 1).drop("__rn")


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = ()) -> DataFrame:
    """One row per key (nulls equal): the first by ``order_by``, ties broken by all other columns."""
    keys = list(keys)
    return _first_per_key(df, keys, total_order(df, order_by, skip=keys))


def keep_latest(
    df: DataFrame, key: Sequence[str], version: str, tiebreak: Sequence[str | Column] = ()
) -> DataFrame:
    """One row per key: the greatest ``version``, ties broken by ``tiebreak`` and then all other columns."""
    return dedup(df, key, [F.col(version).desc_nulls_last(), *tiebreak])


def distinct_names(df: DataFrame, col: str) -> DataFrame:
    """The distinct non-null values of a column, kept distributed."""
    return df.select(col).na.drop().distinct()


def hashed_key(key: str | Column) -> Column:
    """Hashing folds long keys (urls, titles) to a fixed width and gives null a value of its own."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.md5(key.cast("string")), F.lit("null"))


def dedup_either(
    df: DataFrame,
    keys: Sequence[str | Column],
    order_by: Sequence[str | Column],
    hot_share: float = HOT_SHARE,
    skew_min_rows: int = SKEW_MIN_ROWS,
) -> DataFrame:
    """Go through the rows in order and skip a row if any of its keys was taken by an accepted row.

    Skipped rows take no keys, so this is not the same as deduplicating by one key after the other.
    ``order_by`` is ascending; a hash of the whole row breaks ties. Null keys are values like any other.

    Runs in rounds over a slim frame of hashed keys and positions: a row that comes first in all of its key
    groups is accepted, rows sharing a key with an accepted row leave, the rest goes on. Every round accepts
    at least one row, so the loop ends; each round writes its state to the checkpoint folder.
    """
    ensure_checkpoint_dir(df.sparkSession)
    names = [f"__k{i}" for i in range(len(keys))]
    hashed = {n: hashed_key(k) for n, k in zip(names, keys)}
    position = [F.col(o) if isinstance(o, str) else o for o in order_by]
    placed = df.withColumns({**hashed, "__ord": F.struct(*position, F.xxhash64(*df.columns).alias("__tie"))})
    # of rows that agree in all keys only the first can be accepted
    left = placed.groupBy(*names).agg(F.min("__ord").alias("__ord")).checkpoint()
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        # the first row of every group of each key; map tasks cut a hot group down before it moves
        firsts = [
            left.groupBy(n).agg(F.min(F.struct("__ord", *names)).alias("r")).select("r.*") for n in names
        ]
        # rows that come first everywhere; a row is in each of these sets once, so the join has no hot key
        winners = reduce(lambda a, b: a.join(b, [*names, "__ord"], "left_semi"), firsts).checkpoint()
        rounds.append(winners)
        for n in names:
            left = skew_join(left, winners.select(n), [n], "left_anti", hot_share, skew_min_rows)
        left = left.checkpoint()
    # copies of one row share keys and position: they are cut to one before the rows move
    whole = dedup(placed, [*names, "__ord"])
    accepted = reduce(DataFrame.unionByName, rounds) if rounds else left
    return whole.join(accepted, [*names, "__ord"], "left_semi").select(*df.columns)
