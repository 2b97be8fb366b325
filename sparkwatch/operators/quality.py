"""Strict quality rules and a single-pass account of what they drop."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import is_blank
from .columns import computed_once
from .dedup import total_order

FUNNEL_STEPS = ("rows_in", "null", "blank", "duplicate", "bound", "final", "rows_out")


def _strings(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    wanted = set(df.columns if cols is None else cols)
    return [f.name for f in df.schema.fields if f.name in wanted and isinstance(f.dataType, T.StringType)]


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def has_null(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    return _any([F.col(c).isNull() for c in (df.columns if cols is None else cols)])


def has_blank(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """True if a text column is blank (a null counts as blank here); numbers and dates cannot be."""
    return _any([is_blank(c) for c in _strings(df, cols)])


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of the given columns."""
    return df.na.drop(subset=list(cols))


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.na.drop()


def drop_any_blank(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows where a column is null or, for text, only spaces: one conjunct, null tests first.

    All columns are tested unless ``cols`` names some.
    """
    cols = df.columns if cols is None else [c for c in cols if c in df.columns]
    tests = [F.col(c).isNotNull() for c in cols] + [F.trim(F.col(c)) != "" for c in _strings(df, cols)]
    return df.filter(reduce(and_, tests)) if tests else df


def min_bound(df: DataFrame, col: str, value) -> DataFrame:
    """Keep rows with ``col >= value``; no-op if the column is absent."""
    return df.filter(F.col(col) >= F.lit(value)) if col in df.columns else df


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, n_bad): nulls and blanks per column, counted in one aggregation."""
    cols = list(df.columns if cols is None else cols)
    text = set(_strings(df, cols))
    wide = df.agg(*[F.count_if(is_blank(c) if c in text else F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("n_bad")) for i, c in enumerate(cols)])
    return wide.select(F.inline(rows))


def assert_or_remove(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that hold the no-null, no-blank invariant, and the profile of those that break it."""
    return drop_any_blank(df), null_profile(df)


def hold_invariant(df: DataFrame, cols: Sequence[str] | None = None) -> tuple[DataFrame, Observation]:
    """The rows without a null or blank, and an observation of those removed: {rows, column: how many broke it there}.

    The observation is filled by the job that writes the rows; nothing is read for it.
    """
    cols = list(df.columns if cols is None else cols)
    text = set(_strings(df, cols))
    # the tests stay apart from those of earlier rules, which the optimizer would combine with them at length
    tests = F.array(*[F.when(is_blank(c) if c in text else F.col(c).isNull(), F.lit(c)) for c in cols])
    tested = computed_once(df, {"__broken": F.array_compact(tests)})
    broken = F.size("__broken") > 0
    seen = Observation()
    counts = [F.count_if(F.array_contains("__broken", c)).alias(c) for c in cols]
    return tested.observe(seen, F.count_if(broken).alias("rows"), *counts).filter(~broken).drop("__broken"), seen


def quality_funnel(
    df: DataFrame,
    key: Sequence[str],
    bound: tuple[str, object],
    order_by: Sequence[str | Column] | None = None,
    final_bad: Column | None = None,
) -> DataFrame:
    """(step, n): rows in, dropped by null, blank, duplicate key, lower bound and final check, rows out.

    Every row is charged to the first rule it breaks. One scan and one shuffle: rows are pre-aggregated per
    key before they move. The bound is tested on the row that wins its key, by default the one with the
    greatest bound value, else the first by ``order_by`` (ascending). ``final_bad`` tells which of the winners
    a check after standardisation removes.
    """
    bound_col, bound_value = bound
    keys = [f"__key{i}" for i in range(len(key))]
    # one projection tests the columns, the next combines the outcomes: each test is written once
    tested = df.withColumns(
        {
            "__null": has_null(df),
            "__blank": has_blank(df),
            "__passes": F.coalesce(F.col(bound_col) >= F.lit(bound_value), F.lit(False)),
        }
    )
    ok = ~F.col("__null") & ~F.col("__blank")
    flags = [
        *[F.when(ok, F.col(k)).alias(name) for name, k in zip(keys, key)],
        F.col("__null"),
        (~F.col("__null") & F.col("__blank")).alias("__blank"),
        ok.alias("__ok"),
    ]
    counts = [
        F.count(F.lit(1)).alias("n"),
        F.count_if("__null").alias("n_null"),
        F.count_if("__blank").alias("n_blank"),
        F.count_if("__ok").alias("n_ok"),
    ]
    if order_by is None and final_bad is None:
        # the greatest bound value passes exactly if any value of the key passes
        rows = tested.select(*flags, F.when(ok, F.col("__passes")).alias("__passes"))
        per_key = rows.groupBy(*keys).agg(*counts, F.max("__passes").alias("wins"), F.lit(False).alias("bad"))
    else:
        order = total_order(df, [F.negative(F.col(bound_col))] if order_by is None else order_by)
        bad = F.lit(False) if final_bad is None else F.coalesce(final_bad, F.lit(False))
        row = F.struct(F.struct(*order).alias("o"), F.col("__passes").alias("p"), bad.alias("b"))
        rows = tested.select(*flags, F.when(ok, row).alias("__row"))
        per_key = rows.groupBy(*keys).agg(*counts, F.min("__row").alias("w"))
        per_key = per_key.withColumns({"wins": F.col("w.p"), "bad": F.col("w.b")})
    winner = F.col("n_ok") > 0
    totals = {
        "rows_in": F.sum("n"),
        "null": F.sum("n_null"),
        "blank": F.sum("n_blank"),
        "duplicate": F.sum(F.when(winner, F.col("n_ok") - 1)),
        "bound": F.count_if(winner & ~F.col("wins")),
        "final": F.count_if(winner & F.col("wins") & F.col("bad")),
        "rows_out": F.count_if(winner & F.col("wins") & ~F.col("bad")),
    }
    wide = per_key.agg(*[F.coalesce(t, F.lit(0)).cast("long").alias(name) for name, t in totals.items()])
    steps = F.array(*[F.struct(F.lit(s).alias("step"), F.col(s).alias("n")) for s in FUNNEL_STEPS])
    return wide.select(F.inline(steps))
