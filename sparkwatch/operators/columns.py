"""Helpers that shape how columns are computed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add expensive columns behind a one-row generator.

    The optimizer neither copies them into later expressions nor pushes a filter on them below the place
    where they are computed, so each is evaluated once per row.
    """
    fields = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(fields)))
