"""Deterministic surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(cols: str | Column | Sequence[str | Column], sep: str = "_", normalize: bool = False) -> Column:
    """md5 over one column, or over several joined by ``sep`` (nulls are skipped, numbers cast).

    ``normalize`` lower-cases and trims each part first, so the key survives case and padding changes.
    """
    parts = [cols] if isinstance(cols, (str, Column)) else list(cols)
    exprs = [F.col(p) if isinstance(p, str) else p for p in parts]
    if normalize:
        exprs = [F.lower(F.trim(e.cast("string"))) for e in exprs]
    if len(exprs) == 1:
        return F.md5(exprs[0].cast("string"))
    return F.md5(F.concat_ws(sep, *[e.cast("string") for e in exprs]))
