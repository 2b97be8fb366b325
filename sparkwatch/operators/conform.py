"""Column defaults and schema conformance ahead of a table write."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REASONS = "reject_reasons"


def apply_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill nulls with a value or expression, adding the column where it is missing."""
    changes = {}
    for name, value in defaults.items():
        expr = value if isinstance(value, Column) else F.lit(value)
        changes[name] = F.coalesce(F.col(name), expr) if name in df.columns else expr
    return df.withColumns(changes)


def kept_by_cast_back(source: T.DataType, target: T.DataType) -> bool:
    """Whether casting back tells that a value was changed. Text is left out: many texts stand for one value."""
    return not isinstance(source, (T.StringType, T.NullType)) and source != target


def conform(df: DataFrame, schema: T.StructType, lengths: Mapping[str, int] | None = None) -> DataFrame:
    """Cast to ``schema`` without failing, and list in ``reject_reasons`` what does not fit.

    A row does not fit if a value is lost or changed by the cast (cast back, it must be the same), a non-nullable column is null, or a fixed-length text
    column (``lengths``) has another length. Missing columns are added as nulls. The list is empty for good
    rows: filter on it with ``rejects`` or keep the rest.
    """
    lengths = lengths or {}
    have = set(df.columns)
    source = {f.name: F.col(f.name) if f.name in have else F.lit(None) for f in schema.fields}
    typed = {f.name: source[f.name].try_cast(f.dataType) for f in schema.fields}
    checks: list[Column] = []
    for f in schema.fields:
        lost = source[f.name].isNotNull() & typed[f.name].isNull()
        if f.name in have and kept_by_cast_back(df.schema[f.name].dataType, f.dataType):
            lost = lost | ~typed[f.name].try_cast(df.schema[f.name].dataType).eqNullSafe(source[f.name])
        checks.append(F.when(lost, F.lit(f"{f.name}: not a {f.dataType.simpleString()}")))
        if not f.nullable:
            checks.append(F.when(source[f.name].isNull(), F.lit(f"{f.name}: missing")))
        if f.name in lengths:
            wrong = F.char_length(typed[f.name]) != lengths[f.name]
            checks.append(F.when(wrong, F.lit(f"{f.name}: length is not {lengths[f.name]}")))
    return df.select(
        *[typed[f.name].alias(f.name) for f in schema.fields],
        F.array_compact(F.array(*checks)).alias(REASONS),
    )


def rejects(conformed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a conformed frame into (good rows without the reasons, rejected rows with them)."""
    ok = F.size(REASONS) == 0
    return conformed.filter(ok).drop(REASONS), conformed.filter(~ok)
