from __future__ import annotations


def rows(df, *order):
    """Rows as tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
