from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sparkwatch.session import shared_dir
from sparkwatch.sources import read_layer

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that gives the same rows."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql:
            ORACLES[key] = sql
        return fn

    return register


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. Its footer is read for the schema only once per process."""
    path = f"{sf_dir}/{name}.parquet"
    df = read_layer(spark, path, _SCHEMAS.get(path))
    _SCHEMAS.setdefault(path, df.schema)
    return df


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder in the shared scratch space of the cluster."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
