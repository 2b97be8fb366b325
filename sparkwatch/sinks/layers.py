"""Table writers and physical layout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.dedup import dedup
from ..operators.joins import measured_size

FILE_BYTES = 512 * 1024 * 1024  # of rows before compression
MAX_PRUNED = 1_000  # partition values of a load that are put into a scan's filter


def with_partition_col(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Add a derived layout column, such as ``year(start_date)`` or ``year_month(published_at)``."""
    return df.withColumn(name, expr)


def cluster_by(
    df: DataFrame, cols: Sequence[str], spread: Sequence[str] = (), partitions: int | None = None
) -> DataFrame:
    """Range-partition and sort by ``cols``, which tightens the min/max statistics of the files.

    Ranges are cut on ``cols`` and then ``spread``: name a unique column there so that one value of ``cols``
    holding many rows is divided among several files.
    """
    ranged = [*cols, *spread]
    parts = df.repartitionByRange(partitions, *ranged) if partitions else df.repartitionByRange(*ranged)
    return parts.sortWithinPartitions(*ranged)


def clustered_files(df: DataFrame, partition: Sequence[str], cols: Sequence[str], file_bytes: int = FILE_BYTES) -> DataFrame:
    """Rows in ranges of (partition, cols), sorted, as many ranges as the measured size fills files.

    A partition value lies in few files, each with a narrow range of ``cols``; one that holds a large part of all rows is
    cut into several ranges. ``df`` is read twice: pass a table, a checkpoint or a persisted frame.
    """
    files = max(1, -(-measured_size(df)[1] // file_bytes))
    return cluster_by(df, [*partition, *cols], partitions=files)


def bloom_options(cols: Sequence[str], expected_distinct: int | None = None) -> dict[str, str]:
    """Writer options that store a Bloom filter per row group for the given columns."""
    opts = {f"parquet.bloom.filter.enabled#{c}": "true" for c in cols}
    if expected_distinct:
        opts.update({f"parquet.bloom.filter.expected.ndv#{c}": str(expected_distinct) for c in cols})
    return opts


def write_layer(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    dynamic: bool = False,
    rebalance: bool = True,
    options: Mapping[str, str] | None = None,
) -> None:
    """Write a Parquet layer.

    ``dynamic`` replaces only the partitions present in ``df``. ``rebalance`` gathers the rows of a partition
    value into few files, while a value that holds a large part of all rows is still split over many tasks; it
    takes effect only under adaptive execution, which does that splitting.
    """
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    if rebalance and partition_by and adaptive:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).options(**(options or {}))
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_table(
    df: DataFrame,
    table: str | None = None,
    path: str | None = None,
    jdbc: Mapping[str, str] | None = None,
    batch_size: int = 5000,
    partition_by: Sequence[str] = (),
) -> int:
    """Append to a catalog table, a Parquet path, or over JDBC in batches of ``batch_size`` rows; the rows appended.

    The executors write and the count is observed on the way; nothing passes through the driver.
    """
    seen = Observation()
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if jdbc is not None:
        options = {"batchsize": str(batch_size), **({"dbtable": table} if table else {}), **jdbc}
        df.write.format("jdbc").mode("append").options(**options).save()
    elif path is not None:
        df.write.mode("append").partitionBy(*partition_by).parquet(path)
    elif table is not None:
        df.write.mode("append").partitionBy(*partition_by).format("parquet").saveAsTable(table)
    else:
        raise ValueError("give a table, a path or JDBC options")
    return seen.get["rows"]


def insert_new(df: DataFrame, existing: DataFrame, key: str, partition: str | None = None) -> DataFrame:
    """The rows whose key is not stored yet, one per key, for an append that can be repeated.

    Only the key is read from the stored table. Where ``partition`` is a function of the key, its values in the
    load (if they are few) restrict the stored side, so that the scan skips all other partitions. Rows without a
    key are always new and are not joined.
    """
    keyed = dedup(df.filter(F.col(key).isNotNull()), [key], [])
    on = [key]
    if partition is not None:
        on = [partition, key]
        values = [r[0] for r in df.select(partition).distinct().limit(MAX_PRUNED + 1).collect()]
        if len(values) <= MAX_PRUNED:
            existing = existing.filter(F.col(partition).isin([v for v in values if v is not None]))
    fresh = keyed.join(existing.select(*on), on, "left_anti").select(*df.columns)
    return fresh.unionByName(df.filter(F.col(key).isNull()))
