"""The alert stream: events in, resolved alerts out, safe under replay."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.times import AsOf, year_month
from ..operators.alerts import OUTCOMES, EntityRules, outcome_stats, resolve_events, to_alert
from ..operators.dedup import keep_latest
from ..operators.joins import measured_size
from ..operators.rollups import build_rollup, merge_rollup, rollup_delta
from ..operators.conform import REASONS
from ..sinks.conformed import OUTCOME, RAW, conformed, write_conformed
from ..sinks.layers import bloom_options, clustered_files
from ..sinks.snapshots import (
    delete_path,
    expire_snapshots,
    list_folders,
    next_version,
    path_exists,
    read_snapshot,
    snapshot_note,
    snapshot_parts,
    snapshot_path,
    write_snapshot,
)
from .identity import stream_name
from ..sources.events import EVENT_SCHEMA, EventSource, decode_json, read_event_stream

# The sort key under which alerts replace each other, and the month layout column.
ALERT_KEY = ("source", "location_key", "published_at", "disease_key")
ALERT_MONTH = "published_month"
TASK_BYTES = 128 * 1024 * 1024  # of alerts before compression that one task writes


ALERT_SCHEMA = T.StructType(
    [
        T.StructField("alert_id", T.StringType()),
        T.StructField("disease_key", T.StringType()),
        T.StructField("location_key", T.StringType()),
        T.StructField("published_at", T.TimestampType()),
        T.StructField("ingestion_time", T.TimestampType()),
        T.StructField("title", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("published_at_imputed", T.BooleanType()),
        T.StructField("stream", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField(ALERT_MONTH, T.IntegerType()),
    ]
)
# What an alert must have, and the length of its id; other alerts are kept apart as rejected.
ALERT_REQUIRED = ("alert_id", "disease_key", "location_key", "published_at", "ingestion_time")
ALERT_LENGTHS = {"alert_id": 32}
ALERT_ROWS = T.StructType(
    [T.StructField(f.name, f.dataType, f.name not in ALERT_REQUIRED) for f in ALERT_SCHEMA.fields if f.name not in ("stream", "batch_id")]
)
ROLLUP_DIMS = ("location_key", "disease_key")
ROLLUP_SCHEMA = T.StructType(
    [
        T.StructField("location_key", T.StringType()),
        T.StructField("disease_key", T.StringType()),
        T.StructField("alert_count", T.LongType()),
        T.StructField("stream", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
STATS_SCHEMA = T.StructType(
    [
        *(T.StructField(n, T.LongType()) for n in ("total", *OUTCOMES)),
        T.StructField("stream", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def dedup_stream(df: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """Drop repeats across micro-batches that arrive within ``delay``; state older than that is let go."""
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


@dataclass(frozen=True)
class AlertSink:
    """foreachBatch writer for alerts.

    The dimension loaders run for every micro-batch, so new keys are seen without a restart. A batch writes
    the folder of its stream and ``batch_id`` and replaces it when replayed; batch ids start over with a new
    checkpoint, but so does the stream's identity, and nothing of another stream is touched. Alert ids depend on
    content only, so a replay brings no new ones. Outcomes, alerts and their rollup are reads of one persisted frame. The rollup is kept
    as one part per batch, which a replay replaces as well; ``read_rollup`` adds the parts up.
    """

    path: str
    stats_path: str
    diseases: Callable[[], DataFrame]
    locations: Callable[[], DataFrame]
    disease_rules: EntityRules
    country_rules: EntityRules
    as_of: AsOf = None
    fold: bool = False
    rows_per_file: int = 1_000_000
    file_bytes: int = TASK_BYTES
    rollup_path: str | None = None
    stream: str | None = None  # by default the identity that Spark keeps in the checkpoint

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        folder = f"stream={stream_name(batch, self.stream)}/batch_id={batch_id}"
        resolved = resolve_events(
            batch, self.diseases(), self.locations(), self.disease_rules, self.country_rules, fold=self.fold
        ).persist()
        try:
            stats = outcome_stats(resolved).first()
            one = batch.sparkSession.range(0, 1, 1, 1)
            row = one.select(*[F.lit(stats[n]).cast("long").alias(n) for n in ("total", *OUTCOMES)])
            row.write.mode("overwrite").parquet(f"{self.stats_path}/{folder}")
            alerts = to_alert(resolved.filter(F.col("outcome") == "inserted"), self.as_of)
            alerts = conformed(alerts.withColumn(ALERT_MONTH, year_month("published_at")), ALERT_ROWS, ALERT_LENGTHS)
            # micro-batches run without adaptive execution, and most of their rows are of one month: rows are
            # spread evenly over as many tasks as the batch fills files, by rows or by bytes
            files = max(1, -(-stats["inserted"] // self.rows_per_file), -(-measured_size(alerts)[1] // self.file_bytes))
            spread = alerts.repartition(files, "alert_id")
            write_conformed(spread, ALERT_ROWS, f"{self.path}/{folder}", [ALERT_MONTH], rebalance=False)
            if self.rollup_path:
                part = build_rollup(alerts.filter(F.col(OUTCOME) == "good"), ROLLUP_DIMS).coalesce(files)
                part.write.mode("overwrite").parquet(f"{self.rollup_path}/{folder}")
        finally:
            resolved.unpersist()


def start_alerts(
    spark: SparkSession,
    source: EventSource,
    sink: AlertSink,
    checkpoint: str,
    trigger: str | None = "10 seconds",
    schema: T.StructType = EVENT_SCHEMA,
    dedup_delay: str | None = None,
) -> StreamingQuery:
    """Start the stream. ``trigger`` is a processing-time interval, or None to take what is there and stop.

    ``dedup_delay`` also drops repeats of a title and source across micro-batches, those that arrive within it.
    """
    events = decode_json(read_event_stream(spark, source), schema)
    if dedup_delay:
        timed = events.withColumn("__at", F.coalesce(F.try_to_timestamp("published_at"), F.current_timestamp()))
        events = dedup_stream(timed, ["title", "source"], "__at", dedup_delay).drop("__at")
    writer = events.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return writer.start()


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """All alerts written so far, as written, batch by batch."""
    return spark.read.schema(ALERT_SCHEMA).parquet(path).filter(F.col(OUTCOME) == "good").drop(OUTCOME)


def read_rejected_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The alerts that did not fit the table, with reject_reasons and raw."""
    more = [T.StructField(REASONS, T.ArrayType(T.StringType())), T.StructField(RAW, T.StringType())]
    rows = spark.read.schema(T.StructType([*ALERT_SCHEMA.fields, *more])).parquet(path)
    return rows.filter(F.col(OUTCOME) == "rejected").drop(OUTCOME)


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """Alert counts by location and disease over all batches."""
    parts = spark.read.schema(ROLLUP_SCHEMA).parquet(path)
    return build_rollup(parts, ROLLUP_DIMS, {"alert_count": F.sum("alert_count")})


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATS_SCHEMA).parquet(path)


def compact_alerts(
    spark: SparkSession, path: str, out: str, keep: int = 2, retire: bool = False, rollup: str | None = None
) -> str:
    """Write the next snapshot of the alert table: the latest row per alert key, by month, with Bloom filters.

    Only batches that no earlier snapshot holds are read, and of the snapshot only the months that they touch: a month is
    part of the alert key by way of ``published_at``, so all other months are carried over unread. A month's
    rows are sorted by the alert key in files of measured size. ``rollup`` names a table of counts by location and disease
    that is kept in step: what a new row replaces is subtracted (``read_compacted_rollup``). ``retire`` then removes
    the folders of batches that an older snapshot holds already, so that they outlive the snapshot that took them
    in; ``keep`` snapshots stay.
    """
    folders = batch_folders(spark, path)
    done = set(snapshot_note(spark, out) or [])
    fresh = [f for f in folders if f not in done]
    if snapshot_path(spark, out) is not None and not fresh:
        return snapshot_path(spark, out)
    merged, old, parts = touched_months(spark, path, out, fresh)
    merged = merged.persist()
    try:
        if rollup:
            _write_rollup(spark, out, rollup, merged, old)
        # a retired folder stays on the list until it is gone, then its name can be forgotten
        note = sorted(done.intersection(folders) | set(fresh))
        options = bloom_options(["disease_key", "location_key"])
        ordered = clustered_files(merged, [ALERT_MONTH], ALERT_KEY)
        written = write_snapshot(ordered, out, [ALERT_MONTH], options=options, note=note, parts=parts, rebalance=False)
    finally:
        merged.unpersist()
    expire_snapshots(spark, out, keep)
    if rollup:
        expire_rollups(spark, out, rollup)
    if retire:
        for folder in done.intersection(folders):
            delete_path(spark, f"{path}/{folder}")
    return written


def touched_months(
    spark: SparkSession, path: str, out: str, fresh: list[str]
) -> tuple[DataFrame, DataFrame | None, dict[str, str | None]]:
    """What the months of new batches will hold, what they hold now, and where all months will lie."""
    good = [f"{path}/{f}/{OUTCOME}=good" for f in fresh if path_exists(spark, f"{path}/{f}/{OUTCOME}=good")]
    months = {m for f in good for m in list_folders(spark, f, f"{ALERT_MONTH}=")}
    placed = snapshot_parts(spark, out, ALERT_MONTH)
    parts: dict[str, str | None] = {**placed, **dict.fromkeys(months)}
    old = read_snapshot(spark, out, only=months & set(placed)) if months & set(placed) else None
    if months:
        reader = spark.read.schema(ALERT_SCHEMA).option("basePath", path)
        new = reader.parquet(*good).drop("stream", "batch_id", OUTCOME)
    else:
        new = spark.createDataFrame([], ALERT_SCHEMA).drop("stream", "batch_id")
    rows = new if old is None else old.unionByName(new)
    return keep_latest(rows, ALERT_KEY, "ingestion_time", ["alert_id"]), old, parts


def _write_rollup(spark: SparkSession, out: str, rollup: str, merged: DataFrame, old: DataFrame | None) -> None:
    """The rollup that belongs to the next snapshot; it is found by its version once that is complete."""
    version = f"v={next_version(spark, out):08d}"
    last = read_compacted_rollup(spark, out, rollup)
    if last is None and (known := read_snapshot(spark, out)) is not None:
        last = build_rollup(known, ROLLUP_DIMS)  # kept from now on
    counts = rollup_delta(old, merged, ROLLUP_DIMS)
    if last is not None:
        counts = merge_rollup(last, counts, ROLLUP_DIMS).filter("alert_count <> 0")
    counts.write.mode("overwrite").parquet(f"{rollup}/{version}")


def read_compacted_rollup(spark: SparkSession, out: str, rollup: str) -> DataFrame | None:
    """Alert counts by location and disease over the newest snapshot of the alert table."""
    current = snapshot_path(spark, out)
    path = current and f"{rollup}/{current.rstrip('/').rpartition('/')[2]}"
    if not path or not path_exists(spark, f"{path}/_SUCCESS"):
        return None
    return spark.read.schema(T.StructType(ROLLUP_SCHEMA.fields[:3])).parquet(path)


def expire_rollups(spark: SparkSession, out: str, rollup: str) -> None:
    """Remove the rollups of snapshots that are gone."""
    for version in list_folders(spark, rollup, "v="):
        if not path_exists(spark, f"{out}/{version}/_SUCCESS"):
            delete_path(spark, f"{rollup}/{version}")


def batch_folders(spark: SparkSession, path: str) -> list[str]:
    """``stream=.../batch_id=...`` folders that are complete."""
    found = []
    for stream in list_folders(spark, path, "stream="):
        for batch in list_folders(spark, f"{path}/{stream}", "batch_id="):
            if path_exists(spark, f"{path}/{stream}/{batch}/_SUCCESS"):
                found.append(f"{stream}/{batch}")
    return found
