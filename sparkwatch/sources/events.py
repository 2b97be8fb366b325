"""Keyed JSON event streams."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("title", "description", "source", "published_at", "url")]
)

# the shape of an event on any transport
KEYED = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])


@dataclass(frozen=True)
class EventSource:
    """Where events come from: a Kafka topic, or a folder of files with the same (key, value) shape.

    ``starting_offsets`` and ``max_per_trigger`` bound what a stream takes in; ``options`` go to the reader.
    """

    format: str = "kafka"
    servers: str | None = None
    topic: str | None = None
    path: str | None = None
    starting_offsets: str = "latest"
    max_per_trigger: int | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def reader_options(self, streaming: bool) -> dict[str, str]:
        opts: dict[str, str] = {}
        if self.format == "kafka":
            if not self.servers or not self.topic:
                raise ValueError("a Kafka source needs servers and a topic")
            opts = {"kafka.bootstrap.servers": self.servers, "subscribe": self.topic}
            if streaming:
                opts["startingOffsets"] = self.starting_offsets
                if self.max_per_trigger:
                    opts["maxOffsetsPerTrigger"] = str(self.max_per_trigger)
        elif streaming and self.max_per_trigger:
            opts = {"maxFilesPerTrigger": str(self.max_per_trigger)}
        return {**opts, **self.options}


def _load(reader, source: EventSource, streaming: bool) -> DataFrame:
    reader = reader.format(source.format).options(**source.reader_options(streaming))
    if source.format == "kafka":
        return reader.load()
    if not source.path:
        raise ValueError("a file source needs a path")
    if source.format == "text":
        return reader.load(source.path).select(F.lit(None).cast("string").alias("key"), "value")
    return reader.schema(KEYED).load(source.path)


def read_event_stream(spark: SparkSession, source: EventSource) -> DataFrame:
    """Unbounded (key, value, ...) frame of the source."""
    return _load(spark.readStream, source, streaming=True)


def read_events(spark: SparkSession, source: EventSource) -> DataFrame:
    """The same source as a bounded frame, for backfills."""
    return _load(spark.read, source, streaming=False)


def decode_json(df: DataFrame, schema: T.StructType = EVENT_SCHEMA, col: str | Column = "value") -> DataFrame:
    """Bytes or text to the flat columns of ``schema``; bad JSON gives nulls, unknown fields are ignored."""
    value = F.col(col) if isinstance(col, str) else col
    return df.select(F.from_json(value.cast("string"), schema).alias("data")).select("data.*")
