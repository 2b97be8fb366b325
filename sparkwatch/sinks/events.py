"""Keyed JSON events for a topic or for files of the same shape."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.times import AsOf, as_timestamp

# The fields of a published event, in order.
EVENT_FIELDS = (
    "title",
    "description",
    "content",
    "author",
    "source",
    "published_at",
    "url",
    "language",
    "ingestion_time",
)


def to_events(
    df: DataFrame,
    key_col: str = "title",
    fields: Sequence[str] = EVENT_FIELDS,
    language: str = "en",
    as_of: AsOf = None,
) -> DataFrame:
    """(key, value): the key column and one JSON object per row. Null fields are written as null.

    ``language`` and ``ingestion_time`` are added where the frame lacks them.
    """
    stamp = F.date_format(as_timestamp(as_of), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    added = {"language": F.lit(language), "ingestion_time": stamp}
    df = df.withColumns({n: e for n, e in added.items() if n in fields and n not in df.columns})
    packed = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return df.select(F.col(key_col).cast("string").alias("key"), packed.alias("value"))


def publish(
    events: DataFrame, format: str = "json", path: str | None = None, options: Mapping[str, str] | None = None
) -> int:
    """Write (key, value) events and return how many were sent, counted by the write itself."""
    sent = Observation()
    writer = events.observe(sent, F.count(F.lit(1)).alias("n")).write.format(format).mode("append")
    writer = writer.options(**(options or {}))
    writer.save(path) if path else writer.save()
    return sent.get["n"]
