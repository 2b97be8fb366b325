"""The stateless filter between a raw article feed and the event topic."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import functions as F

from ..functions.matching import Lexicon, relevance
from ..functions.text import strip_ws, text_of
from ..functions.times import AsOf
from ..operators.alerts import valid_event
from ..operators.columns import computed_once
from ..operators.dedup import dedup_either
from ..sinks.events import publish, to_events
from .identity import stream_name


def filter_feed(
    articles: DataFrame,
    exclude: Lexicon | Sequence[str],
    all_of: Sequence[Lexicon | Sequence[str]],
    match: str = "word",
) -> DataFrame:
    """Valid and relevant articles with their titles stripped; works on batch and stream alike."""
    rows = computed_once(valid_event(articles), {"__lower": F.lower(text_of("title", "description"))})
    rows = rows.filter(relevance(F.col("__lower"), exclude, all_of, match, lowered=True)).drop("__lower")
    return rows.withColumn("title", strip_ws("title"))


def start_feed(
    articles: DataFrame,
    exclude: Lexicon | Sequence[str],
    all_of: Sequence[Lexicon | Sequence[str]],
    checkpoint: str,
    path: str | None = None,
    format: str = "json",
    options: Mapping[str, str] | None = None,
    match: str = "word",
    as_of: AsOf = None,
    trigger: str | None = None,
) -> StreamingQuery:
    """Filter an article stream, drop repeats of a url or title within a micro-batch, publish events."""
    kept = filter_feed(articles, exclude, all_of, match)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # the filter's outcome is read more than once
        try:
            fresh = dedup_either(batch, ["url", F.lower("title")], ["feed_position", "published_at", "url"])
            events = to_events(fresh, as_of=as_of)
            if path and format != "kafka":
                # a replayed batch replaces its own folder
                folder = f"{path}/{stream_name(batch)}-{batch_id}"
                events.write.format(format).mode("overwrite").options(**(options or {})).save(folder)
            else:
                publish(events, format, path, options)
        finally:
            batch.unpersist()

    writer = kept.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return writer.start()
