"""Which stream a micro-batch belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame


def stream_name(batch: DataFrame, stream: str | None = None) -> str:
    """Name of the streaming query that a micro-batch belongs to.

    Batch ids count from 0 for every checkpoint, so what a batch stores is also named by its query. Spark keeps
    that name in the checkpoint: a restart has the same one, a new checkpoint another.
    """
    name = stream or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not name:
        raise ValueError("outside a streaming query the stream has to be named")
    return name
