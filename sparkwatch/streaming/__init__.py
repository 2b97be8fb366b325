from .alerts import (
    AlertSink,
    compact_alerts,
    dedup_stream,
    read_alerts,
    read_compacted_rollup,
    read_rollup,
    read_stats,
    start_alerts,
)
from .feed import filter_feed, start_feed

__all__ = [
    "AlertSink",
    "compact_alerts",
    "dedup_stream",
    "filter_feed",
    "read_alerts",
    "read_compacted_rollup",
    "read_rollup",
    "read_stats",
    "start_alerts",
    "start_feed",
]
