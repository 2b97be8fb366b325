from .events import EVENT_SCHEMA, EventSource, decode_json, read_event_stream, read_events
from .feed import ARTICLE_SCHEMA, read_article_feed, stream_article_feed
from .layers import read_layer, read_raw_csv, with_lineage, with_load_date
from .lexicons import load_lexicon, load_patterns

__all__ = [
    "ARTICLE_SCHEMA",
    "EVENT_SCHEMA",
    "EventSource",
    "decode_json",
    "load_lexicon",
    "load_patterns",
    "read_article_feed",
    "read_event_stream",
    "read_events",
    "read_layer",
    "read_raw_csv",
    "stream_article_feed",
    "with_lineage",
    "with_load_date",
]
