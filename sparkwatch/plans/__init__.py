from .batch import Layout, run_batch, run_bronze, run_gold, run_silver
from .feed import feed_page, feed_to_events
from .live import run_alerts, update_rollup, warehouse_dims, warehouse_geo, warehouse_trend
from .outbreaks import CLEANING, DISEASE_DIM, FACT, LOCATION_DIM, RAW_SCHEMA, CleaningRules, clean, ingest

__all__ = [
    "CLEANING",
    "CleaningRules",
    "DISEASE_DIM",
    "FACT",
    "LOCATION_DIM",
    "Layout",
    "RAW_SCHEMA",
    "clean",
    "feed_page",
    "feed_to_events",
    "ingest",
    "run_alerts",
    "run_batch",
    "run_bronze",
    "run_gold",
    "run_silver",
    "update_rollup",
    "warehouse_dims",
    "warehouse_geo",
    "warehouse_trend",
]
