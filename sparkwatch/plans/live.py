"""The live job on top of a warehouse: alerts from events, compaction, and the stored rollup."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.times import AsOf
from ..operators.alerts import EntityRules, load_dim_lookup
from ..operators.rollups import build_rollup, geo_totals, merge_rollup, trend_by_year
from ..sinks.conformed import read_good
from ..sinks.snapshots import read_snapshot, snapshot_note, write_snapshot
from ..sources.events import EventSource
from ..streaming.alerts import ROLLUP_DIMS, AlertSink, start_alerts
from .batch import FACT_SCHEMA, Layout


def stored(spark: SparkSession, root: str) -> DataFrame:
    table = read_snapshot(spark, root)
    if table is None:
        raise FileNotFoundError(f"no snapshot under {root}; run the batch job first")
    return table


def warehouse_dims(spark: SparkSession, out: Layout) -> tuple[Callable[[], DataFrame], Callable[[], DataFrame]]:
    """Loaders of the current (disease_name, disease_key) and all (country, location_key)."""

    def diseases() -> DataFrame:
        return load_dim_lookup(stored(spark, out.dim_disease), "disease_name", "disease_key", current_only=True)

    def locations() -> DataFrame:
        return load_dim_lookup(stored(spark, out.dim_location), "country", "location_key")

    return diseases, locations


def run_alerts(
    spark: SparkSession,
    source: EventSource,
    out: Layout,
    checkpoint: str,
    disease_rules: EntityRules,
    country_rules: EntityRules,
    trigger: str | None = "10 seconds",
    as_of: AsOf = None,
) -> StreamingQuery:
    """Start the alert stream against the dimensions of a warehouse."""
    diseases, locations = warehouse_dims(spark, out)
    sink = AlertSink(
        out.alerts,
        out.alert_stats,
        diseases,
        locations,
        disease_rules,
        country_rules,
        as_of,
        rollup_path=out.alert_rollup_parts,
    )
    return start_alerts(spark, source, sink, checkpoint, trigger)


def update_rollup(delta: DataFrame, root: str, batch: str, dims: Sequence[str] = ROLLUP_DIMS) -> DataFrame:
    """Add the rows of a named batch to the stored rollup; a batch that is in it already adds nothing."""
    spark = delta.sparkSession
    taken = snapshot_note(spark, root) or []
    if batch not in taken:
        fresh = build_rollup(delta, list(dims))
        stored = read_snapshot(spark, root)
        merged = fresh if stored is None else merge_rollup(stored, fresh, list(dims))
        write_snapshot(merged, root, note=[*taken, batch])
    return read_snapshot(spark, root)


def _facts(spark: SparkSession, out: Layout) -> DataFrame:
    return read_good(spark, out.fact_outbreaks, FACT_SCHEMA)


def warehouse_trend(spark: SparkSession, out: Layout, by: Sequence[str] = ("disease_name", "region_code")) -> DataFrame:
    """Yearly totals of the stored facts by attributes of the dimensions as they are now."""
    dims = [(stored(spark, out.dim_disease), "disease_key"), (stored(spark, out.dim_location), "location_key")]
    return trend_by_year(_facts(spark, out), dims, list(by), "report_year", "outbreak_count")


def warehouse_geo(spark: SparkSession, out: Layout, by: Sequence[str] = ("region_code", "country")) -> DataFrame:
    """Totals of the stored facts by attributes of the places as they are now."""
    return geo_totals(_facts(spark, out), stored(spark, out.dim_location), "location_key", list(by), "outbreak_count")
