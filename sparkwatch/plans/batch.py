"""The batch job: files -> bronze -> silver -> gold, one write per table and one metrics row set per stage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import AsOf, as_timestamp
from ..operators.dedup import keep_latest
from ..operators.quality import hold_invariant
from ..operators.scd import open_versions, scd2_merge
from ..operators.star import build_dim, build_fact
from ..session import ensure_checkpoint_dir
from ..sinks.conformed import conformed, read_good, write_conformed
from ..sinks.layers import bloom_options, clustered_files, insert_new, write_layer
from ..sinks.metrics import write_metrics
from ..sinks.snapshots import next_version, path_exists, read_snapshot, write_snapshot
from ..sources.layers import read_layer, read_raw_csv
from .outbreaks import CLEANING, DISEASE_DIM, FACT, LOCATION_DIM, RAW_SCHEMA, CleaningRules, clean, cleaning_funnel, ingest


TABLES = (
    "bronze",
    "silver",
    "dim_location",
    "dim_disease",
    "fact_outbreaks",
    "metrics",
    "alerts",
    "alert_stats",
    "alerts_latest",
    "alert_rollup",
    "alert_rollup_parts",
)

# The sort key under which location rows replace each other.
LOCATION_KEY = ("region_code", "country", "location_key")


# The columns of the fact table, none of which may be missing, the length of its keys, and the order of its rows.
FACT_SCHEMA = T.StructType(
    [
        T.StructField("outbreak_id", T.StringType(), False),
        T.StructField("location_key", T.StringType(), False),
        T.StructField("disease_key", T.StringType(), False),
        T.StructField("don_id", T.StringType(), False),
        T.StructField("outbreak_count", T.IntegerType(), False),
        T.StructField("ingestion_timestamp", T.TimestampType(), False),
        T.StructField("report_year", T.IntegerType(), False),
    ]
)
FACT_LENGTHS = {"outbreak_id": 32, "location_key": 32, "disease_key": 32}
FACT_ORDER = ("disease_key", "location_key", "outbreak_id")


@dataclass(frozen=True)
class Layout:
    """Where the tables of one warehouse live."""

    root: str

    def __getattr__(self, name: str) -> str:
        if name in TABLES:
            return f"{self.root}/{name}"
        raise AttributeError(name)


def run_bronze(
    spark: SparkSession, raw: str | Sequence[str], out: Layout, as_of: AsOf = None, run_id: str = "manual"
) -> DataFrame:
    bronze = ingest(read_raw_csv(spark, raw, RAW_SCHEMA), as_of)
    write_layer(bronze, out.bronze, ["year"])
    stored = read_layer(spark, out.bronze)
    metrics = {
        "rows_count": stored.count(),
        "layer": "bronze",
        "format": "parquet",
        "partitions": "year",
        "storage_path": out.bronze,
    }
    write_metrics(spark, run_id, "bronze", metrics, out.metrics)
    return stored


def run_silver(
    spark: SparkSession, out: Layout, rules: CleaningRules = CLEANING, as_of: AsOf = None, run_id: str = "manual"
) -> DataFrame:
    """Two jobs: the write, and one pass over bronze for the account of what was dropped.

    The final check is part of the write: what breaks it is removed, and counted by column on the way.
    """
    bronze = read_layer(spark, out.bronze)
    checked, found = hold_invariant(clean(bronze, rules, as_of))
    write_layer(checked, out.silver, ["year"])
    broken = found.get
    funnel = {r["step"]: r["n"] for r in cleaning_funnel(bronze, rules).collect()}
    funnel |= {"final": broken["rows"], "rows_out": funnel["rows_out"] - broken["rows"]}
    funnel |= {f"final_{c}": n for c, n in broken.items() if c != "rows" and n}
    policy = {"null_policy": "strict: no nulls or blanks in any column", "storage_path": out.silver}
    total = {"total_dropped": funnel["rows_in"] - funnel["rows_out"]}
    write_metrics(spark, run_id, "silver", {**funnel, **total, **policy}, out.metrics)
    return read_layer(spark, out.silver)


def run_gold(
    spark: SparkSession,
    out: Layout,
    as_of: AsOf = None,
    scd_mode: str = "on_change",
    run_id: str = "manual",
    fact_lengths: Mapping[str, int] = FACT_LENGTHS,
) -> dict[str, DataFrame]:
    """Dimensions as new snapshots; facts that are not stored yet are appended to their years.

    Facts are keyed by hash, so a repeated run adds nothing and a partial load takes nothing away. The
    dimensions are built from the same silver rows, so fact keys are computed and nothing is joined. Facts get their defaults
    and are conformed to the table; those that do not fit (``fact_lengths``: text of a fixed length) are kept apart by
    the same write. A year's facts are sorted by key in files of measured size.
    """
    silver = read_layer(spark, out.silver)

    places = build_dim(silver, LOCATION_DIM).withColumn("load_seq", F.lit(next_version(spark, out.dim_location)))
    known = read_snapshot(spark, out.dim_location)
    if known is not None:
        # the last load wins; places that are not in this load stay
        places = keep_latest(known.unionByName(places), LOCATION_KEY, "load_seq")
    write_snapshot(places, out.dim_location, ["region_code"])

    load = build_dim(silver, DISEASE_DIM)
    history = read_snapshot(spark, out.dim_disease)
    if history is None:
        versions = open_versions(load, as_of)
    else:
        attributes = list(DISEASE_DIM.attributes)
        versions = scd2_merge(
            history.drop("start_year"), load, DISEASE_DIM.natural_key, attributes, as_of, scd_mode
        )
    versions = versions.withColumn("start_year", F.year("start_date"))
    write_snapshot(versions, out.dim_disease, ["start_year"])

    fact = build_fact(silver, [(None, LOCATION_DIM), (None, DISEASE_DIM)], FACT, as_of)
    if path_exists(spark, out.fact_outbreaks):
        stored = read_layer(spark, out.fact_outbreaks, FACT_SCHEMA)  # rejected ones too, so that they are stored once
        fact = insert_new(fact, stored, FACT.key, "report_year")
    # the load is compared with what is stored, so it is worked out before the append begins
    ensure_checkpoint_dir(spark)
    defaults = {FACT.measure: 1, FACT.stamp: as_timestamp(as_of)}
    fact = conformed(fact, FACT_SCHEMA, fact_lengths, defaults).checkpoint()
    counts = write_conformed(
        clustered_files(fact, ["report_year"], FACT_ORDER),
        FACT_SCHEMA,
        out.fact_outbreaks,
        ["report_year"],
        mode="append",
        options=bloom_options(["disease_key", "location_key"]),
        rebalance=False,
    )

    tables = {
        "dim_location": read_snapshot(spark, out.dim_location),
        "dim_disease": read_snapshot(spark, out.dim_disease),
        "fact_outbreaks": read_good(spark, out.fact_outbreaks, FACT_SCHEMA),
    }
    metrics = {f"{name}_rows": df.count() for name, df in tables.items()}
    metrics |= {f"facts_{outcome}": n for outcome, n in counts.items()}
    notes = {"scd2": scd_mode, "key_strategy": "md5 of the natural key, the same for all versions", "write_mode": "append of new keys"}
    write_metrics(spark, run_id, "gold", {**metrics, **notes}, out.metrics)
    return tables


def run_batch(
    spark: SparkSession,
    raw: str | Sequence[str],
    root: str,
    rules: CleaningRules = CLEANING,
    as_of: AsOf = None,
    scd_mode: str = "on_change",
    run_id: str = "manual",
    fact_lengths: Mapping[str, int] = FACT_LENGTHS,
) -> dict[str, DataFrame]:
    out = Layout(root)
    run_bronze(spark, raw, out, as_of, run_id)
    run_silver(spark, out, rules, as_of, run_id)
    return run_gold(spark, out, as_of, scd_mode, run_id, fact_lengths)
