"""Rollups and serving queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwatch.operators import alerts_against_history, build_rollup, keep_latest, merge_rollup, top_n
from sparkwatch.operators import geo_totals as geo
from sparkwatch.operators import trend_by_year as trend
from sparkwatch.streaming.alerts import ALERT_KEY

from .live import ALERTS, RESOLVED, alerts
from .registry import query, table
from .warehouse import STAR, star

ROLLUP_DIMS = ["location_key", "disease_key"]


@query("SELECT user_id AS location_key, event_type AS disease_key, count(*) AS alert_count FROM events GROUP BY ALL")
def alert_rollup(spark, sf):
    events = table(spark, sf, "events").select(
        F.col("user_id").alias("location_key"), F.col("event_type").alias("disease_key")
    )
    return build_rollup(events, ROLLUP_DIMS)


@query(
    """SELECT l_suppkey AS location_key, l_returnflag AS disease_key, count(*) AS alert_count,
              CAST(sum(l_linenumber) AS BIGINT) AS lines
       FROM lineitem GROUP BY ALL"""
)
def rollup_merge(spark, sf):
    """A stored rollup of the lines before 1998 and the rollup of the rest, merged."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("location_key"), F.col("l_returnflag").alias("disease_key"), "l_linenumber", "l_shipdate"
    )
    aggs = {"alert_count": F.count(F.lit(1)), "lines": F.sum("l_linenumber")}
    stored = build_rollup(lines.filter("l_shipdate < '1998-01-01'"), ROLLUP_DIMS, aggs)
    delta = build_rollup(lines.filter("l_shipdate >= '1998-01-01'"), ROLLUP_DIMS, aggs)
    return merge_rollup(stored, delta, ROLLUP_DIMS)


@query(
    f"""WITH {STAR} SELECT report_year, disease_name, region_code, CAST(sum(outbreak_count) AS BIGINT) AS outbreak_count
        FROM facts JOIN locations USING (location_key) JOIN diseases USING (disease_key) GROUP BY ALL"""
)
def trend_by_year(spark, sf):
    location, disease, fact = star(spark, sf)
    dims = [(disease, "disease_key"), (location, "location_key")]
    return trend(fact, dims, ["disease_name", "region_code"], "report_year", "outbreak_count")


@query(
    f"""WITH {STAR} SELECT region_code, country, CAST(sum(outbreak_count) AS BIGINT) AS outbreak_count
        FROM facts JOIN locations USING (location_key) GROUP BY ALL"""
)
def geo_totals(spark, sf):
    location, _, fact = star(spark, sf)
    return geo(fact, location, "location_key", ["region_code", "country"], "outbreak_count")


@query(
    """WITH live AS (SELECT user_id AS location_key, event_type AS disease_key, count(*) AS alert_count
                     FROM events GROUP BY ALL),
            past AS (SELECT o_custkey AS location_key, CASE o_orderstatus WHEN 'O' THEN 'view' WHEN 'F' THEN 'error'
                            ELSE 'other' END AS disease_key, count(*) AS history_count FROM orders GROUP BY ALL)
       SELECT location_key, disease_key, coalesce(alert_count, 0) AS alert_count, coalesce(history_count, 0) AS history_count
       FROM live FULL JOIN past USING (location_key, disease_key)"""
)
def alert_vs_history(spark, sf):
    live = table(spark, sf, "events").select(
        F.col("user_id").alias("location_key"), F.col("event_type").alias("disease_key")
    )
    status = F.col("o_orderstatus")
    past = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("location_key"),
        F.when(status == "O", "view").when(status == "F", "error").otherwise("other").alias("disease_key"),
        F.lit(1).alias("outbreak_count"),
    )
    return alerts_against_history(live, past, ["location_key", "disease_key"])


@query(
    f"""WITH {RESOLVED}, alerts AS ({ALERTS})
        SELECT alert_id, source, published_at, url FROM (
          SELECT *, row_number() OVER (PARTITION BY source, location_key, published_at, disease_key
                                       ORDER BY ingestion_time DESC, alert_id) AS rn FROM alerts)
        WHERE rn = 1 ORDER BY published_at DESC, alert_id LIMIT 50"""
)
def latest_alerts(spark, sf):
    """The feed of current alerts: latest row per alert key, newest first, one page."""
    latest = keep_latest(alerts(spark, sf), ALERT_KEY, "ingestion_time", ["alert_id"])
    page = latest.select("alert_id", "source", "published_at", "url")
    return top_n(page, [F.desc("published_at"), F.asc("alert_id")], 50)
