"""Queries that go through stored tables: files in, layers, layout, snapshots, repeated loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwatch.functions import year_month
from sparkwatch.plans import CleaningRules, Layout, run_batch, warehouse_geo, warehouse_trend
from sparkwatch.plans.batch import FACT_LENGTHS, FACT_SCHEMA, run_bronze, run_silver
from sparkwatch.plans.outbreaks import RAW_COLUMNS
from sparkwatch.sinks import (
    append_table,
    bloom_options,
    cluster_by,
    insert_new,
    read_good,
    read_rejected,
    read_snapshot,
    with_partition_col,
    write_layer,
    write_snapshot,
)
from sparkwatch.sources import read_layer, read_raw_csv
from sparkwatch.sources.layers import with_lineage

from .registry import query, table, work_dir

AS_OF = "2024-02-01 06:00:00"


@query(
    """SELECT event_id, user_id, ts, CAST(year(ts) * 100 + month(ts) AS INTEGER) AS month, event_type
       FROM events WHERE event_type = 'click'"""
)
def layer_scan(spark, sf):
    """A layer partitioned by type, clustered by user, with Bloom filters; read back with partition pruning."""
    path = work_dir(spark, "layer")
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    events = with_partition_col(events, "month", year_month("ts"))
    clustered = cluster_by(events, ["event_type", "user_id"], spread=["event_id"])
    write_layer(clustered, path, ["event_type"], rebalance=False, options=bloom_options(["user_id"]))
    return read_layer(spark, path).filter("event_type = 'click'")


@query("SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def repeated_load(spark, sf):
    """Part of the orders are stored by year, then all are loaded twice, each key doubled: every order is stored once."""
    path = work_dir(spark, "orders")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    append_table(orders.filter("o_totalprice < 250000"), path=path, partition_by=["year"])
    for _ in range(2):
        fresh = insert_new(orders.unionByName(orders), read_layer(spark, path), "o_orderkey", "year")
        append_table(fresh, path=path, partition_by=["year"])
    return read_layer(spark, path)


@query(
    """SELECT s_suppkey, CASE WHEN s_acctbal < 5000 THEN s_acctbal + 1 ELSE s_acctbal END AS s_acctbal FROM supplier"""
)
def table_snapshots(spark, sf):
    """A table rewritten from its own content becomes a new version; readers take the newest."""
    root = work_dir(spark, "supplier")
    write_snapshot(table(spark, sf, "supplier").select("s_suppkey", "s_acctbal"), root)
    bal = F.col("s_acctbal")
    changed = read_snapshot(spark, root).withColumn("s_acctbal", F.when(bal < 5000, bal + 1).otherwise(bal))
    write_snapshot(changed, root)
    return read_snapshot(spark, root)


@query("SELECT o_orderkey, o_orderstatus AS folder, o_totalprice FROM orders")
def file_lineage(spark, sf):
    """Orders landed in a folder per status and read back as one table: each row knows the file it came from."""
    root = work_dir(spark, "landed")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    orders.write.partitionBy("o_orderstatus").option("header", True).csv(root)
    rows = with_lineage(read_raw_csv(spark, f"{root}/*/*.csv", orders.drop("o_orderstatus").schema))
    return rows.select("o_orderkey", F.regexp_extract("source_file", "o_orderstatus=([^/]+)/[^/]+csv$", 1).alias("folder"), "o_totalprice")


def raw_files(spark, sf, path: str, part: str = "true", short: str = "false") -> None:
    """Raw outbreak files from the order tables, with blanks, missing and unparsable years among them.

    ``short`` tells which records have a DON id of the wrong length.
    """
    orders = table(spark, sf, "orders").filter(part).withColumnRenamed("o_custkey", "c_custkey")
    nation = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    region = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    rows = orders.join(customer, "c_custkey").join(nation, "c_nationkey").join(region, "n_regionkey")
    year = F.year("o_orderdate")
    fields = {
        "id_outbreak": F.concat(F.lit("OB"), (F.col("o_orderkey") / 2).cast("long").cast("string")),
        "Year": F.when(F.col("o_totalprice") < 20000, "n/a").otherwise(year.cast("string")),
        "icd10c": F.lit("a00"),
        "icd104c": F.concat(F.lit("A00."), F.col("o_orderstatus")),
        "Disease": F.lower("o_orderpriority"),
        "Definition": F.when(F.col("o_totalprice") > 480000, "   ").otherwise(F.col("o_orderpriority")),
        "Country": F.lower("n_name"),
        "iso3": F.concat(F.lit("n"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")),
        "unsd_region": F.col("r_name"),
        "unsd_subregion": F.col("r_name"),
        "who_region": F.nullif("r_name", F.lit("ASIA")),
        "DONs": F.concat(F.when(F.expr(short), "D").otherwise("DON"), (year * 100 + F.month("o_orderdate")).cast("string")),
    }
    cols = [fields.get(c, F.lit("x")).alias(c) for c in RAW_COLUMNS]
    rows.select(*cols).write.mode("overwrite").option("header", True).option("quoteAll", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)


RAW = """SELECT 'OB' || CAST(o_orderkey // 2 AS VARCHAR) AS outbreak_id,
       CASE WHEN o_totalprice < 20000 THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END AS year,
       upper(o_orderpriority) AS disease_name,
       CASE WHEN o_totalprice > 480000 THEN '' ELSE o_orderpriority END AS definition, o_orderstatus,
       upper(n_name) AS country, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iso3,
       nullif(r_name, 'ASIA') AS region_code,
       'DON' || CAST(year(o_orderdate) * 100 + month(o_orderdate) AS VARCHAR) AS don_id
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey"""

BATCH_FACT = f"""WITH raw AS ({RAW}),
ok AS (SELECT * FROM raw WHERE year IS NOT NULL AND definition <> '' AND region_code IS NOT NULL),
winners AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY outbreak_id ORDER BY year DESC, disease_name, definition,
                               'A00.' || o_orderstatus, country, iso3, region_code, don_id) AS rn FROM ok) WHERE rn = 1),
silver AS (SELECT * FROM winners WHERE year >= 1996)
SELECT DISTINCT md5(concat_ws('_', md5(iso3), md5(lower(disease_name)), don_id, year)) AS outbreak_id,
       md5(iso3) AS location_key, md5(lower(disease_name)) AS disease_key, year AS report_year, don_id, 1 AS outbreak_count
FROM silver"""


@query(BATCH_FACT)
def batch_pipeline(spark, sf):
    """Files to fact table through bronze, silver and gold."""
    root = work_dir(spark, "batch")
    raw_files(spark, sf, f"{root}/raw")
    tables = run_batch(spark, f"{root}/raw/*.csv", f"{root}/warehouse", as_of=AS_OF)
    return tables["fact_outbreaks"].drop("ingestion_timestamp")


SHORT = "o_orderstatus = 'P'"
SHORT_FACT = BATCH_FACT.replace("'DON' ||", f"CASE WHEN {SHORT} THEN 'D' ELSE 'DON' END ||")


@query(
    f"""WITH facts AS ({SHORT_FACT})
        SELECT outbreak_id, CASE WHEN length(don_id) = 9 THEN 'good' ELSE 'rejected' END AS outcome,
               CASE WHEN length(don_id) <> 9 THEN 'don_id: length is not 9' END AS reason,
               count(*) FILTER (length(don_id) = 9) OVER () AS facts_good, count(*) FILTER (length(don_id) <> 9) OVER () AS facts_rejected
        FROM facts"""
)
def batch_rejects(spark, sf):
    """Good and rejected facts of a load with DON ids of the wrong length, and their counts as observed by the write.

    The same files are loaded twice; rejected facts are stored once as well.
    """
    root = work_dir(spark, "rejects")
    raw_files(spark, sf, f"{root}/raw", short=SHORT)
    out = Layout(f"{root}/warehouse")
    lengths = {**FACT_LENGTHS, "don_id": 9}
    for run in ("r1", "r2"):
        run_batch(spark, f"{root}/raw/*.csv", out.root, as_of=AS_OF, run_id=run, fact_lengths=lengths)
    counts = read_layer(spark, out.metrics).filter("run_id = 'r1' AND metric LIKE 'facts_%'")
    wide = counts.groupBy().pivot("metric", ["facts_good", "facts_rejected"]).agg(F.first("number"))
    good = read_good(spark, out.fact_outbreaks, FACT_SCHEMA).select("outbreak_id", F.lit("good").alias("outcome"), F.lit(None).cast("string").alias("reason"))
    bad = read_rejected(spark, out.fact_outbreaks, FACT_SCHEMA)
    rejected = bad.select("outbreak_id", F.lit("rejected").alias("outcome"), F.array_join("reject_reasons", "; ").alias("reason"))
    return good.unionByName(rejected).join(F.broadcast(wide))


BLANKED = "NATION_1%"


@query(
    f"""WITH raw AS ({RAW}), bronze AS (SELECT * FROM raw WHERE year IS NOT NULL),
        ok AS (SELECT * FROM bronze WHERE definition <> '' AND region_code IS NOT NULL),
        winners AS (SELECT *, row_number() OVER (PARTITION BY outbreak_id ORDER BY year DESC, disease_name, definition,
                               'A00.' || o_orderstatus, country, iso3, region_code, don_id) AS rn FROM ok),
        best AS (SELECT * FROM winners WHERE rn = 1 AND year >= 1996)
        SELECT 'rows_in' AS metric, (SELECT count(*) FROM bronze) AS number
        UNION ALL SELECT 'final', (SELECT count(*) FROM best WHERE country LIKE '{BLANKED}')
        UNION ALL SELECT 'final_country', (SELECT count(*) FROM best WHERE country LIKE '{BLANKED}')
        UNION ALL SELECT 'rows_out', (SELECT count(*) FROM best WHERE country NOT LIKE '{BLANKED}')
        UNION ALL SELECT 'stored', (SELECT count(*) FROM best WHERE country NOT LIKE '{BLANKED}')"""
)
def funnel_final(spark, sf):
    """Cleaning rules whose repair blanks some countries after the strict drop: the write's final check removes and counts them."""
    root = work_dir(spark, "final")
    raw_files(spark, sf, f"{root}/raw")
    out = Layout(f"{root}/warehouse")
    run_bronze(spark, f"{root}/raw/*.csv", out, AS_OF, "r1")
    silver = run_silver(spark, out, CleaningRules(legacy_order=True, repairs=((BLANKED, " "),)), AS_OF, "r1")
    rows = read_layer(spark, out.metrics).filter("run_id = 'r1' AND stage = 'silver' AND number IS NOT NULL")
    wanted = rows.filter(F.col("metric").isin("rows_in", "final", "final_country", "rows_out")).select("metric", "number")
    return wanted.unionByName(silver.agg(F.lit("stored").alias("metric"), F.count(F.lit(1)).alias("number")))


def two_loads(spark, sf) -> tuple[Layout, dict]:
    """A warehouse after two loads of the same years; the second one opens new versions of every disease."""
    root = work_dir(spark, "batch")
    out = Layout(f"{root}/warehouse")
    for name, part in (("one", "(o_orderkey div 2) % 3 = 0"), ("two", "(o_orderkey div 2) % 3 <> 0")):
        raw_files(spark, sf, f"{root}/{name}", part)
        tables = run_batch(spark, f"{root}/{name}/*.csv", out.root, as_of=AS_OF, scd_mode="always")
    return out, tables


@query(BATCH_FACT)
def batch_two_loads(spark, sf):
    """The facts of both loads, each once."""
    return two_loads(spark, sf)[1]["fact_outbreaks"].drop("ingestion_timestamp")


NAMES = f"""facts AS ({BATCH_FACT}),
places AS (SELECT DISTINCT md5(iso3) AS location_key, country, region_code FROM ({RAW}) AS r WHERE region_code IS NOT NULL),
names AS (SELECT DISTINCT md5(lower(disease_name)) AS disease_key, disease_name FROM ({RAW}) AS r)"""


@query(
    f"""WITH {NAMES} SELECT report_year, disease_name, region_code, CAST(sum(outbreak_count) AS BIGINT) AS outbreak_count
        FROM facts JOIN places USING (location_key) JOIN names USING (disease_key) GROUP BY ALL"""
)
def warehouse_trend_by_year(spark, sf):
    return warehouse_trend(spark, two_loads(spark, sf)[0])


@query(
    f"""WITH {NAMES} SELECT region_code, country, CAST(sum(outbreak_count) AS BIGINT) AS outbreak_count
        FROM facts JOIN places USING (location_key) GROUP BY ALL"""
)
def warehouse_geo_totals(spark, sf):
    return warehouse_geo(spark, two_loads(spark, sf)[0])


@query(
    f"""WITH raw AS ({RAW}), bronze AS (SELECT * FROM raw WHERE year IS NOT NULL),
        ok AS (SELECT * FROM bronze WHERE definition <> '' AND region_code IS NOT NULL),
        best AS (SELECT outbreak_id, max(year) AS year, count(*) AS n FROM ok GROUP BY outbreak_id)
        SELECT 'rows_in' AS metric, (SELECT count(*) FROM bronze) AS number
        UNION ALL SELECT 'null', (SELECT count(*) FROM bronze WHERE region_code IS NULL)
        UNION ALL SELECT 'blank', (SELECT count(*) FROM bronze WHERE region_code IS NOT NULL AND definition = '')
        UNION ALL SELECT 'duplicate', (SELECT sum(n - 1)::BIGINT FROM best)
        UNION ALL SELECT 'bound', (SELECT count(*) FROM best WHERE year < 1996)
        UNION ALL SELECT 'final', 0
        UNION ALL SELECT 'rows_out', (SELECT count(*) FROM best WHERE year >= 1996)
        UNION ALL SELECT 'total_dropped', (SELECT count(*) FROM bronze) - (SELECT count(*) FROM best WHERE year >= 1996)"""
)
def run_metrics(spark, sf):
    """The metrics a run leaves behind for its silver stage."""
    root = work_dir(spark, "metrics")
    raw_files(spark, sf, f"{root}/raw")
    out = Layout(f"{root}/warehouse")
    run_batch(spark, f"{root}/raw/*.csv", out.root, as_of=AS_OF, run_id="r1")
    rows = read_layer(spark, out.metrics).filter("run_id = 'r1' AND stage = 'silver' AND number IS NOT NULL")
    return rows.select("metric", "number")
