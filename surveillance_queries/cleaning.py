"""Projection, standardisation, quality and deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwatch.functions import hash_key, year_month
from sparkwatch.operators import (
    apply_defaults,
    assert_or_remove,
    conform,
    dedup,
    dedup_either,
    distinct_names,
    drop_any_blank,
    fallback,
    fill_from_groups,
    keep_latest,
    min_bound,
    null_profile,
    project,
    quality_funnel,
    rename,
    repair_like,
    require,
    standardize,
    with_measure,
    with_stamp,
)
from sparkwatch.operators.conform import REASONS
from sparkwatch.sinks import with_partition_col
from sparkwatch.sources import with_load_date

from .registry import query, table

AS_OF = "2024-02-01 06:00:00"


@query(
    """SELECT c_custkey AS customer_id, trim('  ' || c_name || ' ') AS customer_name, c_mktsegment AS market
       FROM customer"""
)
def project_trim(spark, sf):
    padded = table(spark, sf, "customer").withColumn("c_name", F.concat(F.lit("  "), "c_name", F.lit(" ")))
    kept = project(padded, {"c_custkey": "customer_id", "c_name": "customer_name", "c_mktsegment": "segment"})
    return rename(kept, {"segment": "market"})


@query(
    """SELECT p_partkey, trim(upper('  ' || p_name)) AS p_name, trim(upper(p_brand)) AS p_brand,
              trim(p_type || '  ') AS p_type, 1 AS n
       FROM part""",
    name="standardize",
)
def standardize_values(spark, sf):
    messy = table(spark, sf, "part").select(
        "p_partkey",
        F.concat(F.lit("  "), "p_name").alias("p_name"),
        "p_brand",
        F.concat("p_type", F.lit("  ")).alias("p_type"),
    )
    return with_measure(standardize(messy, ["p_name", "p_brand", "not_there"], ["p_type"]), "n")


@query(
    f"""SELECT o_orderkey, o_orderdate, DATE '2024-02-01' AS ingestion_date,
               TIMESTAMP '{AS_OF}' AS cleaning_timestamp
        FROM orders"""
)
def load_stamp(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return with_stamp(with_load_date(orders, AS_OF), "cleaning_timestamp", AS_OF)


@query(
    f"""SELECT event_id, coalesce(CASE WHEN event_type = 'error' THEN NULL ELSE value END, 0.0) AS value,
               1 AS outbreak_count, TIMESTAMP '{AS_OF}' AS ingestion_timestamp
        FROM events"""
)
def defaults(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    )
    stamp = F.lit(AS_OF).cast("timestamp")
    return apply_defaults(events, {"value": 0.0, "outbreak_count": 1, "ingestion_timestamp": stamp})


@query(
    f"""SELECT event_id,
              event_type AS code,
              CASE WHEN event_type = 'error' THEN NULL ELSE value END AS amount,
              CAST(user_id AS INTEGER) AS user_id,
              concat_ws('; ',
                CASE WHEN length(event_type) <> 5 THEN 'code: length is not 5' END,
                CASE WHEN event_type = 'error' THEN 'amount: not a double' END,
                CASE WHEN value > 50 THEN 'region: missing' END) AS reasons
       FROM events""",
    name="conform",
)
def conform_types(spark, sf):
    raw = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("event_type").alias("code"),
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string")).alias("amount"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(F.col("value") <= 50, "x").alias("region"),
    )
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("code", T.StringType()),
            T.StructField("amount", T.DoubleType()),
            T.StructField("user_id", T.IntegerType()),
            T.StructField("region", T.StringType(), nullable=False),
        ]
    )
    typed = conform(raw, schema, {"code": 5})
    return typed.withColumn("reasons", F.array_join(REASONS, "; ")).drop(REASONS, "region")


@query(
    "SELECT event_id, user_id, event_type, value FROM events WHERE event_type <> 'error' AND value >= 10",
    name="require",
)
def required_columns(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id",
        "user_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("value") >= 10, F.col("value")).alias("value"),
    )
    return require(events, ["event_type", "value"])


def _dirty_orders(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("o_orderpriority") == "5-LOW", "   ").otherwise(F.col("o_orderpriority")).alias("priority"),
        F.year("o_orderdate").alias("year"),
    )


DIRTY_ORDERS = """SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status,
       CASE WHEN o_orderpriority = '5-LOW' THEN '   ' ELSE o_orderpriority END AS priority,
       CAST(year(o_orderdate) AS INTEGER) AS year
FROM orders"""


@query(
    f"""WITH d AS ({DIRTY_ORDERS})
        SELECT * FROM d WHERE status IS NOT NULL AND trim(priority) <> '' AND year >= 1996"""
)
def strict_quality(spark, sf):
    return min_bound(drop_any_blank(_dirty_orders(spark, sf)), "year", 1996)


@query(
    f"""WITH d AS ({DIRTY_ORDERS})
        SELECT 'o_orderkey' AS column_name, count(*) FILTER (o_orderkey IS NULL) AS n_bad FROM d
        UNION ALL SELECT 'status', count(*) FILTER (status IS NULL OR trim(status) = '') FROM d
        UNION ALL SELECT 'priority', count(*) FILTER (priority IS NULL OR trim(priority) = '') FROM d
        UNION ALL SELECT 'year', count(*) FILTER (year IS NULL) FROM d""",
    name="null_profile",
)
def null_blank_profile(spark, sf):
    return null_profile(_dirty_orders(spark, sf))


@query(
    """WITH d AS (
         SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'N') AS flag,
                CASE WHEN l_quantity < 5 THEN ' ' ELSE l_linestatus END AS status, year(l_shipdate) AS year
         FROM lineitem),
       ok AS (SELECT * FROM d WHERE flag IS NOT NULL AND trim(status) <> ''),
       w AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                          ORDER BY year DESC, flag, status) AS rn FROM ok),
       u AS (SELECT * FROM w WHERE rn = 1)
       SELECT 'rows_in' AS step, (SELECT count(*) FROM d) AS n
       UNION ALL SELECT 'null', (SELECT count(*) FROM d WHERE flag IS NULL)
       UNION ALL SELECT 'blank', (SELECT count(*) FROM d WHERE flag IS NOT NULL AND trim(status) = '')
       UNION ALL SELECT 'duplicate', (SELECT count(*) FROM ok) - (SELECT count(*) FROM u)
       UNION ALL SELECT 'bound', (SELECT count(*) FROM u WHERE year < 1996)
       UNION ALL SELECT 'final', 0
       UNION ALL SELECT 'rows_out', (SELECT count(*) FROM u WHERE year >= 1996)""",
    name="quality_funnel",
)
def funnel(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_returnflag", F.lit("N")).alias("flag"),
        F.when(F.col("l_quantity") < 5, " ").otherwise(F.col("l_linestatus")).alias("status"),
        F.year("l_shipdate").alias("year"),
    )
    return quality_funnel(lines, ["l_orderkey", "l_linenumber"], ("year", 1996))


@query(
    """SELECT p_partkey, CASE WHEN p_name LIKE '%ring' THEN 'RING' WHEN p_name LIKE 's%ll b_lt' THEN 'SMALL BOLT'
                              WHEN p_name LIKE 'small%' THEN 'OTHER SMALL' ELSE p_name END AS p_name
       FROM part""",
    name="repair_like",
)
def repair_values(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    return repair_like(part, "p_name", [("%ring", "RING"), ("s%ll b_lt", "SMALL BOLT"), ("small%", "OTHER SMALL")])


@query(
    """SELECT p_partkey, p_type,
              CASE WHEN p_size > 25 THEN p_brand
                   WHEN p_type IN ('ECONOMY', 'SMALL') THEN 'Minor'
                   WHEN p_type IN ('LARGE', 'STANDARD') THEN 'Major' END AS brand
       FROM part"""
)
def group_fill(spark, sf):
    part = table(spark, sf, "part").select(
        "p_partkey", "p_type", F.when(F.col("p_size") > 25, F.col("p_brand")).alias("brand")
    )
    return fill_from_groups(part, "brand", "p_type", {"Minor": ["ECONOMY", "SMALL"], "Major": ["LARGE", "STANDARD"]})


@query(
    """WITH d AS (SELECT c_custkey, c_name,
                         CASE c_mktsegment WHEN 'MACHINERY' THEN NULL WHEN 'HOUSEHOLD' THEN '  '
                                           WHEN 'BUILDING' THEN 'Building' ELSE c_mktsegment END AS segment,
                         nullif(c_mktsegment, 'MACHINERY') AS other
                  FROM customer)
       SELECT c_custkey, upper(CASE WHEN segment IS NULL OR trim(segment) = '' THEN coalesce(upper(other), 'UNKNOWN')
                                    ELSE segment END) AS segment,
              CASE WHEN other IS NULL THEN 'Unspecified' ELSE other END AS other
       FROM d"""
)
def blank_fallback(spark, sf):
    seg = F.col("c_mktsegment")
    customer = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(seg == "MACHINERY", None)
        .when(seg == "HOUSEHOLD", "  ")
        .when(seg == "BUILDING", "Building")
        .otherwise(seg)
        .alias("segment"),
        F.nullif(seg, F.lit("MACHINERY")).alias("other"),
    )
    filled = fallback(customer, "segment", [F.upper("other")], "UNKNOWN", upper=True)
    return fallback(filled, "other", [], "Unspecified")


@query(
    """SELECT * EXCLUDE rn FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                    l_returnflag, l_linestatus) AS rn
         FROM lineitem) WHERE rn = 1"""
)
def dedup_key(spark, sf):
    return dedup(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], [F.desc("l_shipdate")])


@query(
    """SELECT doc_id, md5(text) AS text_md5, source, lang, n_chars FROM (
         SELECT *, row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1"""
)
def dedup_exact(spark, sf):
    # whole texts are compared by their digest, which is what moves through the shuffle
    docs = table(spark, sf, "documents").withColumn("text_md5", hash_key("text")).drop("text")
    return dedup(docs, ["text_md5", "lang"], ["doc_id"])


@query(
    """SELECT * EXCLUDE rn FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS rn
         FROM events) WHERE rn = 1""",
    name="keep_latest",
)
def latest_version(spark, sf):
    return keep_latest(table(spark, sf, "events"), ["user_id", "event_type"], "ts", ["event_id"])


@query(
    """WITH loads AS (
         SELECT s_suppkey, s_nationkey, s_acctbal, 1 AS load_seq FROM supplier
         UNION ALL SELECT s_suppkey, s_nationkey, s_acctbal + 1, 2 FROM supplier WHERE s_acctbal < 5000)
       SELECT * EXCLUDE rn FROM (
         SELECT *, row_number() OVER (PARTITION BY s_nationkey, s_suppkey ORDER BY load_seq DESC, s_acctbal) AS rn
         FROM loads) WHERE rn = 1"""
)
def keep_last_load(spark, sf):
    first = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    again = first.filter("s_acctbal < 5000").withColumn("s_acctbal", F.col("s_acctbal") + 1)
    loads = first.withColumn("load_seq", F.lit(1)).unionByName(again.withColumn("load_seq", F.lit(2)))
    return keep_latest(loads, ["s_nationkey", "s_suppkey"], "load_seq")


HOST = r"^https?://([^/]+)"
TITLE = r"<title>([^<]*)</title>"


@query(
    rf"""WITH RECURSIVE base AS (
         SELECT page_id, regexp_extract(url, '{HOST}', 1) AS host,
                lower(regexp_extract(html, '{TITLE}', 1)) AS title,
                row_number() OVER (ORDER BY page_id) AS rn
         FROM pages),
       walk AS (
         SELECT CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS page_id,
                CAST([] AS VARCHAR[]) AS hosts, CAST([] AS VARCHAR[]) AS titles
         UNION ALL
         SELECT rn, CASE WHEN free THEN page_id END,
                CASE WHEN free THEN list_append(hosts, host) ELSE hosts END,
                CASE WHEN free THEN list_append(titles, title) ELSE titles END
         FROM (SELECT b.*, w.hosts, w.titles,
                      NOT (list_contains(w.hosts, b.host) OR list_contains(w.titles, b.title)) AS free
               FROM walk w JOIN base b ON b.rn = w.rn + 1))
       SELECT b.page_id, b.host, b.title FROM walk w JOIN base b ON b.page_id = w.page_id""",
    name="dedup_either",
)
def first_of_either_key(spark, sf):
    pages = table(spark, sf, "pages").select(
        "page_id",
        F.regexp_extract("url", HOST, 1).alias("host"),
        F.lower(F.regexp_extract("html", TITLE, 1)).alias("title"),
    )
    return dedup_either(pages, ["host", "title"], ["page_id"])


@query("SELECT DISTINCT p_name FROM part WHERE p_name IS NOT NULL", name="distinct_names")
def names_in_load(spark, sf):
    return distinct_names(table(spark, sf, "part"), "p_name")


@query(
    """SELECT p_partkey, md5(p_brand) AS brand_key, md5(lower(trim(p_name))) AS name_key,
              md5(concat_ws('_', p_brand, nullif(p_type, 'ECONOMY'), p_partkey, p_size)) AS row_key
       FROM part"""
)
def hash_keys(spark, sf):
    kind = F.nullif("p_type", F.lit("ECONOMY"))
    return table(spark, sf, "part").select(
        "p_partkey",
        hash_key("p_brand").alias("brand_key"),
        hash_key("p_name", normalize=True).alias("name_key"),
        hash_key(["p_brand", kind, "p_partkey", "p_size"]).alias("row_key"),
    )


@query(
    """SELECT event_id, ts, CAST(year(ts) * 100 + month(ts) AS INTEGER) AS month,
              CAST(year(ts) AS INTEGER) AS year FROM events"""
)
def month_partition(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts")
    return with_partition_col(with_partition_col(events, "month", year_month("ts")), "year", F.year("ts"))


@query(
    """WITH l AS (SELECT l_orderkey, nullif(l_returnflag, 'N') AS flag,
                         CASE WHEN l_quantity < 5 THEN '  ' ELSE l_linestatus END AS status FROM lineitem)
       SELECT 'kept' AS column_name, count(*) FILTER (flag IS NOT NULL AND trim(status) <> '') AS n FROM l
       UNION ALL SELECT 'l_orderkey', 0 UNION ALL SELECT 'flag', count(*) FILTER (flag IS NULL) FROM l
       UNION ALL SELECT 'status', count(*) FILTER (trim(status) = '') FROM l"""
)
def final_check(spark, sf):
    """The last invariant of cleaning: rows that hold it, and what breaks it by column."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.nullif("l_returnflag", F.lit("N")).alias("flag"),
        F.when(F.col("l_quantity") < 5, "  ").otherwise(F.col("l_linestatus")).alias("status"),
    )
    kept, profile = assert_or_remove(lines)
    count = kept.agg(F.lit("kept").alias("column_name"), F.count(F.lit(1)).alias("n"))
    return count.unionByName(profile.withColumnRenamed("n_bad", "n"))


@query(
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_extendedprice = floor(l_extendedprice) THEN 0 ELSE 1 END AS n_reasons
       FROM lineitem"""
)
def conform_lossless(spark, sf):
    """Prices as whole numbers: a price that would lose its cents does not fit."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    kinds = lines.schema["l_orderkey"].dataType, lines.schema["l_linenumber"].dataType
    schema = T.StructType(
        [T.StructField("l_orderkey", kinds[0]), T.StructField("l_linenumber", kinds[1]), T.StructField("l_extendedprice", T.LongType())]
    )
    return conform(lines, schema).select("l_orderkey", "l_linenumber", F.size(REASONS).alias("n_reasons"))
