"""Dimensions, facts and slowly changing versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwatch.functions import hash_key
from sparkwatch.operators import (
    DimSpec,
    FactSpec,
    build_dim,
    build_fact,
    expire,
    join_dim,
    load_dim_lookup,
    lookup_key,
    open_versions,
    scd2_merge,
)
from sparkwatch.operators.star import Fallback

from .registry import query, table

AS_OF = "2024-02-01 06:00:00"

LOCATION = DimSpec(
    natural_key="iso3",
    key="location_key",
    attributes=("country", "region_code", "unsd_region", "unsd_subregion"),
    fallbacks=(
        Fallback("unsd_region", ("region_code",), "UNKNOWN", upper=True),
        Fallback("unsd_subregion", (), "Unspecified"),
    ),
)
DISEASE = DimSpec(
    natural_key="disease_name",
    key="disease_key",
    attributes=("definition", "icd10_general"),
    normalize=True,
)
FACT = FactSpec(
    key="outbreak_id",
    columns={"year": "report_year", "don_id": "don_id"},
    id_columns=("location_key", "disease_key", "don_id", "report_year"),
    measure="outbreak_count",
)


def records(spark, sf):
    """Outbreak-like records from the order tables: who ordered where stands for what broke out where."""
    places = join_dim(table(spark, sf, "nation"), table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment"
    )
    rows = join_dim(join_dim(table(spark, sf, "orders"), customer, "o_custkey"), places, "n_nationkey")
    month = F.year("o_orderdate") * 100 + F.month("o_orderdate")
    return rows.select(
        F.year("o_orderdate").alias("year"),
        F.col("o_orderpriority").alias("disease_name"),
        F.col("c_mktsegment").alias("definition"),
        F.col("o_orderstatus").alias("icd10_general"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("iso3"),
        F.col("r_name").alias("region_code"),
        F.nullif("r_name", F.lit("ASIA")).alias("unsd_region"),
        F.when(F.col("r_name") != "EUROPE", F.col("n_name")).otherwise(" ").alias("unsd_subregion"),
        F.concat(F.lit("DON"), month.cast("string")).alias("don_id"),
    )


RECORDS = """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS disease_name, c_mktsegment AS definition,
       o_orderstatus AS icd10_general, n_name AS country,
       'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iso3, r_name AS region_code,
       nullif(r_name, 'ASIA') AS unsd_region,
       CASE WHEN r_name <> 'EUROPE' THEN n_name ELSE ' ' END AS unsd_subregion,
       'DON' || CAST(year(o_orderdate) * 100 + month(o_orderdate) AS VARCHAR) AS don_id
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey"""

LOCATIONS = """SELECT md5(iso3) AS location_key, iso3, country, region_code,
       upper(CASE WHEN unsd_region IS NULL OR trim(unsd_region) = '' THEN coalesce(upper(region_code), 'UNKNOWN')
                  ELSE unsd_region END) AS unsd_region,
       CASE WHEN unsd_subregion IS NULL OR trim(unsd_subregion) = '' THEN 'Unspecified'
            ELSE unsd_subregion END AS unsd_subregion
FROM (SELECT *, row_number() OVER (PARTITION BY iso3 ORDER BY country, region_code, unsd_region NULLS FIRST,
                                   unsd_subregion) AS rn FROM records WHERE iso3 IS NOT NULL) WHERE rn = 1"""

DISEASES = """SELECT md5(lower(trim(disease_name))) AS disease_key, disease_name, definition, icd10_general
FROM (SELECT *, row_number() OVER (PARTITION BY disease_name ORDER BY definition, icd10_general) AS rn
      FROM records WHERE disease_name IS NOT NULL) WHERE rn = 1"""

FACTS = f"""SELECT DISTINCT md5(concat_ws('_', location_key, disease_key, don_id, year)) AS outbreak_id,
       location_key, disease_key, year AS report_year, don_id, 1 AS outbreak_count,
       TIMESTAMP '{AS_OF}' AS ingestion_timestamp
FROM records JOIN locations USING (iso3) JOIN diseases USING (disease_name)"""

STAR = f"records AS ({RECORDS}), locations AS ({LOCATIONS}), diseases AS ({DISEASES}), facts AS ({FACTS})"


@query(
    f"""WITH {STAR}
        SELECT 'location' AS dim, location_key AS key, iso3 AS name, unsd_region AS a, unsd_subregion AS b FROM locations
        UNION ALL SELECT 'disease', disease_key, disease_name, definition, icd10_general FROM diseases"""
)
def dim_build(spark, sf):
    rows = records(spark, sf)
    location = build_dim(rows, LOCATION).select(
        F.lit("location").alias("dim"),
        F.col("location_key").alias("key"),
        F.col("iso3").alias("name"),
        F.col("unsd_region").alias("a"),
        F.col("unsd_subregion").alias("b"),
    )
    disease = build_dim(rows, DISEASE).select(
        F.lit("disease"), F.col("disease_key"), F.col("disease_name"), F.col("definition"), F.col("icd10_general")
    )
    return location.union(disease)


def star(spark, sf):
    """Location and disease dimensions and the fact of the derived records."""
    rows = records(spark, sf)
    return build_dim(rows, LOCATION), build_dim(rows, DISEASE), keyed_fact(rows)


def keyed_fact(rows):
    return build_fact(rows, [(None, LOCATION), (None, DISEASE)], FACT, AS_OF)


@query(f"WITH {STAR} SELECT * FROM facts")
def star_fact(spark, sf):
    """Fact by joining both dimensions."""
    rows = records(spark, sf)
    dims = [(build_dim(rows, LOCATION), LOCATION), (build_dim(rows, DISEASE), DISEASE)]
    return build_fact(rows, dims, FACT, AS_OF)


@query(f"WITH {STAR} SELECT * FROM facts")
def star_fact_computed_keys(spark, sf):
    """The same fact without joins, for dimensions built from the same records."""
    return keyed_fact(records(spark, sf))


def _dimension(spark, sf):
    """First load of a customer dimension, with the closed versions an earlier load left behind."""
    first = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    first = first.withColumn("customer_key", hash_key("c_name", normalize=True))
    opened = open_versions(first, "2024-01-01")
    old = opened.filter("c_nationkey < 5").withColumns(
        {"start_date": F.lit("2023-01-01").cast("date"), "end_date": F.lit("2024-01-01").cast("date"), "is_current": F.lit(0)}
    )
    return opened.unionByName(old)


def _second_load(spark, sf):
    """Building customers changed segment, those of nation 3 are not in the load, one name per nation is new."""
    customer = table(spark, sf, "customer")
    changed = customer.filter("c_nationkey <> 3").select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        F.when(F.col("c_mktsegment") == "BUILDING", "CONSTRUCTION").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    new = table(spark, sf, "nation").select(
        (-1 - F.col("n_nationkey")).cast("long").alias("c_custkey"),
        F.concat(F.lit("New in "), "n_name").alias("c_name"),
        F.col("n_nationkey").alias("c_nationkey"),
        F.lit("OTHER").alias("c_mktsegment"),
    )
    return changed.unionByName(new).withColumn("customer_key", hash_key("c_name", normalize=True))


FIRST_LOAD = """SELECT c_custkey, c_name, c_nationkey, c_mktsegment, md5(lower(trim(c_name))) AS customer_key,
       DATE '2024-01-01' AS start_date, CAST(NULL AS DATE) AS end_date, 1 AS is_current FROM customer"""
DIMENSION = f"""SELECT * FROM ({FIRST_LOAD})
UNION ALL SELECT * REPLACE (DATE '2023-01-01' AS start_date, DATE '2024-01-01' AS end_date, 0 AS is_current)
FROM ({FIRST_LOAD}) WHERE c_nationkey < 5"""
SECOND_LOAD = """SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'CONSTRUCTION' ELSE c_mktsegment END AS c_mktsegment,
       md5(lower(trim(c_name))) AS customer_key FROM customer WHERE c_nationkey <> 3
UNION ALL SELECT CAST(-1 - n_nationkey AS BIGINT), 'New in ' || n_name, n_nationkey, 'OTHER', md5(lower(trim('New in ' || n_name))) FROM nation"""
SCD = f"dim AS ({DIMENSION}), load AS ({SECOND_LOAD})"


@query(FIRST_LOAD)
def scd2_open(spark, sf):
    first = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return open_versions(first.withColumn("customer_key", hash_key("c_name", normalize=True)), "2024-01-01")


@query(
    f"""WITH {SCD}
        SELECT * EXCLUDE (hit) REPLACE (CASE WHEN hit THEN 0 ELSE is_current END AS is_current,
                          CASE WHEN hit THEN DATE '2024-02-01' ELSE end_date END AS end_date)
        FROM (SELECT *, is_current = 1 AND c_name IN (SELECT c_name FROM load) AS hit FROM dim)"""
)
def scd2_expire(spark, sf):
    return expire(_dimension(spark, sf), _second_load(spark, sf), "c_name", AS_OF)


def _merge_sql(replaced: str) -> str:
    return f"""WITH {SCD},
        cur AS (SELECT d.*, l.c_name IS NOT NULL AND ({replaced}) AS replaced
                FROM dim d LEFT JOIN load l ON d.c_name = l.c_name WHERE d.is_current = 1)
        SELECT * FROM dim WHERE is_current <> 1
        UNION ALL
        SELECT * EXCLUDE (replaced) REPLACE (CASE WHEN replaced THEN 0 ELSE is_current END AS is_current,
                          CASE WHEN replaced THEN DATE '2024-02-01' ELSE end_date END AS end_date) FROM cur
        UNION ALL
        SELECT c_custkey, c_name, c_nationkey, c_mktsegment, customer_key, DATE '2024-02-01', NULL, 1
        FROM load WHERE c_name NOT IN (SELECT c_name FROM cur WHERE NOT replaced)"""


@query(_merge_sql("d.c_mktsegment IS DISTINCT FROM l.c_mktsegment OR d.c_nationkey IS DISTINCT FROM l.c_nationkey"), name="scd2_merge")
def scd2_on_change(spark, sf):
    return scd2_merge(
        _dimension(spark, sf), _second_load(spark, sf), "c_name", ["c_mktsegment", "c_nationkey"], AS_OF
    )


@query(_merge_sql("true"))
def scd2_merge_always(spark, sf):
    return scd2_merge(
        _dimension(spark, sf), _second_load(spark, sf), "c_name", ["c_mktsegment"], AS_OF, mode="always"
    )


@query(f"WITH dim AS ({DIMENSION}) SELECT c_name, customer_key FROM dim WHERE is_current = 1")
def dim_lookup(spark, sf):
    return load_dim_lookup(_dimension(spark, sf), "c_name", "customer_key", current_only=True)


NORMALIZED = "trim(regexp_replace(upper({}), '[^A-Z0-9''\\-]+', ' ', 'g'))"


@query(
    f"""WITH dim AS (SELECT {NORMALIZED.format("p_name")} AS norm, max(p_name) AS name FROM part
                     WHERE p_name NOT LIKE 'red%' GROUP BY 1)
        SELECT p.p_partkey, md5(lower(trim(dim.name))) AS part_key
        FROM part p LEFT JOIN dim ON {NORMALIZED.format("replace(p.p_name, ' ', ' (?) ') || '!'")} = dim.norm"""
)
def norm_lookup(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    dim = part.filter(~F.col("p_name").like("red%")).select("p_name").distinct()
    dim = dim.withColumn("part_key", hash_key("p_name", normalize=True))
    messy = F.concat(F.replace("p_name", F.lit(" "), F.lit(" (?) ")), F.lit("!"))
    return lookup_key(part, messy, dim, "p_name", "part_key", "part_key").select("p_partkey", "part_key")
