"""Sources, sinks and the batch job, with the two golden records worked out from the key formulas."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from sparkwatch.operators import build_dim, build_fact
from sparkwatch.plans import DISEASE_DIM, FACT, LOCATION_DIM, RAW_SCHEMA, CleaningRules, Layout, clean, ingest, run_batch
from sparkwatch.plans.outbreaks import RAW_COLUMNS, cleaning_funnel
from sparkwatch.sinks import append_table, bloom_options, cluster_by, insert_new, publish, read_snapshot, to_events, write_layer, write_snapshot
from sparkwatch.sources import EventSource, decode_json, load_lexicon, load_patterns, read_article_feed, read_events, read_layer, read_raw_csv

HEADER = ",".join(RAW_COLUMNS)
GOLDEN = [
    "2026YEM,2026,x,Cholera,Cholera,A00,A00,A00,Cholera,A bacterial disease,Yemen,YE,YEM,Asia,Western Asia,Eastern Mediterranean Region,DON2028",
    "2026TZA,2026,x,COVID-19,COVID-19,U07,U07,U071,COVID-19,Infectious disease,Tanzania,TZ,TZA,Africa,Eastern Africa,African Region,DON2029",
]
AS_OF = "2026-03-01 02:00:00"


def write_csv(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join([HEADER, *lines]))


def test_golden_records_through_all_layers(spark, tmp_path):
    write_csv(f"{tmp_path}/raw/a.csv", GOLDEN[0])
    write_csv(f"{tmp_path}/raw/b.csv", GOLDEN[1])
    tables = run_batch(spark, f"{tmp_path}/raw/*.csv", f"{tmp_path}/wh", as_of=AS_OF)
    assert rows(tables["dim_location"].select("location_key", "iso3", "country", "region_code", "unsd_region", "unsd_subregion")) == [
        ("2c4717590716f8e463fe745916ec41b5", "YEM", "YEMEN", "EASTERN MEDITERRANEAN REGION", "ASIA", "WESTERN ASIA"),
        ("e31c59b78ddd142d37b69f1de291eb69", "TZA", "TANZANIA", "AFRICAN REGION", "AFRICA", "EASTERN AFRICA"),
    ]
    assert rows(tables["dim_disease"].select("disease_key", "disease_name", "start_date", "end_date", "is_current")) == [
        ("5b7f9fa40bdc12072249204cedfa7808", "COVID-19", dt.date(2026, 3, 1), None, 1),
        ("c8c074a9f69fe9406736389ac8d50915", "CHOLERA", dt.date(2026, 3, 1), None, 1),
    ]
    assert rows(tables["fact_outbreaks"].select("outbreak_id", "report_year", "don_id", "outbreak_count")) == [
        ("0ac68e875e4357d29e17604304c495c6", 2026, "DON2028", 1),
        ("2409e295efb531aac7d1afa0c873d709", 2026, "DON2029", 1),
    ]
    metrics = spark.read.parquet(f"{tmp_path}/wh/metrics").filter("stage = 'silver' and number is not null")
    assert {r["metric"]: r["number"] for r in metrics.collect()} == {
        "rows_in": 2, "null": 0, "blank": 0, "duplicate": 0, "bound": 0, "final": 0, "rows_out": 2, "total_dropped": 0,
    }
    silver = read_layer(spark, Layout(f"{tmp_path}/wh").silver)
    assert sorted(silver.columns) == sorted(
        ["outbreak_id", "disease_name", "definition", "icd10_general", "icd104_specific", "country", "iso3", "region_code",
         "unsd_region", "unsd_subregion", "don_id", "source_file", "ingestion_date", "cleaning_timestamp", "outbreak_count", "year"]
    )
    assert {os.path.basename(r[0]) for r in silver.select("source_file").collect()} == {"a.csv", "b.csv"}


def test_repeated_batch_changes_nothing(spark, tmp_path):
    write_csv(f"{tmp_path}/raw/a.csv", *GOLDEN)
    first = run_batch(spark, f"{tmp_path}/raw/*.csv", f"{tmp_path}/wh", as_of=AS_OF)
    before = {n: rows(df) for n, df in first.items()}
    again = run_batch(spark, f"{tmp_path}/raw/*.csv", f"{tmp_path}/wh", as_of="2026-04-01 02:00:00")
    assert rows(again["dim_disease"]) == before["dim_disease"]
    assert rows(again["fact_outbreaks"].select("outbreak_id")) == sorted((r[0],) for r in before["fact_outbreaks"])
    always = run_batch(spark, f"{tmp_path}/raw/*.csv", f"{tmp_path}/wh", as_of="2026-05-01 02:00:00", scd_mode="always")
    assert rows(always["dim_disease"].groupBy("disease_name", "is_current").count()) == [
        ("CHOLERA", 0, 1), ("CHOLERA", 1, 1), ("COVID-19", 0, 1), ("COVID-19", 1, 1),
    ]


def record(**values):
    base = dict(zip(RAW_COLUMNS, GOLDEN[0].split(",")))
    base.update(values)
    return ",".join("" if base[c] is None else f'"{base[c]}"' for c in RAW_COLUMNS)


def test_ingest_and_clean_edge_cases(spark, tmp_path):
    write_csv(
        f"{tmp_path}/raw/a.csv",
        record(id_outbreak="no-iso", iso3=None),
        record(id_outbreak="bad-year", Year="n/a"),
        record(id_outbreak="blank", Definition="   "),
        record(id_outbreak="old", Year="1995"),
        record(id_outbreak="edge", Year="1996"),
        record(id_outbreak="ivory", Country="Côte d'Ivoire"),
        record(id_outbreak="twice", Year="1990"),
        record(id_outbreak="twice", Year="2001"),
        record(id_outbreak="filled", Country="Aruba", who_region=None),
        record(id_outbreak="unfilled", who_region=None),
    )
    bronze = ingest(read_raw_csv(spark, f"{tmp_path}/raw/*.csv", RAW_SCHEMA), AS_OF)
    assert "no-iso" not in {r[0] for r in bronze.select("outbreak_id").collect()} and bronze.count() == 8
    assert bronze.filter("outbreak_id = 'blank'").first()["definition"] == ""
    silver = {r["outbreak_id"]: r for r in clean(bronze, as_of=AS_OF).collect()}
    assert set(silver) == {"edge", "ivory", "twice", "filled"}
    assert silver["ivory"]["country"] == "COTE D'IVOIRE" and silver["twice"]["year"] == 2001
    assert silver["filled"]["region_code"] == "AMERICAS"
    legacy = CleaningRules(legacy_order=True)
    assert {r["outbreak_id"] for r in clean(bronze, legacy, AS_OF).collect()} == {"edge", "ivory", "twice"}
    assert dict(rows(cleaning_funnel(bronze))) == {
        "rows_in": 8, "null": 1, "blank": 1, "duplicate": 1, "bound": 1, "final": 0, "rows_out": 4,
    }
    assert dict(rows(cleaning_funnel(bronze, legacy)))["rows_out"] == 3
    with pytest.raises(ValueError):
        CleaningRules(repairs=(("X%", " "),))


def test_joined_and_computed_facts_agree(spark, tmp_path):
    write_csv(f"{tmp_path}/raw/a.csv", *GOLDEN, record(id_outbreak="again"))
    silver = clean(ingest(read_raw_csv(spark, f"{tmp_path}/raw/a.csv", RAW_SCHEMA), AS_OF), as_of=AS_OF)
    dims = [(build_dim(silver, LOCATION_DIM), LOCATION_DIM), (build_dim(silver, DISEASE_DIM), DISEASE_DIM)]
    joined = build_fact(silver, dims, FACT, AS_OF)
    computed = build_fact(silver, [(None, s) for _, s in dims], FACT, AS_OF)
    assert rows(joined) == rows(computed) and joined.count() == 2
    assert "Join" not in plan(computed)
    assert "BroadcastHashJoin" in plan(joined)
    # a dimension given from elsewhere still filters
    assert build_fact(silver, [(dims[0][0].filter("iso3 = 'YEM'"), LOCATION_DIM), dims[1]], FACT, AS_OF).count() == 1


def test_scan_reads_only_what_is_needed(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 5).alias("year"), F.lit("x").alias("wide"))
    write_layer(df, f"{tmp_path}/layer", ["year"])
    text = plan(read_layer(spark, f"{tmp_path}/layer").filter("year = 3 and id > 7").select("id"))
    assert "ReadSchema: struct<id:bigint>" in text and "PartitionFilters: [isnotnull(year" in text
    assert "GreaterThan(id,7)" in text


def test_cleaning_pushes_null_tests_and_shuffles_once(spark, tmp_path):
    write_csv(f"{tmp_path}/raw/a.csv", *GOLDEN)
    write_layer(ingest(read_raw_csv(spark, f"{tmp_path}/raw/a.csv", RAW_SCHEMA), AS_OF), f"{tmp_path}/bronze", ["year"])
    text = plan(clean(read_layer(spark, f"{tmp_path}/bronze"), as_of=AS_OF))
    assert "PushedFilters: [IsNotNull(outbreak_id), IsNotNull(disease_name)" in text
    assert text.count("Exchange") == 1 and text.count("WindowGroupLimit") == 2


def test_dynamic_overwrite_replaces_only_its_partitions(spark, tmp_path):
    path = f"{tmp_path}/layer"
    write_layer(spark.createDataFrame([(1, 2000), (2, 2001)], "v int, year int"), path, ["year"])
    write_layer(spark.createDataFrame([(9, 2001)], "v int, year int"), path, ["year"], dynamic=True)
    assert rows(read_layer(spark, path)) == [(1, 2000), (9, 2001)]
    write_layer(spark.createDataFrame([(5, 2002)], "v int, year int"), path, ["year"])
    assert rows(read_layer(spark, path)) == [(5, 2002)]


def test_hot_partition_is_split_when_written(spark, tmp_path):
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(60000).select(
            F.md5(F.col("id").cast("string")).alias("v"), F.when(F.col("id") < 50000, 2000).otherwise(2001).alias("year")
        ).repartition(4)
        write_layer(df, f"{tmp_path}/layer", ["year"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    hot = [f for f in os.listdir(f"{tmp_path}/layer/year=2000") if f.endswith(".parquet")]
    assert len(hot) > 1
    assert read_layer(spark, f"{tmp_path}/layer").count() == 60000


def test_cluster_by_splits_one_hot_value(spark):
    df = spark.range(1000).select(F.lit("same").alias("k"), "id")
    parts = cluster_by(df, ["k"], spread=["id"], partitions=4)
    sizes = parts.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 1 and max(r[1] for r in sizes) < 1000


def test_snapshots_and_insert_new(spark, tmp_path):
    root = f"{tmp_path}/dim"
    assert read_snapshot(spark, root) is None
    write_snapshot(spark.range(3).toDF("id"), root, options=bloom_options(["id"], 100))
    write_snapshot(read_snapshot(spark, root).filter("id > 0"), root)
    os.makedirs(f"{root}/v=00000003")  # a write that never finished
    assert rows(read_snapshot(spark, root)) == [(1,), (2,)]
    path = f"{tmp_path}/fact"
    append_table(spark.createDataFrame([("a", 1)], "k string, y int"), path=path)
    load = spark.createDataFrame([("a", 1), ("b", 1)], "k string, y int")
    for _ in range(2):
        append_table(insert_new(load, read_layer(spark, path), "k", "y"), path=path)
    assert rows(read_layer(spark, path)) == [("a", 1), ("b", 1)]
    with pytest.raises(ValueError):
        append_table(load)


def test_insert_new_reads_the_partitions_of_the_load_only(spark, tmp_path):
    path = f"{tmp_path}/fact"
    stored = spark.createDataFrame([(f"k{i}", i % 5) for i in range(20)], "k string, y int")
    assert append_table(stored, path=path, partition_by=["y"]) == 20
    load = spark.createDataFrame([("k1", 1), ("new", 1), ("new", 1), (None, 1), (None, 1)], "k string, y int")
    fresh = insert_new(load, read_layer(spark, path), "k", "y")
    assert rows(fresh) == [("new", 1), (None, 1), (None, 1)]
    text = plan(fresh)
    filters = text[text.index("PartitionFilters") :].split("]")[0]
    assert "1" in filters and ("y#" in filters)


def test_events_round_trip_and_count(spark, tmp_path):
    df = spark.createDataFrame(
        [("T", None, "c", "a", "s", "2024-01-01T00:00:00Z", "u")],
        "title string, description string, content string, author string, source string, published_at string, url string",
    )
    events = to_events(df, as_of="2024-02-01 00:00:00")
    key, value = events.first()
    assert key == "T" and '"description":null' in value and '"language":"en"' in value
    assert '"ingestion_time":"2024-02-01T00:00:00.000000Z"' in value
    assert publish(events, path=f"{tmp_path}/topic") == 1
    back = decode_json(read_events(spark, EventSource("json", path=f"{tmp_path}/topic")))
    assert rows(back) == [("T", None, "s", "2024-01-01T00:00:00Z", "u")]
    bad = spark.createDataFrame([("not json",), ('{"title": "x", "more": 1}',)], "value string")
    assert rows(decode_json(bad)) == sorted([(None,) * 5, ("x", None, None, None, None)], key=repr)


def test_kafka_options_are_complete():
    source = EventSource(servers="h:9092", topic="alerts", max_per_trigger=10)
    assert source.reader_options(streaming=True) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "alerts", "startingOffsets": "latest", "maxOffsetsPerTrigger": "10",
    }
    with pytest.raises(ValueError):
        EventSource().reader_options(streaming=True)


def test_article_feed(spark, tmp_path):
    os.makedirs(f"{tmp_path}/feed")
    with open(f"{tmp_path}/feed/a.json", "w") as f:
        f.write('{"status":"ok","articles":[{"title":"A","source":{"name":"N"},"url":"u","publishedAt":"p","x":1},{"title":"B"}]}\n')
        f.write('{"status":"error","articles":[{"title":"C"}]}\n{"status":"ok"}\nbroken\n')
    got = read_article_feed(spark, f"{tmp_path}/feed").select("feed_position", "title", "source", "url", "published_at")
    assert rows(got) == [(0, "A", "N", "u", "p"), (1, "B", None, None, None)]


def test_lexicon_tables(spark):
    table = spark.createDataFrame([("Flu", 1, "INFLUENZA"), ("TB", 0, None)], "term string, priority int, canonical string")
    places = spark.createDataFrame([("uk", 0)], "term string, priority int")
    lex = load_lexicon(table, places)
    assert lex.words == ["tb", "flu", "uk"] and lex.mapping == {"flu": "INFLUENZA"}
    with pytest.raises(ValueError):
        load_lexicon(table, max_terms=1)
    patterns = load_patterns(spark.createDataFrame([("Bird Flu", "DISEASE")], "term string, label string"))
    assert patterns[0].tokens == ("bird", "flu")
