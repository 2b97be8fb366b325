import datetime as dt
import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from helpers import rows
from sparkwatch.functions import Lexicon, Pattern, hash_key
from sparkwatch.operators import build_rollup, enrich_alerts, outcome_stats
from sparkwatch.operators.alerts import EntityRules, resolve_events
from sparkwatch.sinks import read_snapshot
from sparkwatch.sources import EventSource, decode_json, read_event_stream, read_events, stream_article_feed
from sparkwatch.streaming import AlertSink, compact_alerts, dedup_stream, read_alerts, read_rollup, read_stats, start_alerts, start_feed

AS_OF = "2024-02-01 00:00:00"
DISEASES = EntityRules(
    Lexicon.of("bird flu", "cholera", "tb", canonical={"tb": "TUBERCULOSIS"}),
    patterns=(Pattern(("yellow", "fever"), "DISEASE"),),
    label="DISEASE",
)
COUNTRIES = EntityRules(
    Lexicon.of("yemen", "uk", "texas", "lagos"),
    mapping={"uk": "UNITED KINGDOM"},
    members=("TEXAS",),
    member_value="UNITED STATES",
)

EVENTS = [
    ("Cholera in Yemen", None, "s1", "2024-01-05T10:00:00Z", "u1"),
    ("Cholera in Yemen", None, "s1", "2024-01-06T10:00:00Z", "u1b"),
    ("Cholera in Yemen", None, "s2", "zz", "u2"),
    ("Outbreak in the UK", "yellow  fever", "s1", "2024-01-05T10:00:00+02:00", "u3"),
    ("tb case", "in Texas", "s1", None, "u4"),
    ("tb case", "in Lagos", "s3", None, "u5"),
    ("nothing here", "in Yemen", "s3", None, "u6"),
    ("cholera somewhere", None, "s3", None, "u7"),
    (None, None, None, None, None),
]


@pytest.fixture(scope="module")
def dims(spark):
    diseases = spark.createDataFrame([("CHOLERA",), ("TUBERCULOSIS",), ("YELLOW FEVER",)], "disease_name string")
    locations = spark.createDataFrame([("YEMEN",), ("UNITED KINGDOM",), ("UNITED STATES",)], "country string")
    return (
        diseases.withColumn("disease_key", hash_key("disease_name", normalize=True)),
        locations.withColumn("location_key", hash_key("country")),
    )


def put(folder, name, events):
    os.makedirs(folder, exist_ok=True)
    names = ("title", "description", "source", "published_at", "url")
    with open(f"{folder}/{name}", "w") as f:
        for e in events:
            f.write(json.dumps({"key": e[0], "value": json.dumps(dict(zip(names, e)))}) + "\n")


def sink(dims, root, stream=None):
    return AlertSink(
        f"{root}/alerts", f"{root}/stats", lambda: dims[0], lambda: dims[1], DISEASES, COUNTRIES, AS_OF,
        rollup_path=f"{root}/rollup", stream=stream,
    )


def run(spark, dims, root):
    source = EventSource("json", path=f"{root}/topic")
    start_alerts(spark, source, sink(dims, root), f"{root}/ck", trigger=None).awaitTermination()


def test_a_batch_is_written_by_as_many_tasks_as_its_bytes_fill(spark, dims, tmp_path):
    text = "cholera in yemen " + "x" * 1_000
    rows = [(f"{text} {i}", None, "s", "2024-01-05", f"u{i}") for i in range(64)]
    batch = spark.createDataFrame(rows, "title string, description string, source string, published_at string, url string")
    wide, small = (replace(sink(dims, f"{tmp_path}/{n}", n), file_bytes=n_bytes) for n, n_bytes in (("wide", 1 << 20), ("small", 1 << 13)))
    wide(batch, 0)
    small(batch, 0)
    files = [spark.read.parquet(f"{tmp_path}/{n}/alerts").groupBy(F.input_file_name()).count().collect() for n in ("wide", "small")]
    assert len(files[0]) == 1 and files[0][0]["count"] == 64
    assert len(files[1]) > 4 and max(r["count"] for r in files[1]) < 32 and sum(r["count"] for r in files[1]) == 64


def test_outcomes_in_order_and_nothing_lost(spark, dims):
    df = spark.createDataFrame(EVENTS, "title string, description string, source string, published_at string, url string")
    resolved = resolve_events(df, *dims, DISEASES, COUNTRIES)
    assert outcome_stats(resolved).first().asDict() == {
        "total": 8, "no_disease": 2, "no_country": 1, "no_keys": 1, "inserted": 4,
    }
    alerts = {r["url"]: r for r in enrich_alerts(df, *dims, DISEASES, COUNTRIES, AS_OF).collect()}
    assert set(alerts) == {"u1", "u2", "u3", "u4"}
    assert alerts["u2"]["published_at_imputed"] and alerts["u2"]["published_at"] == dt.datetime(2024, 2, 1)
    assert alerts["u3"]["published_at"] == dt.datetime(2024, 1, 5, 8)


def test_stream_equals_batch_and_restart_adds_nothing(spark, dims, tmp_path):
    root = str(tmp_path)
    put(f"{root}/topic", "a.json", EVENTS)
    run(spark, dims, root)
    batch = decode_json(read_events(spark, EventSource("json", path=f"{root}/topic")))
    expected = rows(enrich_alerts(batch, *dims, DISEASES, COUNTRIES, AS_OF).select("alert_id", "published_at", "url"))
    got = read_alerts(spark, f"{root}/alerts")
    assert rows(got.select("alert_id", "published_at", "url")) == expected
    assert rows(read_stats(spark, f"{root}/stats").drop("stream")) == [(8, 2, 1, 1, 4, 0)]
    run(spark, dims, root)  # restart from the checkpoint, nothing new
    assert read_alerts(spark, f"{root}/alerts").count() == 4
    put(f"{root}/topic", "b.json", EVENTS[:1])
    run(spark, dims, root)
    assert read_alerts(spark, f"{root}/alerts").count() == 5
    compact_alerts(spark, f"{root}/alerts", f"{root}/compact")
    assert read_snapshot(spark, f"{root}/compact").count() == 4


def test_replayed_batch_replaces_itself(spark, dims, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame(EVENTS, "title string, description string, source string, published_at string, url string")
    with pytest.raises(ValueError):
        sink(dims, root)(df, 7)
    write = sink(dims, root, "s")
    for _ in range(2):
        write(df, 7)
    alerts = read_alerts(spark, f"{root}/alerts")
    assert alerts.count() == 4 and alerts.select("alert_id").distinct().count() == 4
    write(df.filter("url = 'u6'"), 8)  # a batch without alerts
    write(df.filter("url = 'u2'"), 9)
    assert rows(read_rollup(spark, f"{root}/rollup")) == rows(
        build_rollup(read_alerts(spark, f"{root}/alerts"), ["location_key", "disease_key"])
    )
    assert read_alerts(spark, f"{root}/alerts").filter("batch_id < 9").count() == 4
    assert read_stats(spark, f"{root}/stats").filter("batch_id = 8").first()["no_disease"] == 1


def test_enrichment_runs_directly_on_a_stream(spark, dims, tmp_path):
    root = str(tmp_path)
    put(f"{root}/topic", "a.json", EVENTS)
    events = decode_json(read_event_stream(spark, EventSource("json", path=f"{root}/topic", max_per_trigger=1)))
    alerts = enrich_alerts(events, *dims, DISEASES, COUNTRIES, AS_OF, dedup_first=False)
    query = alerts.writeStream.format("parquet").option("checkpointLocation", f"{root}/ck")
    query.trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == 5


def test_dedup_stream_drops_repeats_across_batches(spark, tmp_path):
    root = str(tmp_path)
    put(f"{root}/topic", "a.json", EVENTS[:1])
    put(f"{root}/topic", "b.json", EVENTS[:2])
    events = decode_json(read_event_stream(spark, EventSource("json", path=f"{root}/topic", max_per_trigger=1)))
    events = events.withColumn("at", F.col("published_at").cast("timestamp"))
    query = dedup_stream(events, ["title", "source"], "at", "7 days").writeStream.format("parquet")
    query = query.option("checkpointLocation", f"{root}/ck").trigger(availableNow=True)
    query.start(f"{root}/out").awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == 1


def test_feed_stream_filters_dedups_and_publishes(spark, tmp_path):
    root = str(tmp_path)
    os.makedirs(f"{root}/feed")
    article = lambda t, u, d="outbreak": {"title": t, "description": d, "url": u, "source": {"name": "N"}}
    payload = {
        "status": "ok",
        "articles": [
            article(" Cholera ", "u1"), article("CHOLERA", "u2"), article("Cholera again", "u2"),
            article("Cholera concert", "u3"), article("  ", "u4"), article("Cholera", None), article("Malaria", "u5", "none"),
        ],
    }
    with open(f"{root}/feed/a.json", "w") as f:
        f.write(json.dumps(payload))
    articles = stream_article_feed(spark, f"{root}/feed")
    start_feed(
        articles, ["concert"], [["cholera", "malaria"], ["outbreak"]], f"{root}/ck", path=f"{root}/topic", as_of=AS_OF
    ).awaitTermination()
    events = read_events(spark, EventSource("json", path=f"{root}/topic/*-0"))
    got = {tuple(r) for r in decode_json(events).select("title", "url", "source").collect()}
    assert got == {("Cholera", "u1", "N"), ("Cholera again", "u2", "N")} and events.count() == 2


def test_a_new_checkpoint_takes_nothing_away(spark, dims, tmp_path):
    root = str(tmp_path)
    put(f"{root}/topic", "a.json", EVENTS)
    run(spark, dims, root)
    source = EventSource("json", path=f"{root}/topic")
    start_alerts(spark, source, sink(dims, root), f"{root}/other", trigger=None).awaitTermination()
    alerts = read_alerts(spark, f"{root}/alerts")
    assert alerts.count() == 8 and alerts.select("stream").distinct().count() == 2
    assert read_stats(spark, f"{root}/stats").count() == 2


def test_compaction_reads_new_batches_only(spark, dims, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame(EVENTS, "title string, description string, source string, published_at string, url string")
    df = df.filter("url <> 'u1b'")
    write = sink(dims, root, "s")
    write(df.filter("url = 'u1'"), 0)
    compact_alerts(spark, f"{root}/alerts", f"{root}/compact")
    write(df.filter("url <> 'u1'"), 1)
    compact_alerts(spark, f"{root}/alerts", f"{root}/compact", retire=True)
    assert read_alerts(spark, f"{root}/alerts").select("batch_id").distinct().count() == 1  # batch 0 is retired
    write(df.filter("url = 'u2'"), 2)
    compact_alerts(spark, f"{root}/alerts", f"{root}/compact", retire=True)
    assert rows(read_snapshot(spark, f"{root}/compact").select("url")) == [("u1",), ("u2",), ("u3",), ("u4",)]


def test_repeats_across_batches_can_be_dropped(spark, dims, tmp_path):
    root = str(tmp_path)
    for name in ("a.json", "b.json"):
        put(f"{root}/topic", name, EVENTS)
        source = EventSource("json", path=f"{root}/topic")
        start_alerts(spark, source, sink(dims, root), f"{root}/ck", trigger=None, dedup_delay="3650 days").awaitTermination()
    assert read_alerts(spark, f"{root}/alerts").count() == 4
