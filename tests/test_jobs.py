"""The jobs as a user starts them, one after the other over the same warehouse."""

import json
import os

from helpers import rows
from sparkwatch.__main__ import main
from sparkwatch.plans import Layout, run_batch, update_rollup, warehouse_geo, warehouse_trend
from sparkwatch.sinks import read_snapshot, write_snapshot
from sparkwatch.streaming import read_alerts, read_stats
from test_plans import AS_OF, GOLDEN, record, write_csv


def test_files_to_warehouse_to_alerts(spark, tmp_path):
    root = f"{tmp_path}/wh"
    write_csv(f"{tmp_path}/raw/a.csv", *GOLDEN, record(id_outbreak="us", iso3="USA", Country="United States"))
    main(["batch", "--raw", f"{tmp_path}/raw/*.csv", "--root", root, "--as-of", AS_OF])
    os.makedirs(f"{tmp_path}/feed")
    article = lambda t, u, d: {"title": t, "url": u, "description": d, "source": {"name": "S"}, "publishedAt": "2026-03-05T00:00:00Z"}
    with open(f"{tmp_path}/feed/a.json", "w") as f:
        f.write(json.dumps({"status": "ok", "articles": [
            article("Cholera outbreak", "u1", "in Tanzania and America"),
            article("Cholera movie", "u2", "outbreak"),
            article("Measles cases", "u3", "in the ivory coast"),
            article("CHOLERA OUTBREAK", "u4", "again"),
        ]}))
    main(["feed", "--feed", f"{tmp_path}/feed", "--out", f"{tmp_path}/topic", "--checkpoint", f"{tmp_path}/ck1"])
    main(["alerts", "--root", root, "--format", "json", "--path", f"{tmp_path}/topic/*", "--checkpoint", f"{tmp_path}/ck2"])
    main(["compact", "--root", root])
    out = Layout(root)
    alerts = read_alerts(spark, out.alerts)
    assert rows(alerts.select("title", "url")) == [("Cholera outbreak", "u1")]
    assert rows(read_stats(spark, out.alert_stats).drop("stream", "batch_id")) == [(2, 0, 0, 1, 1)]
    assert rows(read_snapshot(spark, out.alert_rollup).select("alert_count")) == [(1,)]


def test_places_of_earlier_loads_stay(spark, tmp_path):
    root = f"{tmp_path}/wh"
    write_csv(f"{tmp_path}/one/a.csv", *GOLDEN)
    write_csv(f"{tmp_path}/two/a.csv", record(id_outbreak="x", unsd_region="Changed"))
    run_batch(spark, f"{tmp_path}/one/*.csv", root, as_of=AS_OF)
    places = run_batch(spark, f"{tmp_path}/two/*.csv", root, as_of=AS_OF)["dim_location"]
    assert rows(places.select("iso3", "unsd_region", "load_seq")) == [("TZA", "AFRICA", 1), ("YEM", "CHANGED", 2)]


def test_stored_rollup_grows_with_its_rows(spark, tmp_path):
    df = spark.createDataFrame([("l1", "d1"), ("l1", "d1"), ("l2", "d1")], "location_key string, disease_key string")
    update_rollup(df, f"{tmp_path}/r", "first")
    for _ in range(2):  # a repeated batch adds nothing
        got = update_rollup(df.filter("location_key = 'l1'"), f"{tmp_path}/r", "second")
    assert rows(got) == [("l1", "d1", 4), ("l2", "d1", 1)]


def test_facts_of_an_earlier_load_stay(spark, tmp_path):
    root = f"{tmp_path}/wh"
    write_csv(f"{tmp_path}/one/a.csv", *GOLDEN)
    first = run_batch(spark, f"{tmp_path}/one/*.csv", root, as_of=AS_OF)["fact_outbreaks"].count()
    write_csv(f"{tmp_path}/two/a.csv", record(id_outbreak="new", DONs="DON-other"))
    for _ in range(2):
        facts = run_batch(spark, f"{tmp_path}/two/*.csv", root, as_of=AS_OF, scd_mode="always")["fact_outbreaks"]
        assert facts.count() == first + 1
    trend = warehouse_trend(spark, Layout(root))
    assert trend.agg({"outbreak_count": "sum"}).first()[0] == first + 1
    assert warehouse_geo(spark, Layout(root)).agg({"outbreak_count": "sum"}).first()[0] == first + 1


def test_partition_values_keep_their_type(spark, tmp_path):
    root = f"{tmp_path}/dim"
    for codes in (["002", "150"], ["002", "150", "EURO"]):
        write_snapshot(spark.createDataFrame([(c, i) for i, c in enumerate(codes)], "code string, n int"), root, ["code"])
        assert sorted(r["code"] for r in read_snapshot(spark, root).collect()) == codes
