"""Dedup across runs, compaction by month and clustered files."""

from __future__ import annotations

import random

import pyarrow.parquet as pq
import pytest
from helpers import rows
from pyspark.sql import functions as F

from sparkwatch.sinks import cluster_by, clustered_files, dedup_across_runs, read_snapshot, write_layer
from sparkwatch.sinks.snapshots import expire_snapshots, list_folders, snapshot_parts, write_snapshot
from sparkwatch.streaming import compact_alerts, read_compacted_rollup
from sparkwatch.streaming.alerts import ALERT_MONTH, ALERT_SCHEMA, ROLLUP_DIMS, touched_months


def greedy(runs):
    taken, out = (set(), set()), []
    for run in runs:
        for i, a, b in run:
            if a not in taken[0] and b not in taken[1]:
                taken[0].add(a)
                taken[1].add(b)
                out.append(i)
    return sorted(out)


def test_dedup_across_runs_equals_the_greedy_loop(spark, tmp_path):
    """Three runs that share either key, nulls as values, a hot key; a run may be repeated, also after a later one."""
    rng = random.Random(7)
    runs = [[(100 * r + i, rng.choice((None, "hot", *map(str, range(40)))), str(rng.randint(0, 45))) for i in range(60)] for r in range(3)]

    def accepted(r):
        frame = spark.createDataFrame(runs[r], "i int, a string, b string")
        return dedup_across_runs(frame, ["a", "b"], ["i"], f"{tmp_path}/keys", f"{r:03d}").select("i")

    first = [rows(accepted(r)) for r in range(3)]
    assert sorted(i for part in first for (i,) in part) == greedy(runs)
    assert [rows(accepted(r)) for r in (1, 0, 2)] == [first[1], first[0], first[2]]
    stored = spark.read.parquet(f"{tmp_path}/keys")
    assert stored.count() == 2 * len(greedy(runs))
    assert rows(dedup_across_runs(spark.createDataFrame([], "i int, a string, b string"), ["a", "b"], ["i"], f"{tmp_path}/keys", "003")) == []


def alerts(spark, path, batch, data):
    """A batch as the sink writes it: (id, source, month, day, ingestion day)."""
    day = "to_timestamp(concat('2024-', lpad(month, 2, '0'), '-', lpad(day, 2, '0')))"
    frame = spark.createDataFrame(data, "alert_id string, source string, month int, day int, taken int").selectExpr(
        "alert_id", "'d' AS disease_key", "source AS location_key", f"{day} AS published_at", "date_add('2024-05-01', taken)::timestamp AS ingestion_time",
        "alert_id AS title", "source", "alert_id AS url", "false AS published_at_imputed", f"(202400 + month)::int AS {ALERT_MONTH}", "'good' AS outcome",
    )
    write_layer(frame, f"{path}/stream=s/batch_id={batch}", ["outcome", ALERT_MONTH])


def test_only_touched_months_are_read_and_written(spark, tmp_path):
    path, out, rollup = f"{tmp_path}/alerts", f"{tmp_path}/latest", f"{tmp_path}/rollup"
    batches = [
        [("a1", "s1", 1, 5, 0), ("a2", "s1", 2, 5, 0), ("a3", "s2", 3, 1, 0), ("a4", "s2", 1, 5, 0)],
        [("b1", "s1", 2, 5, 1), ("b2", "s3", 2, 7, 1)],
        [("c1", "s1", 2, 5, 0), ("c2", "s3", 3, 7, 2), ("c3", "s3", 2, 7, 2)],
        [("d1", "s9", 4, 1, 3)],
    ]
    expected: dict = {}
    for n, batch in enumerate(batches):
        alerts(spark, path, n, batch)
        fresh = [f"stream=s/batch_id={n}"]
        merged, old, parts = touched_months(spark, path, out, fresh)
        months = {f"{ALERT_MONTH}={202400 + r[2]}" for r in batch}
        before = snapshot_parts(spark, out, ALERT_MONTH)
        read = [f for f in (old.inputFiles() if old is not None else [])]
        assert all(any(m in f for m in months) for f in read) and bool(read) == bool(months & set(before))
        compact_alerts(spark, path, out, rollup=rollup, retire=True)
        now = snapshot_parts(spark, out, ALERT_MONTH)
        assert {m for m in now if now[m] != before.get(m)} == months
        assert set(list_folders(spark, f"{out}/v={n + 1:08d}", ALERT_MONTH)) == months
        for r in batch:
            key = r[1:4]
            if key not in expected or (r[4], [-ord(c) for c in r[0]]) > (expected[key][4], [-ord(c) for c in expected[key][0]]):
                expected[key] = r
        latest = read_snapshot(spark, out)
        assert rows(latest.select("alert_id")) == sorted((r[0],) for r in expected.values())
        assert latest.columns == [f.name for f in ALERT_SCHEMA.fields if f.name not in ("stream", "batch_id")]
        counted = latest.groupBy(*ROLLUP_DIMS).agg(F.count(F.lit(1)).alias("alert_count"))
        assert rows(read_compacted_rollup(spark, out, rollup)) == rows(counted)
    # January was never written again, though its version is long expired
    assert now[f"{ALERT_MONTH}=202401"] == "v=00000001" and len(list_folders(spark, rollup, "v=")) == 2
    assert list_folders(spark, f"{out}/v=00000001", ALERT_MONTH) == [f"{ALERT_MONTH}=202401"]


def test_a_rollup_that_starts_later_and_an_old_snapshot(spark, tmp_path):
    path, out, rollup = f"{tmp_path}/alerts", f"{tmp_path}/latest", f"{tmp_path}/rollup"
    alerts(spark, path, 0, [("a1", "s1", 1, 5, 0), ("a2", "s2", 2, 5, 0)])
    whole = spark.read.schema(ALERT_SCHEMA).option("basePath", path).parquet(f"{path}/stream=s/batch_id=0").drop("stream", "batch_id", "outcome")
    write_snapshot(whole, out, [ALERT_MONTH], note=["stream=s/batch_id=0"])  # written as a whole
    assert read_compacted_rollup(spark, out, rollup) is None
    alerts(spark, path, 1, [("b1", "s1", 1, 5, 1), ("b2", "s1", 1, 6, 1)])
    compact_alerts(spark, path, out, keep=1, rollup=rollup)
    assert rows(read_snapshot(spark, out).select("alert_id")) == [("a2",), ("b1",), ("b2",)]
    assert rows(read_compacted_rollup(spark, out, rollup)) == [("s1", "d", 2), ("s2", "d", 1)]


def test_expiry_keeps_at_least_one(spark, tmp_path):
    with pytest.raises(ValueError):
        expire_snapshots(spark, str(tmp_path), 0)


def groups_read(folder, column, value):
    """(row groups that a look-up has to read, all row groups) by the statistics of the files."""
    hit = total = 0
    for file in folder.rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        i = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(i).statistics
            total += 1
            hit += s.min <= value <= s.max
    return hit, total


def test_clustered_files_read_less(spark, tmp_path):
    """A hot year is cut into several files; a look-up reads few row groups, of an unsorted copy nearly all."""
    df = spark.range(20_000).selectExpr("md5(id::string) AS key", "if(id % 10 < 8, 2020, 2000 + id % 7)::int AS year", "id").repartition(8)
    small = {"parquet.block.size": "20000", "parquet.page.row.count.limit": "200", "parquet.block.row.count.limit": "500"}
    write_layer(clustered_files(df, ["year"], ["key"], file_bytes=200_000), f"{tmp_path}/sorted", ["year"], rebalance=False, options=small)
    write_layer(df, f"{tmp_path}/plain", ["year"], rebalance=False, options=small)
    key = df.filter("id = 17").first()["key"]
    clustered, plain = groups_read(tmp_path / "sorted" / "year=2020", "key", key), groups_read(tmp_path / "plain" / "year=2020", "key", key)
    assert clustered[0] <= 2 and plain[0] > 5 and clustered[0] / clustered[1] < 0.2 < plain[0] / plain[1]
    files = len(list((tmp_path / "sorted" / "year=2020").glob("*.parquet")))
    assert 3 < files and rows(spark.read.parquet(f"{tmp_path}/sorted").select("id")) == rows(df.select("id"))
    assert cluster_by(df, ["key"], partitions=3).rdd.getNumPartitions() == 3
