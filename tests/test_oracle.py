"""Every registered query against the SQL it must agree with, over the whole small tables."""

import datetime as dt
import decimal
import os

import pytest

import __spark_entry__ as entry_points
from surveillance_queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def value(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def canonical(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(value(r[i]) for i in order) for r in data), key=repr)


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(ORACLES[name])
    expected = canonical([d[0] for d in cursor.description], cursor.fetchall())
    assert got == expected
    assert got[1]


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["report_year", "disease_name", "region_code", "outbreak_count"]


JOBS = (
    "run_metrics", "funnel_final", "alerts_compacted", "own_matcher", "rollup_after_compaction", "compaction_two_months", "stream_dedup", "events_sent",
)


def test_no_python_rows_in_registered_plans(spark):
    for name, fn in QUERIES.items():
        if name in JOBS or "warehouse" in name or name.startswith(("alert_st", "batch_", "feed_")):
            continue
        text = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert node not in text, (name, node)
