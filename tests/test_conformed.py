"""The reject store, the final check inside a write, and facts in sorted files."""

from __future__ import annotations

import datetime as dt

from helpers import plan, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwatch.operators.quality import hold_invariant
from sparkwatch.sinks import conformed, read_good, read_rejected, write_conformed
from sparkwatch.sinks.conformed import OUTCOME

SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType(), False),
        T.StructField("n", T.IntegerType()),
        T.StructField("amount", T.IntegerType(), False),
        T.StructField("at", T.TimestampType(), False),
    ]
)


def test_good_and_rejected_rows_add_up(spark, tmp_path):
    """One write: wrong lengths, values that don't fit, missing keys; defaults come first; nothing is lost."""
    data = [("ab", "1", 3), ("ab", "x", 3), ("abc", "2", 3), (None, "3", 3), ("cd", None, None), ("ef", str(10**12), 1)]
    df = spark.createDataFrame(data, "key string, n string, amount int")
    defaults = {"amount": 7, "at": dt.datetime(2024, 1, 1)}
    path = str(tmp_path / "t")
    counts = write_conformed(df, SCHEMA, path, ["n"], {"key": 2}, defaults, rebalance=False)
    assert counts == {"good": 2, "rejected": 4}
    assert rows(read_good(spark, path, SCHEMA).select("key", "n", "amount")) == [("ab", 1, 3), ("cd", None, 7)]
    bad = {(r["key"], tuple(r["reject_reasons"])): r["raw"] for r in read_rejected(spark, path, SCHEMA).collect()}
    assert set(bad) == {
        ("ab", ("n: not a int",)), ("abc", ("key: length is not 2",)), (None, ("key: missing",)), ("ef", ("n: not a int",)),
    }
    assert '"n":"x"' in bad[("ab", ("n: not a int",))]


def test_reject_store_without_rejects_and_empty(spark, tmp_path):
    df = spark.createDataFrame([("ab", "1", 3)], "key string, n string, amount int").withColumn("at", F.current_timestamp())
    assert write_conformed(df, SCHEMA, f"{tmp_path}/a") == {"good": 1, "rejected": 0}
    assert read_rejected(spark, f"{tmp_path}/a", SCHEMA).count() == 0
    assert write_conformed(df.limit(0), SCHEMA, f"{tmp_path}/b") == {"good": 0, "rejected": 0}
    assert read_good(spark, f"{tmp_path}/b", SCHEMA).columns == SCHEMA.names


def test_conformed_twice_is_not_checked_again(spark, tmp_path):
    df = conformed(spark.createDataFrame([("abc", "1", 3)], "key string, n string, amount int"), SCHEMA, {"key": 2})
    assert df.first()[OUTCOME] == "rejected"
    assert write_conformed(df, SCHEMA, f"{tmp_path}/a") == {"good": 0, "rejected": 1}


def test_final_check_is_part_of_the_write(spark, tmp_path):
    data = [(1, "a", "b"), (2, " ", "b"), (3, None, " "), (None, "a", "b"), (5, "x", "\t")]
    df = spark.createDataFrame(data, "i int, s string, t string")
    held, seen = hold_invariant(df)
    assert plan(held).count("Scan") == 1 and "Exchange" not in plan(held)
    held.write.parquet(f"{tmp_path}/x")
    assert rows(spark.read.parquet(f"{tmp_path}/x")) == [(1, "a", "b"), (5, "x", "\t")]
    assert seen.get == {"rows": 3, "i": 1, "s": 2, "t": 1}
