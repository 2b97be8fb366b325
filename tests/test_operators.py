import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import plan, rows
from sparkwatch.functions import Lexicon, first_term
from sparkwatch.operators import (
    apply_defaults,
    assert_or_remove,
    build_rollup,
    conform,
    date_window,
    dedup,
    dedup_either,
    drop_any_blank,
    expire,
    fill_from_groups,
    fits_broadcast,
    hot_keys,
    join_dim,
    keep_latest,
    lookup_key,
    match_terms,
    merge_rollup,
    min_bound,
    null_profile,
    open_versions,
    project,
    quality_funnel,
    recent,
    rejects,
    rename,
    repair_like,
    require,
    scd2_merge,
    skew_join,
    standardize,
    top_n,
    valid_event,
)


# --- projection and repair ------------------------------------------------------------------------------


def test_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([(" a ",)], "x string")
    assert rows(standardize(df, ["x", "nope"], ["nope2"])) == [("A",)]
    assert rows(project(df, {"x": "y", "nope": "z"})) == [("a",)]
    assert rows(min_bound(df, "year", 1996)) == [(" a ",)]
    assert rows(fill_from_groups(df, "region", "x", {"R": ["A"]})) == [(" a ",)]
    assert rename(df, {"nope": "z"}).columns == ["x"]


def test_repair_takes_the_first_pattern(spark):
    df = spark.createDataFrame([("CÔTE D'IVOIRE",), ("RÉUNION",), ("CHAD",), (None,)], "c string")
    fixed = repair_like(df, "c", [("C%TE D'IVOIRE", "COTE D'IVOIRE"), ("R%UNION", "REUNION"), ("R%", "OTHER")])
    assert [r[0] for r in fixed.collect()] == ["COTE D'IVOIRE", "REUNION", "CHAD", None]


def test_group_fill_only_where_null(spark):
    df = spark.createDataFrame([("ARUBA", None), ("ARUBA", "X"), ("CHAD", None)], "country string, region string")
    assert [r[1] for r in fill_from_groups(df, "region", "country", {"Americas": ["ARUBA"]}).collect()] == ["Americas", "X", None]


# --- quality --------------------------------------------------------------------------------------------


def test_blank_and_null_rules(spark):
    df = spark.createDataFrame([("a", 1), ("  ", 2), (None, 3), ("b", None)], "s string, n int")
    assert rows(drop_any_blank(df)) == [("a", 1)]
    assert rows(require(df, ["s"])) == [("  ", 2), ("a", 1), ("b", None)]
    assert rows(null_profile(df)) == [("n", 1), ("s", 2)]
    good, profile = assert_or_remove(df)
    assert rows(good) == [("a", 1)] and rows(profile) == [("n", 1), ("s", 2)]


def brute_funnel(data, order):
    ok, null, blank = [], 0, 0
    for r in data:
        if any(v is None for v in r):
            null += 1
        elif any(isinstance(v, str) and not v.strip(" ") for v in r):
            blank += 1
        else:
            ok.append(r)
    winners = {}
    for r in sorted(ok, key=order):
        winners.setdefault(r[0], r)
    kept = [r for r in winners.values() if r[2] >= 1996]
    return {
        "rows_in": len(data), "null": null, "blank": blank, "duplicate": len(ok) - len(winners),
        "bound": len(winners) - len(kept), "final": 0, "rows_out": len(kept),
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_funnel_equals_brute_force_and_adds_up(spark, seed):
    rnd = random.Random(seed)
    data = [
        (rnd.choice(["a", "b", "c", "d", None]), rnd.choice(["x", " ", "y"]), rnd.choice([1990, 1995, 1996, 2000, None]))
        for _ in range(200)
    ]
    df = spark.createDataFrame(data, "k string, s string, year int")
    latest = dict(rows(quality_funnel(df, ["k"], ("year", 1996))))
    assert latest == brute_funnel(data, lambda r: -r[2])
    by_text = dict(rows(quality_funnel(df, ["k"], ("year", 1996), [F.col("s"), F.col("year")])))
    assert by_text == brute_funnel(data, lambda r: (r[1], r[2]))
    for f in (latest, by_text):
        assert f["rows_in"] == f["null"] + f["blank"] + f["duplicate"] + f["bound"] + f["final"] + f["rows_out"]
    final = dict(rows(quality_funnel(df, ["k"], ("year", 1996), final_bad=F.col("s") == "y")))
    assert final["final"] + final["rows_out"] == latest["rows_out"]


def test_funnel_of_nothing(spark):
    df = spark.createDataFrame([], "k string, year int")
    assert set(n for _, n in rows(quality_funnel(df, ["k"], ("year", 1996)))) == {0}


# --- deduplication --------------------------------------------------------------------------------------


def test_dedup_winner_is_declared_and_stable(spark):
    data = [("k", 1999, "b"), ("k", 2001, "z"), ("k", 2001, "a"), (None, 1, "n"), (None, 2, "m")]
    for seed in range(3):
        shuffled = data[:]
        random.Random(seed).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, "k string, year int, s string").repartition(3)
        assert rows(dedup(df, ["k"], [F.desc("year")])) == [("k", 2001, "a"), (None, 2, "m")]


def test_dedup_cuts_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    text = plan(dedup(df, ["k"], ["id"]))
    assert text.count("WindowGroupLimit") == 2
    partial = text.rindex("WindowGroupLimit")
    assert text.index("Exchange hashpartitioning") < partial


def test_keep_latest_ties_and_null_versions(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, None, "c"), (2, None, "d")], "k int, v int, s string")
    assert rows(keep_latest(df, ["k"], "v", ["s"])) == [(1, 5, "a"), (2, None, "d")]


def greedy(data):
    urls, titles, out = set(), set(), []
    for i, u, t in sorted(data):
        if u in urls or t in titles:
            continue
        urls.add(u)
        titles.add(t)
        out.append((i, u, t))
    return sorted(out, key=repr)


def test_dedup_either_is_not_a_chain_of_dedups(spark):
    data = [(0, "u1", "t1"), (1, "u2", "t1"), (2, "u2", "t2")]
    df = spark.createDataFrame(data, "i int, u string, t string")
    assert rows(dedup_either(df, ["u", "t"], ["i"])) == [(0, "u1", "t1"), (2, "u2", "t2")]


@pytest.mark.parametrize("seed", range(4))
def test_dedup_either_equals_the_greedy_loop(spark, seed):
    rnd = random.Random(seed)
    n = 60
    # one title and one url hold a third of the rows each
    def pick(prefix):
        return prefix + ("hot" if rnd.random() < 0.33 else str(rnd.randrange(25)))

    data = [(i, pick("u"), rnd.choice([None, pick("t")]) if seed == 3 else pick("t")) for i in range(n)]
    df = spark.createDataFrame(data, "i int, u string, t string").repartition(3)
    assert rows(dedup_either(df, ["u", "t"], ["i"], hot_share=0.2, skew_min_rows=0)) == greedy(data)
    assert rows(dedup_either(df, ["u", "t"], ["i"])) == greedy(data)


def test_dedup_either_on_a_chain_and_on_copies(spark):
    chain = [(i, f"u{(i + 1) // 2}", f"t{i // 2}") for i in range(9)]
    df = spark.createDataFrame(chain, "i int, u string, t string")
    assert rows(dedup_either(df, ["u", "t"], ["i"])) == greedy(chain)
    copies = spark.createDataFrame([(1, "u", "t")] * 20, "i int, u string, t string")
    assert rows(dedup_either(copies, ["u", "t"], ["i"])) == [(1, "u", "t")]
    assert rows(dedup_either(copies.filter("i > 5"), ["u", "t"], ["i"])) == []


# --- joins ----------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    left = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).cast("int").alias("k"),
        "id",
    )
    right = spark.range(0, 60, 2).select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("v"))
    return left, right.unionByName(spark.createDataFrame([(7, 70)], "k int, v long"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_plain_join(skewed, how):
    left, right = skewed
    for share in (0.2, 0.9):  # with and without a hot key
        assert rows(skew_join(left, right, ["k"], how, share=share, min_rows=0)) == rows(left.join(right, ["k"], how))
    assert rows(join_dim(left, right, "k", how)) == rows(left.join(right, ["k"], how))


def test_hot_keys_are_bounded(skewed):
    left, _ = skewed
    assert rows(hot_keys(left, ["k"], 0.2)) == [(7,)]
    assert hot_keys(left, ["k"], 0.01).count() <= 100


@pytest.mark.parametrize("threshold", ["0", "-1", "1b"])
def test_large_dimension_is_not_broadcast(spark, skewed, threshold):
    left, right = skewed
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, threshold)
    try:
        assert fits_broadcast(right, max_rows=100) and not fits_broadcast(right, max_rows=10)
        assert not fits_broadcast(right, max_bytes=100)
        assert "BroadcastHashJoin" in plan(join_dim(left, right, "k"))
        assert "BroadcastHashJoin" not in plan(join_dim(left, right, "k", max_rows=10))
        split = join_dim(left, right, "k", "left", max_rows=10, derived=True, costly=True)
        assert rows(split) == rows(left.join(right, ["k"], "left"))
    finally:
        spark.conf.set(conf, before)


def test_lookup_key_misses_and_collisions(spark):
    dim = spark.createDataFrame([("Côte d'Ivoire", "k1"), ("KENYA", "k2"), ("kenya!", "k3")], "name string, key string")
    df = spark.createDataFrame([("Côte  D'IVOIRE",), ("Kenya",), ("Mars",), (None,), ("Cote d'Ivoire",)], "n string")
    assert rows(lookup_key(df, "n", dim, "name", "key", "key")) == [
        ("Cote d'Ivoire", None), ("Côte  D'IVOIRE", "k1"), ("Kenya", "k3"), ("Mars", None), (None, None),
    ]
    assert ("Cote d'Ivoire", "k1") in rows(lookup_key(df, "n", dim, "name", "key", "key", fold=True))


# --- slowly changing dimension ----------------------------------------------------------------------------


D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)


def test_scd2_modes(spark):
    dim = open_versions(spark.createDataFrame([("o'neil", "x"), ("b", "y"), ("c", "z")], "n string, d string"), "2024-01-01")
    load = spark.createDataFrame([("o'neil", "x2"), ("b", "y"), ("new", None)], "n string, d string")
    merged = scd2_merge(dim, load, "n", ["d"], "2024-02-01")
    assert rows(merged) == sorted(
        [
            ("o'neil", "x", D1, D2, 0), ("o'neil", "x2", D2, None, 1), ("b", "y", D1, None, 1),
            ("c", "z", D1, None, 1), ("new", None, D2, None, 1),
        ],
        key=repr,
    )
    assert rows(scd2_merge(merged, load, "n", ["d"], "2024-03-01")) == rows(merged)
    always = scd2_merge(merged, load, "n", ["d"], "2024-03-01", mode="always")
    assert always.filter("is_current = 1").groupBy("n").count().filter("count > 1").count() == 0
    assert always.filter("end_date = date'2024-03-01'").count() == 3
    assert always.count() == 8
    assert rows(expire(dim, load, "n", "2024-02-01")) == sorted(
        [("o'neil", "x", D1, D2, 0), ("b", "y", D1, D2, 0), ("c", "z", D1, None, 1)], key=repr
    )


def brute_merge(dim, load, day, mode):
    """Row by row: close and open versions as a load comes in. Rows are (name, value, start, end, current)."""
    load = {n: v for n, v in load}
    out, seen = [], set()
    for n, v, start, end, cur in dim:
        if cur == 1 and n in load:
            if mode == "always" or load[n] != v:
                out.append((n, v, start, day, 0))
                continue
            seen.add(n)
        out.append((n, v, start, end, cur))
    out += [(n, v, day, None, 1) for n, v in load.items() if n not in seen]
    return sorted(out, key=repr)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    loads=st.lists(
        st.dictionaries(st.sampled_from("abcde"), st.sampled_from(["1", "2", None]), min_size=1, max_size=5),
        min_size=2, max_size=3,
    ),
    mode=st.sampled_from(["always", "on_change"]),
)
def test_scd2_equals_brute_force(spark, loads, mode):
    state, schema = [], "n string, d string, start_date date, end_date date, is_current int"
    for i, load in enumerate(loads):
        day = dt.date(2024, 1, i + 1)
        dim = spark.createDataFrame(state, schema)
        merged = scd2_merge(dim, spark.createDataFrame(list(load.items()), "n string, d string"), "n", ["d"], str(day), mode)
        expected = brute_merge(state, load.items(), day, mode)
        state = rows(merged)
        assert state == expected
        assert len({r[0] for r in state if r[4] == 1}) == sum(r[4] for r in state)


def test_scd2_repeated_names_in_a_load_open_one_version(spark):
    dim = open_versions(spark.createDataFrame([("a", "1")], "n string, d string"), "2024-01-01")
    load = spark.createDataFrame([("a", "2"), ("a", "3"), ("b", "1"), ("b", "1"), (None, "q")], "n string, d string")
    merged = scd2_merge(dim, load, "n", ["d"], "2024-02-01")
    assert rows(merged.filter("is_current = 1").select("n", "d")) == [("a", "2"), ("b", "1")]


# --- conformance, rollups, events -------------------------------------------------------------------------


def test_conform_splits_without_losing_rows(spark):
    schema = T.StructType(
        [T.StructField("iso3", T.StringType(), False), T.StructField("n", T.IntegerType()), T.StructField("x", T.DateType())]
    )
    df = spark.createDataFrame([("YEM", "1"), ("YE", "1"), ("TZA", "one"), (None, None)], "iso3 string, n string")
    good, bad = rejects(conform(df, schema, {"iso3": 3}))
    assert rows(good) == [("YEM", 1, None)]
    assert [r[-1] for r in rows(bad)] == [["n: not a int"], ["iso3: length is not 3"], ["iso3: missing"]]


def test_defaults(spark):
    df = spark.createDataFrame([(1,), (None,)], "c int")
    assert rows(apply_defaults(df, {"c": 1, "d": "x"})) == [(1, "x"), (1, "x")]


def test_merged_rollup_is_the_rollup_of_all(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("a"), (F.col("id") % 3).alias("b"), "id")
    whole = build_rollup(df, ["a", "b"])
    merged = merge_rollup(build_rollup(df.filter("id < 60"), ["a", "b"]), build_rollup(df.filter("id >= 60"), ["a", "b"]), ["a", "b"])
    assert rows(merged) == rows(whole) and merged.schema["alert_count"].dataType == T.LongType()


def test_valid_event_date_window_top_n(spark):
    df = spark.createDataFrame([(" \t", "u"), ("t", ""), ("t", None), ("t", "u"), (None, "u")], "title string, url string")
    assert rows(valid_event(df)) == [("t", "u")]
    ts = spark.sql("select explode(sequence(timestamp'2024-01-01 12:00:00', timestamp'2024-01-05 12:00:00', interval 1 day)) t")
    kept = date_window(ts, "t", "2024-01-03 08:00:00")
    assert [r[0].day for r in kept.orderBy("t").collect()] == [2, 3]
    assert "TakeOrderedAndProject" in plan(top_n(ts, [F.desc("t")], 2))
    assert [r[0].day for r in recent(ts, "t").collect()] == [5, 4, 3, 2, 1]


def test_match_terms_equals_the_expression(spark):
    terms = ["dengue fever", "e. coli", "covid-19", "fever", "valley fever outbreak", "19"]
    texts = [
        "Yellow FEVER and Dengue Fever.", "E. coli!", "covid 19", "COVID-19", "rift valley fever outbreak", "", "...",
        "dengue  fever", "fevers",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    lexicon = spark.createDataFrame([(t, i) for i, t in enumerate(terms)], "term string, priority int")
    expected = docs.select("i", first_term(F.col("t"), Lexicon.of(*terms)).alias("term")).filter("term is not null")
    assert rows(match_terms(docs, "i", "t", lexicon, 3).select("i", "term")) == rows(expected)
