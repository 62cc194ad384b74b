"""Skew-safe operators against plain Python, with one series holding most rows."""

import datetime as dt
import random
import statistics as st

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from trafficlens.operators import global_row_number, group_median, previous_value, running_total


def _series_rows(seed=7, n=3000):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.7 else rnd.choice(["a", "b", "c"])
        ts = t0 + dt.timedelta(seconds=rnd.randrange(0, 3 * 86400))
        rows.append((key, ts, i, rnd.randrange(-5, 50)))
    return rows


def test_running_total_and_previous_value(spark):
    rows = _series_rows()
    df = spark.createDataFrame(rows, "s string, ts timestamp_ntz, id long, v long")
    got = {r.id: (r.run, r.prev) for r in previous_value(running_total(df, ["s"], "ts", "id", "v", "run"), ["s"], "ts", "id", "v", "prev").collect()}
    want = {}
    for key in {r[0] for r in rows}:
        acc, prev = 0, None
        for s, ts, i, v in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2])):
            acc += v
            want[i] = (acc, prev)
            prev = v
    assert got == want


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(hs.lists(hs.tuples(hs.sampled_from(["x", "y", "z"]), hs.integers(-20, 20)), min_size=1, max_size=60))
def test_group_median_matches_statistics(spark, values):
    df = spark.createDataFrame([(k, float(v)) for k, v in values], "k string, v double")
    got = {r.k: (r.median, r.n, r.min, r.max) for r in group_median(df, ["k"], "v", stats=True).collect()}
    groups = {}
    for k, v in values:
        groups.setdefault(k, []).append(float(v))
    assert got == {k: (st.median(vs), len(vs), min(vs), max(vs)) for k, vs in groups.items()}


def test_global_row_number_is_a_permutation_in_order(spark):
    rnd = random.Random(3)
    rows = [(rnd.randrange(0, 50), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    got = global_row_number(df, ["a", "b"], "rn").collect()
    by_rn = sorted(got, key=lambda r: r.rn)
    assert [r.rn for r in by_rn] == list(range(1, 2001))
    assert [(r.a, r.b) for r in by_rn] == sorted(rows)


def test_global_row_number_cuts_one_hot_key_into_runs(spark, monkeypatch):
    from trafficlens.operators import ranking

    monkeypatch.setattr(ranking, "ROWS_PER_RUN", 200)
    # One key holds nearly all rows; another order column is null at times.
    df = spark.range(5000).selectExpr("if(id % 50 = 0, id, 7) as a", "if(id % 9 = 0, null, 'b') as b", "id as c")
    out = global_row_number(df, ["a", "b"], "rn")
    rows = sorted(out.collect(), key=lambda r: r.rn)
    assert [r.rn for r in rows] == list(range(1, 5001))
    key = [(r.a, r.b is not None, r.b or "") for r in rows]
    assert key == sorted(key)
    keyed = df.selectExpr("a as _k0", "xxhash64(a, b, c) as _tie")
    bounds = ranking.run_bounds(keyed, ["_k0", "_tie"], 5, 5000)
    assert 15 <= bounds.count() <= 24
    sizes = [r["count"] for r in ranking.placed_in_runs(keyed, ["_k0", "_tie"], bounds, 5).groupBy("_run").count().collect()]
    assert len(sizes) == bounds.count() + 1 and max(sizes) < 5 * 5000 / 25


def test_global_row_number_over_times_and_falling_numbers(spark, monkeypatch):
    from trafficlens.operators import ranking

    monkeypatch.setattr(ranking, "ROWS_PER_RUN", 100)
    df = spark.range(1000).selectExpr(
        "cast(timestamp'2024-03-31 00:00:00' as timestamp_ntz) + make_dt_interval(0, 0, cast(id * 37 % 1000 as int)) as ts",
        "id % 10 as v",
    )
    rows = sorted(global_row_number(df, ["ts"], "rn").collect(), key=lambda r: r.rn)
    assert [r.ts for r in rows] == sorted(r.ts for r in rows)
    falling = sorted(global_row_number(df, [-F.col("v"), "ts"], "rn").collect(), key=lambda r: r.rn)
    assert [(-r.v, r.ts) for r in falling] == sorted((-r.v, r.ts) for r in rows)



def test_series_across_a_dst_change_in_a_zoned_session(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        t0 = dt.datetime(2024, 10, 27, 0, 0)  # Paris falls back from 03:00 to 02:00 that night
        rows = [("s", t0 + dt.timedelta(minutes=10 * i), i, i + 1) for i in range(30)]
        df = spark.createDataFrame(rows, "s string, ts timestamp_ntz, id long, v long")
        out = previous_value(running_total(df, ["s"], "ts", "id", "v", "run"), ["s"], "ts", "id", "v", "prev", seq_out="seq")
        got = sorted(out.collect(), key=lambda r: r.id)
        assert [r.run for r in got] == [sum(range(1, i + 2)) for i in range(30)]
        assert [r.prev for r in got] == [None] + list(range(1, 30))
        seqs = [r.seq for r in got]
        assert seqs == sorted(seqs) and len(set(seqs)) == 30
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_group_median_narrows_large_groups(spark, monkeypatch):
    """Random, duplicated, tied and tiny groups, with ranges narrowed round after round."""
    from trafficlens.operators import quantiles

    monkeypatch.setattr(quantiles, "SMALL", 50)
    monkeypatch.setattr(quantiles, "CUTS", 8)
    monkeypatch.setattr(quantiles, "ACCURACY", 40)
    rnd = random.Random(11)
    rows = [("wide", float(rnd.randrange(10**6))) for _ in range(3001)]
    rows += [("narrow", 5e5 + rnd.random()) for _ in range(4000)]  # inside one range of all values
    rows += [("tied", float(rnd.choice([1, 1, 1, 2, 9]))) for _ in range(2000)] + [("one", 3.0)] * 999
    rows += [("halves", 1.0)] * 500 + [("halves", 2.0)] * 500 + [(None, float(k)) for k in range(301)]
    rows += [("few", 1.0), ("few", 4.0), ("gone", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {r.k: (r.median, r.n, r.min, r.max) for r in group_median(df, ["k"], "v", stats=True).collect()}
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert got == {k: (st.median(vs), len(vs), min(vs), max(vs)) for k, vs in groups.items()}


def test_a_group_inside_one_global_range_is_not_ranked_by_one_task(spark, monkeypatch):
    """Only a few of a group's rows reach the ranking; the sketches and counts come from every task."""
    from traffic_helpers import collected_plan

    from trafficlens.operators import quantiles

    monkeypatch.setattr(quantiles, "SMALL", 2_000)
    df = spark.range(0, 200_000, 1, 8).selectExpr(
        "if(id % 2 = 0, 'narrow', 'wide') as k",
        "if(id % 2 = 0, 0.5 + id / 1e9, cast(id * 7919 % 200003 as double)) as v",
    )
    ranges = quantiles.middle_ranges(df, ["k"], "v")
    assert all(r["_within"] <= 2_000 and r["n"] == 100_000 for r in ranges.collect())
    rows, nodes = collected_plan(group_median(df, ["k"], "v"))
    shuffled = [m["shuffleRecordsWritten"] for name, _, m in nodes if name == "Exchange"]
    assert rows == 2 and max(shuffled) <= 2 * 2_000
    # One round narrowed both groups together: its aggregates are partial ones, a row for each task and group.
    whole = quantiles._stored(ranges.selectExpr("k", "n", "min", "max", "min as _lo", "max as _hi", "0L as _before", "n as _within"))
    rows, nodes = collected_plan(quantiles.narrowed(df, whole, ["k"], "v"))
    shuffled = sorted(m["shuffleRecordsWritten"] for name, text, m in nodes if name == "Exchange" and "hashpartitioning(k" in text)
    assert rows == 2 and shuffled and shuffled[-1] <= 2 * 8


def test_the_driver_sees_as_little_of_a_larger_table(spark, monkeypatch):
    """Rows that reach the driver, and the literals of the plan, don't grow with the input."""
    from pyspark.sql.classic.dataframe import DataFrame

    from trafficlens import fixtures as fx
    from trafficlens.operators import ranking
    from trafficlens.plans import run_ordinal

    seen, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: seen.append(collect(self)) or seen[-1])
    monkeypatch.setattr(ranking, "ROWS_PER_RUN", 200)
    monkeypatch.setattr(ranking, "FAN", 6)
    rows, plans = [], []
    for sf in ("sf0.01", "sf0.1"):
        seen.clear()
        out = run_ordinal(fx.runs(spark, f"/root/testdata/{sf}"))
        rows.append(sum(map(len, seen)))
        plans.append(len(out._jdf.queryExecution().optimizedPlan().toString().splitlines()))
        assert out.selectExpr("count(distinct ordinal) = count(*) and min(ordinal) = 1 and max(ordinal) = count(*)").first()[0]
    assert rows[0] == rows[1] == 0 and plans[0] == plans[1]


def test_empty_and_single_rows(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert global_row_number(empty, ["a"], "rn").collect() == []
    assert group_median(empty.withColumn("v", F.lit(1.0)), ["b"], "v").collect() == []
    one = spark.createDataFrame([(None, "x")], "a int, b string")
    assert [r.rn for r in global_row_number(one, ["a"], "rn").collect()] == [1]
