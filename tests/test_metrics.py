"""Metric-sample aggregations: increases with resets, rates, latest values, label regex."""

import datetime as dt

from trafficlens.plans import metrics as mx

T0 = dt.datetime(2024, 1, 1)


def _samples(spark, rows):
    return spark.createDataFrame(rows, "name string, k int, ts timestamp_ntz, event_id long, v long")


def test_reset_counts_new_value(spark):
    rows = [("c", 0, T0 + dt.timedelta(minutes=5 * i), i, v) for i, v in enumerate([10, 30, 5, 25])]
    df = _samples(spark, rows)
    inc = mx.counter_increase_windows(df, "1 hour", "1 hour").collect()
    assert [(r.increase, r.samples) for r in inc] == [(45, 4)]
    rate = mx.counter_rate(df, "1 hour", "1 hour").collect()
    assert [(r.name, r.ts, r.rate) for r in rate] == [("c", T0 + dt.timedelta(hours=1), 45 / 3600)]
    assert mx.counter_rate(df, "1 hour", "1 hour", sign=-1).first().rate == -45 / 3600


def test_sliding_windows_and_minimum_samples(spark):
    # one sample per hour: each 2 h window ending on the grid sees two samples, except the edges
    rows = [("c", 0, T0 + dt.timedelta(hours=h, minutes=30), h, 100 * h) for h in range(4)]
    got = {(r.ts.hour, r.increase) for r in mx.counter_increase_windows(_samples(spark, rows), "2 hours", "1 hour").collect()}
    assert got == {(2, 100), (3, 100), (4, 100)}


def test_latest_and_sums(spark):
    rows = [
        ("view", 0, T0, 1, 5),
        ("view", 0, T0 + dt.timedelta(hours=1), 2, 7),
        ("view", 1, T0, 3, 3),
        ("click", 0, T0, 4, 11),
        ("click", 0, T0, 5, 12),  # same ts: the tie-break decides
        ("error", 0, T0, 6, 1),
    ]
    df = _samples(spark, rows)
    latest = {(r.name, r.k): r.value for r in mx.latest(df).collect()}
    assert latest == {("view", 0): 7, ("view", 1): 3, ("click", 0): 12, ("error", 0): 1}
    assert {r.name: r.value for r in mx.latest_sum(df).collect()} == {"view": 10, "click": 12, "error": 1}
    assert mx.sum_of_two(df, "view", "click").first().value == 22
    by_label = {(r.name, r.ts.hour): r.value for r in mx.sum_by_label(df, "1 hour").collect()}
    assert by_label[("view", 1)] == 8 and by_label[("view", 2)] == 7
    reduced = {r.name: (r.last_value, r.max_value) for r in mx.reduce_series(mx.sum_by_label(df, "1 hour")).collect()}
    assert reduced["view"] == (7, 8)


def test_label_regex_is_anchored(spark):
    df = spark.createDataFrame([("error",), ("view",), ("terror",)], "name string")
    assert [r.name for r in mx.label_matches(df, "name", "e.+").collect()] == ["error"]


def test_durations():
    assert mx.duration_seconds("6 hours") == 21600
    assert mx.duration_seconds("30s") == 30
    assert mx.duration_seconds("5m") == 300


def test_untied_fast_path_matches(spark):
    rows = [("c", k, T0 + dt.timedelta(minutes=7 * i + k), i, 10 * i + k) for i in range(30) for k in range(2)]
    df = _samples(spark, rows)
    exact = sorted(tuple(r) for r in mx.sum_by_label(df, "1 hour").collect())
    fast = sorted(tuple(r) for r in mx.sum_by_label(df, "1 hour", tiebreak=None).collect())
    assert exact == fast
    plan = mx.latest(df, tiebreak=None)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    rate = sorted(tuple(r) for r in mx.counter_rate(df, "2 hours", "1 hour").collect())
    rate_fast = sorted(tuple(r) for r in mx.counter_rate(df, "2 hours", "1 hour", tiebreak=None).collect())
    assert rate == rate_fast and rate


def test_metric_plans_have_no_sort_aggregate(spark):
    import __spark_entry__ as entry
    from traffic_helpers import SMOKE_DIR

    for name, query in entry.queries().items():
        if name.startswith("metric_"):
            plan = query(spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
            assert "SortAggregate" not in plan, name


def test_latest_orders_by_time_then_a_signed_tie_break(spark):
    import datetime as dt

    from trafficlens.plans import latest

    t = dt.datetime(2024, 1, 1)
    old = dt.datetime(1960, 1, 1)
    rows = [
        ("a", 0, t, -5, 1), ("a", 0, t, 3, 2), ("a", 0, t, -9, 3),
        ("b", 0, t, 2**62, 4), ("b", 0, t + dt.timedelta(microseconds=1), -(2**62), 5),
        ("c", 0, old, 9, 6), ("c", 0, old + dt.timedelta(microseconds=1), 1, 7),
    ]
    samples = spark.createDataFrame(rows, "name string, k int, ts timestamp_ntz, event_id bigint, v int")
    assert {r.name: r.value for r in latest(samples).collect()} == {"a": 2, "b": 5, "c": 7}
