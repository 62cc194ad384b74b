"""As-of joins, evaluation at instants with lookback, and rates extrapolated to the window's edges."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from trafficlens.operators.asof import asof_join
from trafficlens.plans import instant

T0 = dt.datetime(2024, 1, 1)
SAMPLES = "name string, k int, ts timestamp_ntz, event_id long, v long"


def minute(n):
    return T0 + dt.timedelta(minutes=n)


def brute_asof(left, right, tolerance):
    """For each left row the right row of its key with the latest time, then the largest tie-break."""
    out = []
    for key, at, mark in left:
        fits = [
            (ts, tie, v) for k, ts, tie, v in right
            if k == key and at is not None and ts is not None and ts <= at < ts + dt.timedelta(seconds=tolerance)
        ]
        out.append((key, at, mark, max(fits)[2] if fits else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk, tolerance", [(600, 600), (600, 5400), (7200, 900), (60, 61)])
def test_asof_join_equals_brute_force(spark, chunk, tolerance):
    rng = random.Random(chunk)
    keys = ["a", "a", "a", None, "b"]  # one hot key, null is a key
    right = [
        (rng.choice(keys), T0 + dt.timedelta(seconds=60 * rng.randrange(400)), i, f"v{i}") for i in range(150)
    ]
    right += [("a", T0 - dt.timedelta(hours=h), 900 + h, f"old{h}") for h in range(3)] + [("a", None, 950, "untimed")]
    left = [(rng.choice(keys), T0 + dt.timedelta(seconds=30 * rng.randrange(1000)), i) for i in range(200)]
    left += [("c", T0, 900), ("a", None, 901), ("a", T0 - dt.timedelta(days=9), 902)]
    ldf = spark.createDataFrame(left, "key string, at timestamp_ntz, mark int")
    rdf = spark.createDataFrame(right, "key string, ts timestamp_ntz, tie long, v string")
    got = asof_join(ldf, rdf, ["key"], tolerance, ["v"], left_ts="at", tiebreak="tie", chunk_seconds=chunk)
    assert got.columns == ["key", "at", "mark", "v", "matched_ts"]
    assert sorted([(r.key, r["at"], r.mark, r.v) for r in got.collect()], key=str) == brute_asof(left, right, tolerance)


def test_asof_join_of_empty_sides(spark):
    ldf = spark.createDataFrame([("a", T0)], "key string, ts timestamp_ntz")
    rdf = spark.createDataFrame([], "key string, ts timestamp_ntz, v int")
    assert [r.v for r in asof_join(ldf, rdf, ["key"], 60, ["v"]).collect()] == [None]
    assert asof_join(ldf.limit(0), rdf, ["key"], 60, ["v"]).collect() == []


def test_a_value_is_carried_until_it_is_stale(spark):
    rows = [
        ("g", 0, minute(7), 1, 5),
        ("g", 0, minute(8), 2, 6),
        ("g", 0, minute(8), 3, 7),  # same time: the tie-break decides
        ("g", 0, minute(60), 4, 9),  # on the grid: its own instant has it
        ("g", 1, minute(5), 5, None),  # a null value is a value
    ]
    got = instant.instant_values(spark.createDataFrame(rows, SAMPLES), "10 minutes", "30 minutes").collect()
    assert sorted((r.k, (r.ts - T0).seconds // 60, r.value) for r in got) == sorted(
        [(0, 10, 7), (0, 20, 7), (0, 30, 7), (0, 60, 9), (0, 70, 9), (0, 80, 9)] + [(1, 10, None), (1, 20, None), (1, 30, None)],
        key=lambda r: r[:2],
    )
    total = instant.instant_sum(spark.createDataFrame(rows, SAMPLES), "10 minutes", "30 minutes").collect()
    assert {((r.ts - T0).seconds // 60): r.value for r in total} == {10: 7, 20: 7, 30: 7, 60: 9, 70: 9, 80: 9}
    # The sample at minute 8 has left (t - lookback, t] at minute 38, when it is exactly that old.
    for at, live in (("2024-01-01 00:37:59", 1), ("2024-01-01 00:38:00", 0)):
        assert instant.instant_at(spark.createDataFrame(rows, SAMPLES), at, "30 minutes").where("k = 0").count() == live


def test_a_huge_series_is_many_tasks(spark):
    """One series with all samples: no task of the as-of window holds more than one chunk of it."""
    ticks = spark.range(100_000).select(
        F.lit("g").alias("name"), F.lit(0).alias("k"),
        F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 10)").alias("ts"),
        F.col("id").alias("event_id"), F.col("id").alias("v"),
    )
    values = instant.instant_values(ticks, "1m", "5m")
    sizes = values.groupBy(F.spark_partition_id().alias("p")).count().collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in instant.instant_values(ticks, "1m", "5m").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / 8
    assert values.where("value <> 6 * floor((unix_millis(cast(ts as timestamp)) / 1000 - unix_seconds(timestamp '2024-01-01 00:00:00')) / 60)"
                        " and ts <= timestamp_ntz '2024-01-12 00:00:00'").count() == 0


def rate_of(spark, points, window="10 minutes", step="10 minutes", end=10):
    rows = [("c", 0, T0 + dt.timedelta(seconds=s), i, v) for i, (s, v) in enumerate(points)]
    got = instant.extrapolated_rate(spark.createDataFrame(rows, SAMPLES), window, step).collect()
    return {(r.ts - T0).seconds // 60: r.rate for r in got}.get(end)


def test_rate_reaches_the_edges_when_samples_are_near(spark):
    # every 2 minutes from 1:00 to 9:00, 60 more each time: one edge is 1 minute away on both sides
    points = [(60 + 120 * i, 1000 + 60 * i) for i in range(5)]
    assert rate_of(spark, points) == pytest.approx(240 * (480 + 60 + 60) / 480 / 600)


def test_rate_goes_half_a_spacing_towards_far_edges(spark):
    points = [(240, 1000), (270, 1010), (300, 1030)]
    assert rate_of(spark, points) == pytest.approx(30 * (60 + 15 + 15) / 60 / 600)


def test_rate_never_goes_below_zero_at_the_start(spark):
    # 5 after 30 s of growth by 10 a spacing: zero was 15 s before the first sample
    points = [(60, 5), (90, 15), (120, 25)]
    start = min(15.0, 60 * 5 / 20)  # half a spacing is nearer than the zero here: both are 15 s
    assert rate_of(spark, points) == pytest.approx(20 * (60 + start + 15) / 60 / 600)
    points = [(60, 1), (90, 11), (120, 21)]
    assert rate_of(spark, points) == pytest.approx(20 * (60 + 60 * 1 / 20 + 15) / 60 / 600)


def test_rate_corrects_resets_and_windows_are_left_open(spark):
    points = [(0, 7), (60, 10), (180, 40), (300, 5), (600, 20)]
    # the sample at 0 s belongs to the window that ends there; a reset counts the new value
    increase, span, spacing = 30 + 5 + 15, 540, 180
    to_zero = span * 10 / increase
    assert rate_of(spark, points) == pytest.approx(increase * (span + min(60, to_zero)) / span / 600)
    assert spacing * 1.1 > 60


def test_rate_needs_two_times(spark):
    assert rate_of(spark, [(60, 5)]) is None
    assert rate_of(spark, [(60, 5), (60, 9)]) is None
    assert rate_of(spark, [(60, 5), (120, 5)]) == 0
    with pytest.raises(ValueError):
        instant.extrapolated_rate(spark.createDataFrame([], SAMPLES), "7m", "2m")


def test_signed_sums_over_series(spark):
    rows = [("c", k, T0 + dt.timedelta(seconds=60 * i), 10 * k + i, 100 + (k + 1) * i) for k in range(3) for i in range(1, 10)]
    df = spark.createDataFrame(rows, SAMPLES)
    per = instant.extrapolated_rate(df, "10m", "10m").collect()
    up = instant.extrapolated_rate_sum(df, "10m", "10m").first()
    down = instant.extrapolated_rate_sum(df, "10m", "10m", sign=-1).first()
    assert len(per) == 3 and up.rate == round(sum(r.rate for r in per), 6) == -down.rate
