"""Semi-join reduction: rows of titles that nobody asked for are dropped before parsing and before the shuffle."""

import datetime as dt

from pyspark.sql import functions as F
from traffic_helpers import collected_plan, write_dump

from trafficlens.operators import semijoin as sv
from trafficlens.plans import traffic
from trafficlens.sources import pageviews as src


def many_views(spark, titles=20_000, days=3):
    rows = spark.range(titles * days)
    return rows.select(
        F.lit("fr").alias("project"),
        F.concat(F.lit("Page_"), (F.col("id") % titles).cast("string")).alias("title"),
        F.lit(2).alias("views"),
        F.lit("20240101").alias("day"),
        F.lit(0).alias("hour"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") / titles).cast("int")).alias("date"),
    )


def test_shuffled_rows_follow_the_requested_titles(spark):
    pv = many_views(spark)
    asked = spark.createDataFrame([(f"Page_{k}",) for k in range(0, 50, 10)] + [("Absent é",), (None,)], "title string")
    daily = traffic.titles_daily(pv, asked)
    rows, nodes = collected_plan(daily)
    assert rows == 5 * 3
    shuffles = [m["shuffleRecordsWritten"] for name, text, m in nodes if name == "Exchange" and "variant" in text]
    # Matching rows (15, at most one per task and group) and the list's own spellings, never the 60,000 views.
    assert shuffles and max(shuffles) <= 15 * 16


def test_a_sieve_drops_no_listed_key(spark):
    keys = spark.range(5_000).select(F.col("id").cast("string").alias("k"))
    listed = keys.where("k like '%7'").unionByName(spark.createDataFrame([(None,), ("absent",)], "k string"))
    kept = {r.k for r in sv.sieve(keys, F.col("k"), listed, "k").collect()}
    wanted = {str(k) for k in range(5_000) if k % 10 == 7}
    assert wanted <= kept and len(kept - wanted) <= 5
    assert sv.sieve(keys, F.col("k"), listed.limit(0), "k").count() == 0


def test_the_bitmap_has_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(sv, "WORDS", 16)
    monkeypatch.setattr(sv, "BITS", 16 * 64)
    keys = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    assert sv.sieve_words(keys, "k").count() <= 16
    assert sv.sieve(keys, F.col("k"), keys, "k").count() == 20_000


def test_dump_lines_are_sieved_before_they_are_split(spark, tmp_path):
    lines = [f"fr Page_{k} 3 0" for k in range(2_000)] + ["fr %C3%A9t%C3%A9 4 0", "fr été 5 0", "fr", "", "x y", "fr été 1", "fr  7 0"]
    write_dump(tmp_path / "2024-01", "pageviews-20240101-000000.gz", lines)
    path = f"{tmp_path}/2024-01/*.gz"
    asked = spark.createDataFrame([("été",), ("Page_7",)], "title string")
    spellings = traffic.requested_spellings(asked)
    pv = src.read_pageviews(spark, path, title_list=spellings)
    assert {(r.title, r.views) for r in pv.collect()} >= {("été", 5), ("%C3%A9t%C3%A9", 4), ("Page_7", 3)}
    assert pv.count() <= 6
    whole = traffic.titles_daily(src.read_pageviews(spark, path), asked).collect()
    assert sorted(map(tuple, traffic.titles_daily(pv, asked).collect())) == sorted(map(tuple, whole)) and len(whole) == 2
    _, nodes = collected_plan(pv)
    names = [name for name, _, _ in nodes]
    assert names.index("Generate") < names.index("BroadcastHashJoin")  # the split stands above the sieve
