"""Top pages, daily and hourly reports: invariants, parity rules, one-pass plans."""

import pytest
from traffic_helpers import ORACLE_DIR, SMOKE_DIR

from trafficlens import fixtures as fx
from trafficlens.operators import unknown_titles
from trafficlens.plans import hourly_profile, title_daily, titles_daily, top_pages


def _pv(spark, rows):
    return spark.createDataFrame(
        rows, "project string, title string, views int, day string, hour int, date date"
    )


def test_top_pages_invariants(spark):
    pv = fx.pageviews(spark, ORACLE_DIR)
    rows = top_pages(pv, 100).collect()
    assert [r.rank for r in rows] == list(range(1, len(rows) + 1))
    assert all(r.views == r.views_desktop + r.views_mobile for r in rows)
    assert abs(sum(r.share_pct for r in rows) - 100) < 0.1
    ordered = sorted(rows, key=lambda r: (-r.views, r.title))
    assert [r.title for r in ordered] == [r.title for r in rows]
    # raw and encoded spellings are separate rows (grouped by raw title)
    titles = {r.title for r in rows}
    assert {"Sagrada_Família", "Sagrada_Fam%C3%ADlia"} <= titles


def test_top_pages_ties_and_zero_total(spark):
    import datetime as dt

    d = dt.date(2026, 6, 1)
    pv = _pv(spark, [("fr", "B", 0, "20260601", 1, d), ("fr", "A", 0, "20260601", 1, d), ("fr.m", "C", 0, "20260601", 2, d)])
    rows = top_pages(pv, 2).collect()
    assert [(r.rank, r.title, r.share_pct) for r in rows] == [(1, "A", 0.0), (2, "B", 0.0)]


def test_title_daily_merges_spellings_and_skips_empty_days(spark):
    import datetime as dt

    d1, d2 = dt.date(2026, 7, 26), dt.date(2026, 7, 27)
    pv = _pv(
        spark,
        [
            ("fr", "Tour_Eiffel", 200, "20260726", 10, d1),
            ("fr.m", "Tour_Eiffel", 1000, "20260726", 11, d1),
            ("fr.m", "Tour_Eiffel", 90, "20260726", 12, d1),
            ("fr", "Tour_Eiffel", 5, "20260727", 0, d2),
            ("fr.m", "Tour_Eiffel", 17, "20260727", 0, d2),
            ("fr.m", "Sp%C3%A9cial:Tour", 1, "20260727", 0, d2),
            ("fr.b", "Tour_Eiffel", 50, "20260727", 0, d2),
        ],
    )
    rows = [tuple(r) for r in title_daily(pv, "Tour_Eiffel").collect()]
    assert rows == [(d1, 1290, 200, 1090), (d2, 22, 5, 17)]
    assert title_daily(pv, "Absent_Title").count() == 0


def test_titles_daily_equals_single_title_runs(spark):
    pv = fx.pageviews(spark, SMOKE_DIR)
    titles = spark.createDataFrame([("Sagrada_Família",), ("Spécial:U",), ("Nowhere",)], "title string")
    many = {(r.title, r.date): (r.views, r.views_desktop, r.views_mobile) for r in titles_daily(pv, titles).collect()}
    for t in ["Sagrada_Família", "Spécial:U", "Nowhere"]:
        single = {(t, r.date): (r.views, r.views_desktop, r.views_mobile) for r in title_daily(pv, t).collect()}
        assert {k: v for k, v in many.items() if k[0] == t} == single


def test_titles_daily_plans_without_a_job(spark):
    pv = fx.pageviews(spark, SMOKE_DIR)
    tracker = spark.sparkContext.statusTracker()
    before = tracker.getJobIdsForGroup(None)
    titles_daily(pv, pv.select("title").distinct())
    unknown_titles(pv.select("title"), pv.select("title"))
    assert tracker.getJobIdsForGroup(None) == before


def test_top_pages_of_another_project_pair(spark):
    rows = [("en", "A", 1), ("en.m", "A", 5), ("fr", "A", 9)]
    pv = spark.createDataFrame(rows, "project string, title string, views int")
    top = top_pages(pv, 10, ("en", "en.m"), mobile_projects=("en.m",)).first()
    assert (top.views, top.views_desktop, top.views_mobile) == (6, 1, 5)


def test_hourly_profile_invariants(spark):
    rows = hourly_profile(fx.pageviews(spark, ORACLE_DIR)).collect()
    assert [r.hour for r in rows] == list(range(24))
    assert abs(sum(r.share_pct for r in rows) - 100) < 0.1
    assert all(r.views_total == r.views_desktop + r.views_mobile for r in rows)
    assert all(0 <= r.mobile_share_pct <= 100 for r in rows)


def _final_plan(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("report", [lambda pv: top_pages(pv, 100), hourly_profile])
def test_reports_scan_input_once(spark, report):
    """One pass: the totals come from a window over the small result, not a second scan."""
    df = report(fx.pageviews(spark, SMOKE_DIR))
    df.collect()
    plan = _final_plan(df)
    assert plan.count("FileScan parquet") == 1, plan


def test_top_pages_plan_is_top_k(spark):
    df = top_pages(fx.pageviews(spark, SMOKE_DIR), 100)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_landed_plans_push_filters_and_prune_columns(spark, tmp_path):
    from trafficlens.sinks import land_pageviews, read_landed_pageviews

    path = str(tmp_path / "landed")
    land_pageviews(fx.pageviews(spark, SMOKE_DIR), path)
    pv = read_landed_pageviews(spark, path)

    daily = title_daily(pv, "Sagrada_Família")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(project, [fr,fr.m]), In(title, [Sagrada_Fam%C3%ADlia,Sagrada_Família])]" in daily
    assert "ReadSchema: struct<project:string,title:string,views:int>" in daily

    top = top_pages(pv, 100)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<project:string,title:string,views:int>" in top
    assert "In(project, [fr,fr.m])" in top


def test_text_scan_filters_projects_before_splitting(spark, tmp_path):
    from traffic_helpers import write_dump

    from trafficlens.sources import read_pageviews

    write_dump(tmp_path, "pageviews-20260601-000000.gz", ["fr A 1 0", "de B 2 0"])
    plan = top_pages(read_pageviews(spark, str(tmp_path / "*.gz"), projects=("fr", "fr.m")), 10)
    text = plan._jdf.queryExecution().sparkPlan().toString()
    before_split = text.split("Generate inline")[1]
    assert "StartsWith(value" in before_split


@pytest.mark.parametrize("report", [lambda pv: top_pages(pv, 100), hourly_profile, lambda pv: title_daily(pv, "A")])
def test_text_path_reads_the_dumps_once(spark, tmp_path, report):
    from traffic_helpers import write_dump

    from trafficlens.sources import read_pageviews

    write_dump(tmp_path, "pageviews-20260601-000000.gz", ["fr A 1 0", "fr.m B 2 0", "de C 3 0"])
    write_dump(tmp_path, "pageviews-20260601-010000.gz", ["fr A 4 0"])
    df = report(read_pageviews(spark, str(tmp_path / "*.gz"), projects=("fr", "fr.m")))
    df.collect()
    assert _final_plan(df).count("FileScan text") == 1
