"""Roll-ups refreshed as hours land, and landed hours clustered by title."""

import datetime as dt
import os

from pyspark.sql import functions as F
from traffic_helpers import collected_plan

from trafficlens.plans import traffic
from trafficlens.sinks import landing, rollups

PV = "project string, title string, views int, day string, hour int, date date"


def views(spark, rows):
    full = [(p, t, v, d.strftime("%Y%m%d"), h, d) for p, t, v, d, h in rows]
    return spark.createDataFrame(full, PV)


def month_of_views(spark, titles=3_000):
    """Two dates of 24 hours, every title in every hour."""
    rows = spark.range(titles).crossJoin(spark.range(48).withColumnRenamed("id", "h"))
    date = F.date_add(F.lit(dt.date(2024, 1, 31)), (F.col("h") / 24).cast("int"))
    return rows.select(
        F.lit("fr").alias("project"), F.format_string("T%05d", "id").alias("title"), F.lit(1).alias("views"),
        F.date_format(date, "yyyyMMdd").alias("day"), (F.col("h") % 24).cast("int").alias("hour"), date.alias("date"),
    ).repartition(24, "date", "hour")


D1, D2, D3 = dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date(2024, 2, 2)


def test_refresh_replaces_only_the_dates_given(spark, tmp_path):
    landed, path = f"{tmp_path}/landed", f"{tmp_path}/rolled"
    first = views(spark, [("fr", "A", 3, D1, 5), ("fr.m", "A", 2, D1, 5), ("fr", "Spécial:X", 9, D1, 6), ("en", "A", 7, D1, 5), ("fr", "A", 1, D2, 5)])
    landing.land_pageviews(first, landed)
    rollups.refresh_rollups(spark, landed, path, rollups.dates_of(first))
    more = views(spark, [("fr", "A", 10, D2, 6), ("fr", "B", 4, D3, 5)])
    landing.land_pageviews(more, landed)
    # A landing of the same hour again replaces it; the refresh counts it once.
    landing.land_pageviews(views(spark, [("fr", "A", 11, D2, 6)]), landed)
    untouched = sorted(os.listdir(f"{path}/titles/date=2024-01-31"))
    rollups.refresh_rollups(spark, landed, path, [D2, D3])
    assert sorted(os.listdir(f"{path}/titles/date=2024-01-31")) == untouched
    titles = rollups.read_rolled_titles(spark, path)
    assert {tuple(r) for r in titles.collect()} == {
        ("fr", "A", 3, D1), ("fr.m", "A", 2, D1), ("fr", "Spécial:X", 9, D1), ("fr", "A", 12, D2), ("fr", "B", 4, D3)
    }
    pv = landing.read_landed_pageviews(spark, landed)
    for report in (traffic.views_by_title, lambda f: traffic.title_daily(f, "A"), lambda f: traffic.top_pages(f, 5)):
        assert sorted(map(tuple, report(titles).collect())) == sorted(map(tuple, report(pv).collect()))
    merged = traffic.merged_hours(rollups.read_rolled_hours(spark, path))
    assert sorted(map(tuple, merged.select("hour", "views_total", "n_days", "views_desktop", "views_mobile").collect())) == sorted(
        map(tuple, traffic.views_by_hour(pv).select("hour", "views_total", "n_days", "views_desktop", "views_mobile").collect())
    )
    assert {r["hour"]: r["n_days"] for r in merged.collect()} == {5: 3, 6: 1}


def test_days_merge_by_bits(spark, tmp_path):
    """The same day of two months counts twice, a day seen by two projects once."""
    landed, path = f"{tmp_path}/landed", f"{tmp_path}/rolled"
    rows = [(p, "A", 1, dt.date(2024, m, day), 0) for p in ("fr", "fr.m") for m in (1, 2) for day in (1, 29)]
    landing.land_pageviews(views(spark, rows), landed)
    rollups.refresh_rollups(spark, landed, path, sorted({r[3] for r in rows}))
    merged = traffic.merged_hours(rollups.read_rolled_hours(spark, path))
    assert [(r["views_total"], r["n_days"]) for r in merged.collect()] == [(8, 4)]
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "count(distinct" not in plan.lower()


def test_refresh_reads_only_its_dates(spark, tmp_path):
    landed = f"{tmp_path}/landed"
    landing.land_pageviews(month_of_views(spark, 50), landed)
    pv = landing.read_landed_pageviews(spark, landed).where(F.col("date").isin([D2]))
    _, nodes = collected_plan(pv)
    scan = next(m for name, _, m in nodes if name.startswith("Scan"))
    assert scan["numFiles"] == 24 and scan["numPartitions"] == 24
    rollups.refresh_rollups(spark, landed, f"{tmp_path}/rolled", [])  # nothing to do, nothing written


def test_a_title_lookup_reads_fewer_row_groups_than_the_landed_hours(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    landed, path = f"{tmp_path}/landed", f"{tmp_path}/clustered"
    pv = month_of_views(spark)
    landing.land_pageviews(pv, landed)
    assert landing.cluster_dates(spark, landed, path) == pv.count()

    def holding(folder, title):
        found = 0
        for file in glob.glob(f"{folder}/**/*.parquet", recursive=True):
            meta = pq.ParquetFile(file).metadata
            for g in range(meta.num_row_groups):
                columns = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c) for c in range(meta.num_columns)}
                s = columns["title"].statistics
                found += s.min <= title <= s.max
        return found

    assert holding(landed, "T01234") == 48 and holding(path, "T01234") <= 4
    rows = {}
    for folder in (landed, path):
        report = traffic.title_daily(landing.read_landed_pageviews(spark, folder), "T01234")
        result = sorted(map(tuple, report.collect()))
        _, nodes = collected_plan(traffic.title_daily(landing.read_landed_pageviews(spark, folder), "T01234"))
        scans = [m for name, _, m in nodes if name.startswith("Scan")]
        rows[folder] = result, scans[0]["numOutputRows"], scans[0]["numFiles"]
    assert rows[landed][0] == rows[path][0] == [(D1, 24, 24, 0), (D2, 24, 24, 0)]
    assert rows[path][1] < rows[landed][1] / 3 and rows[path][2] < rows[landed][2]
    assert sorted(map(tuple, landing.read_landed_pageviews(spark, path).collect())) == sorted(map(tuple, pv.collect()))


def test_clustered_files_have_bloom_filters_and_replace_dates(spark, tmp_path):
    import glob

    landed, path = f"{tmp_path}/landed", f"{tmp_path}/clustered"
    landing.land_pageviews(views(spark, [("fr", "A", 3, D1, 5), ("fr", "B", 1, D2, 5)]), landed)
    landing.cluster_dates(spark, landed, path)
    landing.land_pageviews(views(spark, [("fr", "A", 4, D1, 6)]), landed)
    landing.cluster_dates(spark, landed, path, [D1])
    got = sorted((r["title"], r["views"], r["hour"], r["date"]) for r in landing.read_landed_pageviews(spark, path).collect())
    assert got == [("A", 3, 5, D1), ("A", 4, 6, D1), ("B", 1, 5, D2)]
    # A dictionary of a chunk's titles rules out others by itself; where titles hardly repeat, the filter does.
    rows = [("fr", f"A page of its own, number {k}", 1, D1, 5) for k in range(20_000)]
    landing.land_pageviews(views(spark, rows), landed)
    landing.cluster_dates(spark, landed, path, [D1])
    file = max(glob.glob(f"{path}/date=2024-01-31/*.parquet"), key=os.path.getsize)
    footer = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
        spark._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
            spark._jvm.org.apache.hadoop.fs.Path(file), spark.sparkContext._jsc.hadoopConfiguration()
        )
    )
    try:
        columns = footer.getFooter().getBlocks().get(0).getColumns()
        with_filter = [c.getPath().toDotString() for c in columns if c.getBloomFilterOffset() > 0]
    finally:
        footer.close()
    assert with_filter == ["title"]
