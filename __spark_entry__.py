"""

Every query reads the driver's test tables (page views, runs and metric samples
are derived from ``events`` / ``lineitem`` by ``trafficlens.fixtures``) and runs
over whole tables. SQL oracles live in ``oracles.py``.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

# The package and the oracles live next to this file; make them importable however it is loaded.
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracles
from trafficlens import fixtures as fx
from trafficlens.operators import filters as flt
from trafficlens.operators.platform import add_platform
from trafficlens.plans import coverage as cov
from trafficlens.plans import instant
from trafficlens.plans import metrics as mx
from trafficlens.plans import runs as runstats
from trafficlens.plans import traffic
from trafficlens.functions.csvformat import CSV_OPTIONS
from trafficlens.session import shared_path
from trafficlens.sinks import landing, results, rollups
from trafficlens.sources import health
from trafficlens.sources import pageviews as src
from trafficlens.sources.tables import calendar_spanning, clean_titles, hourly_calendar, read_committed_runs, read_runs, read_titles

try:
    import corpus_pipeline
    from trafficlens.llm import registry as llm_registry
except ModuleNotFoundError as error:
    if error.name not in ("corpus_pipeline", "trafficlens.llm"):
        raise
    corpus_pipeline = llm_registry = None

SMOKE_DIR = "/root/testdata/sf0.001"
MONUMENT = oracles.MONUMENT


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: top 100 articles of the page-view dumps derived from sf0.001."""
    return traffic.top_pages(fx.pageviews(spark, SMOKE_DIR), 100)


UNKNOWN_TITLE = oracles.UNKNOWN_TITLE


def _reference_titles(pv: DataFrame) -> DataFrame:
    """Reference list: every title seen on desktop, trimmed, non-empty, distinct."""
    return clean_titles(fx.titles_from(pv, "fr"))


def _titles_from_csv(pv: DataFrame) -> DataFrame:
    """The reference list written as a CSV with another column before the titles, and read by name."""
    spark = pv.sparkSession
    path = shared_path(spark, "titles")
    seen = fx.titles_from(pv, "fr")
    seen.select(F.length("title").alias("id"), "title", F.lit('a, "b"').alias("note")).write.options(**CSV_OPTIONS).csv(path)
    return read_titles(spark, path)


def _runs_from_csv(runs: DataFrame) -> DataFrame:
    """The run manifest written as a CSV with its columns reversed and one more, and read by name."""
    spark = runs.sparkSession
    path = shared_path(spark, "runs")
    columns = [c for c in reversed(RUN_COLUMNS) if c != "family"]
    runs.select(*columns, F.lit('x, "y"').alias("note")).write.options(**CSV_OPTIONS).csv(path)
    return read_runs(spark, path).select(*RUN_COLUMNS)


# A whole manifest is written as gzip, at the level that takes no longer than plain text. One task
# reads a gzip file, and files are dealt to tasks by their compressed bytes, so a file's rows are bounded.
MANIFEST_OPTIONS = CSV_OPTIONS | {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "250000"}


def _committed_runs(runs: DataFrame) -> DataFrame:
    """The run manifest written twice, as a compaction that was interrupted leaves it, and each run read once."""
    spark = runs.sparkSession
    path = shared_path(spark, "runs")
    for _ in range(2):
        runs.drop("family").write.mode("append").options(**MANIFEST_OPTIONS).csv(path)
    return read_committed_runs(spark, path).select(*RUN_COLUMNS)


_written_dumps: dict[tuple[str, str], str] = {}


def _dumps(spark: SparkSession, d: str) -> str:
    """Real gzip dumps in the shared folder, written once for an application and table folder; returns their glob."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _written_dumps:
        path = shared_path(spark, "dumps")
        fx.write_dumps(spark, d, path)
        _written_dumps[key] = path + "/dumps/*.gz"
    return _written_dumps[key]


def _damaged_dumps(spark: SparkSession, d: str) -> DataFrame:
    """The listing of real dumps of which one is truncated and one has a wrong checksum."""
    path = shared_path(spark, "dumps")
    fx.write_dumps(spark, d, path)
    fx.damage_dumps(spark, path)
    return src.list_dumps(spark, path + "/dumps/*.gz")


def _intact_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Calendar hours without an intact dump."""
    hours = cov.observed_hours(src.dump_hours(health.intact_dumps(_damaged_dumps(spark, d))))
    return cov.coverage_gaps(hours, CAL_START, CAL_DAYS)


def _opened_dumps(spark: SparkSession, d: str) -> DataFrame:
    """How many dumps a range of hours opens, and how many there are."""
    path = _dumps(spark, d)
    opened = src.dump_count(src.list_dumps(spark, path, hours=oracles.HOURS)).select(F.col("input_files").alias("opened"))
    return opened.select("opened", src.dump_count(src.list_dumps(spark, path)).scalar().alias("listed"))


def _calendar_hours(spark: SparkSession, d: str) -> DataFrame:
    """Every expected hour, and whether a dump has it."""
    seen = _file_hours(spark, d).withColumn("present", F.lit(True))
    expected = hourly_calendar(spark, CAL_START, CAL_DAYS)
    return expected.join(seen, "hour_ts", "left").select("day", "hour", F.coalesce("present", F.lit(False)).alias("present"))


def _requested_titles(pv: DataFrame) -> DataFrame:
    """Requested list: every title seen on mobile plus one absent title."""
    return fx.titles_from(pv, "fr.m", (UNKNOWN_TITLE,))


def _dump_titles_daily(spark: SparkSession, d: str) -> DataFrame:
    """Daily views of the requested titles from real dumps, whose lines are sieved before they are parsed."""
    requested = _requested_titles(fx.pageviews(spark, d))
    pv = src.read_pageviews(spark, _dumps(spark, d), title_list=traffic.requested_spellings(requested))
    return traffic.titles_daily(pv, requested)


def _runs(fn):
    return lambda spark, d: fn(fx.runs(spark, d))


RUN_COLUMNS = ("run_id", "ts_utc", "job", "month", "parallelism", "duration_s", "rows_in", "rows_out", "family")


# Calendar of the dataset (the download parameters: first day and number of days).
CAL_START, CAL_DAYS = oracles.CAL_START, oracles.CAL_DAYS
RATE_WINDOW, RATE_STEP = oracles.RATE_WINDOW, oracles.RATE_STEP


def _file_hours(spark: SparkSession, d: str) -> DataFrame:
    return cov.observed_hours(src.file_hours(fx.pageview_lines(spark, d)))


def _project_hours(spark: SparkSession, d: str) -> DataFrame:
    return cov.observed_hours(fx.pageviews(spark, d), ["project"])


def _samples(fn):
    return lambda spark, d: fn(fx.samples(spark, d))


def _csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Top pages written as one CSV file in the shared folder and read back with its schema."""
    top = traffic.top_pages(fx.pageviews(spark, d), 100)
    path = shared_path(spark, "csv_roundtrip")
    results.write_result(top, path, fmt="csv", single_file=True)
    return results.read_result_csv(spark, path, top.schema)


def _observed_counts(spark: SparkSession, d: str) -> DataFrame:
    """Input and output row counts of one top-pages run, gathered by its single write."""
    pv, seen = results.observe_rows(fx.pageviews(spark, d), "pv_in")
    rows_out = results.write_result(
        traffic.top_pages(pv, 100), shared_path(spark, "observed_counts"), single_file=True
    )
    rows_in = int(seen.get.get("rows", -1))
    return spark.createDataFrame([(rows_in, rows_out)], "rows_in bigint, rows_out bigint")


def _landed(spark: SparkSession, d: str) -> DataFrame:
    """Page views landed twice as Parquet by date and hour in the shared folder, read back."""
    path = shared_path(spark, "landed")
    for _ in range(2):
        landing.land_pageviews(fx.pageviews(spark, d), path)
    return landing.read_landed_pageviews(spark, path)


def _clustered(spark: SparkSession, d: str) -> DataFrame:
    """Page views landed by hour, then clustered by title within each date; the last date is clustered twice."""
    landed, path = shared_path(spark, "landed"), shared_path(spark, "clustered")
    pv = fx.pageviews(spark, d)
    landing.land_pageviews(pv, landed)
    landing.cluster_dates(spark, landed, path)
    landing.cluster_dates(spark, landed, path, rollups.dates_of(pv)[-1:])
    return landing.read_landed_pageviews(spark, path)


def _rolled(spark: SparkSession, d: str) -> str:
    """Roll-ups of a landing that lacks its last hour, refreshed after that hour has landed; returns their path."""
    landed, path = shared_path(spark, "landed"), shared_path(spark, "rolled")
    pv = fx.pageviews(spark, d)
    last = pv.agg(F.max(F.struct("date", "hour"))).first()[0]
    is_last = (F.col("date") == F.lit(last["date"])) & (F.col("hour") == last["hour"])
    for part in (pv.where(~is_last), pv.where(is_last)):
        landing.land_pageviews(part, landed)
        rollups.refresh_rollups(spark, landed, path, rollups.dates_of(part))
    return path


def _pv(fn):
    return lambda spark, d: fn(fx.pageviews(spark, d))


def _lines(fn):
    return lambda spark, d: fn(fx.pageview_lines(spark, d))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        # scan and file-name columns
        "pv_scan": _pv(lambda pv: pv),
        "pv_malformed": _lines(src.malformed_counts),
        "pv_file_hours": _lines(src.file_hours),
        "pv_input_files": _lines(src.input_file_count),
        # real gzip dumps: scan, and file questions from the listing
        "dump_scan": lambda spark, d: src.read_pageviews(spark, _dumps(spark, d)),
        "dump_hours": lambda spark, d: src.dump_hours(src.list_dumps(spark, _dumps(spark, d))),
        "dump_count": lambda spark, d: src.dump_count(src.list_dumps(spark, _dumps(spark, d))),
        # filters
        "pv_project_filter": _pv(flt.only_projects),
        "pv_drop_home": _pv(flt.drop_home_pages),
        "pv_drop_namespaces": _pv(flt.drop_namespaces),
        "pv_drop_empty": _pv(flt.drop_empty_titles),
        "pv_clean": _pv(flt.clean_pages),
        "pv_platform": _pv(lambda pv: add_platform(flt.only_projects(pv))),
        "title_match": _pv(lambda pv: flt.match_title(pv, MONUMENT)),
        # title lists and joins
        "reference_titles": _pv(_titles_from_csv),
        "title_variants": _pv(lambda pv: flt.expand_title_variants(_reference_titles(pv))),
        "unknown_titles": _pv(lambda pv: flt.unknown_titles(_requested_titles(pv), _reference_titles(pv))),
        "titles_daily": _pv(
            lambda pv: traffic.titles_daily(pv, _reference_titles(pv).unionByName(_requested_titles(pv)))
        ),
        "dump_titles_daily": _dump_titles_daily,
        # a range of hours, and damaged dumps
        "dump_scan_of_hours": lambda spark, d: src.read_pageviews(spark, _dumps(spark, d), hours=oracles.HOURS),
        "dumps_opened": _opened_dumps,
        "dump_states": lambda spark, d: health.dump_states(_damaged_dumps(spark, d)).select("file_name", "day", "hour", "state"),
        "coverage_intact": _intact_coverage,
        # run manifest statistics
        "runs_load": _runs(_runs_from_csv),
        "runs_committed": _runs(_committed_runs),
        "run_ordinal": _runs(
            lambda r: runstats.run_ordinal(r).select("ordinal", "run_id", "ts_utc", "job", "duration_s")
        ),
        "run_families": _runs(runstats.run_families),
        "run_summary": _runs(runstats.run_summary),
        "run_scaling": _runs(runstats.run_scaling),
        # dataset coverage against the hourly calendar
        "coverage_calendar": lambda spark, d: calendar_spanning(_file_hours(spark, d)).select("day", "hour"),
        "calendar_hours": _calendar_hours,
        "coverage_gaps": lambda spark, d: cov.coverage_gaps(_file_hours(spark, d), CAL_START, CAL_DAYS),
        "coverage_summary": lambda spark, d: cov.coverage_summary(_file_hours(spark, d), CAL_START, CAL_DAYS),
        "coverage_gaps_by_project": lambda spark, d: cov.coverage_gaps(
            _project_hours(spark, d), CAL_START, CAL_DAYS, ["project"]
        ),
        "coverage_summary_by_project": lambda spark, d: cov.coverage_summary(
            _project_hours(spark, d), CAL_START, CAL_DAYS, ["project"]
        ),
        # metric samples
        "metric_samples": _samples(lambda s: s),
        "metric_latest": _samples(mx.latest),
        "metric_latest_sum": _samples(mx.latest_sum),
        "metric_sum_of_two": _samples(lambda s: mx.sum_of_two(s, "view", "click")),
        "metric_rate": _samples(lambda s: mx.counter_rate(s, RATE_WINDOW, RATE_STEP)),
        "metric_rate_signed": _samples(lambda s: mx.counter_rate(s, RATE_WINDOW, RATE_STEP, sign=-1)),
        "metric_instant": _samples(
            lambda s: instant.instant_values(s, oracles.INSTANT_STEP, oracles.INSTANT_LOOKBACK)
        ),
        "metric_instant_sum": _samples(
            lambda s: instant.instant_sum(s, oracles.INSTANT_STEP, oracles.INSTANT_LOOKBACK)
        ),
        "metric_instant_at": _samples(
            lambda s: instant.instant_at(s, oracles.INSTANT_AT, oracles.INSTANT_LOOKBACK)
        ),
        "metric_rate_edges": _samples(lambda s: instant.extrapolated_rate(s, RATE_WINDOW, RATE_STEP)),
        "metric_rate_edges_sum": _samples(lambda s: instant.extrapolated_rate_sum(s, RATE_WINDOW, RATE_STEP)),
        "metric_sum_by_label": _samples(lambda s: mx.sum_by_label(s, RATE_STEP)),
        "metric_label_regex": _samples(lambda s: mx.label_matches(mx.latest(s), "name", oracles.LABEL_PATTERN)),
        "metric_reduce": _samples(lambda s: mx.reduce_series(mx.sum_by_label(s, RATE_STEP))),
        # sinks
        "csv_roundtrip": _csv_roundtrip,
        "observed_counts": _observed_counts,
        "pv_landed": _landed,
        "landed_top_pages": lambda spark, d: traffic.top_pages(_landed(spark, d), 100),
        "pv_clustered": _clustered,
        "clustered_title_daily": lambda spark, d: traffic.title_daily(_clustered(spark, d), MONUMENT),
        "rollup_top_pages": lambda spark, d: traffic.top_pages(rollups.read_rolled_titles(spark, _rolled(spark, d)), 100),
        "rollup_title_daily": lambda spark, d: traffic.title_daily(
            rollups.read_rolled_titles(spark, _rolled(spark, d)), MONUMENT
        ),
        "rollup_hourly_profile": lambda spark, d: traffic.profile_of_hours(
            traffic.merged_hours(rollups.read_rolled_hours(spark, _rolled(spark, d)))
        ),
        # aggregates and reports
        "views_by_title": _pv(traffic.views_by_title),
        "views_by_hour": _pv(traffic.views_by_hour),
        "top_pages": _pv(lambda pv: traffic.top_pages(pv, 100)),
        "top_pages_other_projects": _pv(lambda pv: traffic.top_pages(pv, 100, ("en", "fr.b"), mobile_projects=("fr.b",))),
        "title_daily": _pv(lambda pv: traffic.title_daily(pv, MONUMENT)),
        "hourly_profile": _pv(traffic.hourly_profile),
    }
    if llm_registry is not None:
        q |= llm_registry.queries()
        q["pipeline"] = corpus_pipeline.run
    return q


def oracle_sql() -> dict[str, str]:
    sql = oracles.all_oracles()
    if llm_registry is not None:
        sql |= llm_registry.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql


__all__ = ["entry", "queries", "oracle_sql"]
