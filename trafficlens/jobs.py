"""The three reports as commands.

    spark-submit jobs... python -m trafficlens.jobs top100 2026-07 [--count-in]
    python -m trafficlens.jobs monument 2026-07 Tour_Eiffel [--force] [--count-in]
    python -m trafficlens.jobs circadian 2026-07 [--count-in]

``--raw`` holds a folder of dumps per month; a run writes ``result/result.csv`` and
``meta`` under a folder of its own in ``--out`` and appends to ``--runs``.
"""

from __future__ import annotations

import argparse
import posixpath
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .functions.constants import DEFAULT_PROJECTS
from .functions.encoding import title_spellings
from .operators.filters import check_titles
from .plans.traffic import hourly_profile, title_daily, top_pages
from .sinks.manifest import RunContext
from .sources.pageviews import pageview_glob, read_pageviews
from .sources.tables import read_titles

TOP_N = 100


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("month", help="month of dumps to read, e.g. 2026-07")
    shared.add_argument("--count-in", action="store_true", help="count every scanned row, all projects included")
    shared.add_argument("--raw", default="data/raw", help="folder that holds one folder of dumps per month")
    shared.add_argument("--out", default="data/out", help="folder of the results")
    shared.add_argument("--runs", default="data/runs", help="folder of the run manifest")
    parser = argparse.ArgumentParser(prog="trafficlens.jobs")
    reports = parser.add_subparsers(dest="report", required=True)
    reports.add_parser("top100", parents=[shared], help="the most viewed articles")
    reports.add_parser("circadian", parents=[shared], help="views by hour of day")
    title = reports.add_parser("monument", parents=[shared], help="daily views of one title")
    title.add_argument("title", help="exact title, underscores and accents included")
    title.add_argument("--titles", default="data/monuments.csv", help="CSV of known titles")
    title.add_argument("--force", action="store_true", help="accept a title that the list lacks")
    return parser.parse_args(argv)


def _report(args: argparse.Namespace) -> tuple[str, Callable[[DataFrame], DataFrame], list[str] | None]:
    """Job name, plan over the page views, and the title spellings that a line must hold."""
    if args.report == "monument":
        return f"monument_{args.title}", lambda pv: title_daily(pv, args.title), title_spellings(args.title)
    if args.report == "circadian":
        return "circadian", hourly_profile, None
    return "top100", lambda pv: top_pages(pv, TOP_N), None


def run(spark: SparkSession, args: argparse.Namespace) -> RunContext:
    """Run one report; returns its finished run."""
    if args.report == "monument":
        asked = spark.createDataFrame([(args.title,)], "title string")
        check_titles(asked, read_titles(spark, args.titles), args.force)
    job, plan, titles = _report(args)
    glob = pageview_glob(args.raw, args.month)
    with RunContext(spark, job, args.month, args.out, args.runs, inputs=glob) as current:
        if args.count_in:
            # Rows are counted as scanned, so the scan may not leave any out.
            pv = current.observe_input(read_pageviews(spark, glob))
        else:
            pv = read_pageviews(spark, glob, projects=DEFAULT_PROJECTS, titles=titles)
        rows = current.write(plan(pv), fmt="csv", single_file=True, file_name="result.csv")
    print(f"{current.run_id}: {rows} rows in {posixpath.join(current.outdir, 'result', 'result.csv')}")
    if args.report == "monument" and rows == 0:
        print(f"no view of {args.title!r}: check its exact spelling (underscores, accents)")
    return current


def main(argv: list[str] | None = None) -> int:
    args = arguments(argv)
    spark = SparkSession.builder.appName(f"trafficlens-{args.report}-{args.month}").getOrCreate()
    try:
        run(spark, args)
    except ValueError as error:
        raise SystemExit(str(error)) from error
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
