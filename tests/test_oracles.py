"""Every registered query against its DuckDB oracle, and the driver contract."""

import re

import pytest
from traffic_helpers import SMOKE_DIR

import __spark_entry__ as entry
from oracle_harness import compare

# The corpus queries have tests of their own.
CORPUS = re.compile(r"op\d+_|pipeline$")
QUERIES = {k: v for k, v in entry.queries().items() if not CORPUS.match(k)}
ORACLES = {k: v for k, v in entry.oracle_sql().items() if not CORPUS.match(k)}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["rank", "title", "views", "views_desktop", "views_mobile", "share_pct"]
    assert 0 < len(rows) <= 100


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    result = compare(spark, name, SMOKE_DIR, QUERIES[name], ORACLES.get(name))
    assert result["match"], result
    assert not result["type_mismatches"], result


@pytest.fixture()
def ansi_off(spark):
    """ANSI mode is on by default, as in the test above."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    assert before == "true"
    spark.conf.set("spark.sql.ansi.enabled", "false")
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_core_queries_with_ansi_off(spark, ansi_off, name):
    result = compare(spark, name, SMOKE_DIR, QUERIES[name], ORACLES.get(name))
    assert result["match"], result


@pytest.mark.parametrize("tz", ["America/Sao_Paulo", "Europe/Paris"])
@pytest.mark.parametrize("name", ["runs_load", "pv_file_hours", "coverage_gaps_by_project", "coverage_calendar", "metric_rate"])
def test_time_queries_do_not_depend_on_session_zone(spark, tz, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        result = compare(spark, name, SMOKE_DIR, QUERIES[name], ORACLES.get(name))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert result["match"], result


FORBIDDEN_NODES = (
    "BatchEvalPython",  # row-at-a-time Python UDF
    "ArrowEvalPython",  # pandas UDF
    "MapInPandas",
    "FlatMapGroupsInPandas",
    "CartesianProduct",  # cross join
    "BroadcastNestedLoopJoin",  # non-equi / cross join
)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_stay_in_the_jvm_and_have_no_cross_joins(spark, name):
    plan = QUERIES[name](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in FORBIDDEN_NODES if n in plan], plan
