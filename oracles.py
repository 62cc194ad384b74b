"""DuckDB SQL oracles, one per registered query.

Each string runs on the driver's pre-registered views (``events``, ``lineitem``,
…). Fixture tables are rebuilt here in SQL without the Spark line parser, and
aggregates are aliased and cast so names and types line up with the Spark side
(sums as ``bigint``, shares as ``double``, ranks as ``int``).
"""

from __future__ import annotations

from trafficlens.fixtures import LINES_SQL, PV_SQL, RUNS_SQL, SAMPLES_SQL


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


# The cleaning rules written out again, apart from the library: fixed values of the dump format.
PREFIXES = (
    "Spécial", "Special", "Spezial", "Wikipédia", "Wikipedia", "Catégorie", "Category", "Utilisateur", "Utilisatrice", "User",
    "Fichier", "File", "Image", "MediaWiki", "Modèle", "Template", "Aide", "Help", "Portail", "Portal", "Projet", "Project",
    "Référence", "Module", "Sujet", "Gadget", "Gadget_definition", "TimedText", "Média", "Media",
)
HOMES = (
    "-", "Accueil_principal", "Wikipédia:Accueil_principal", "Wikipedia:Accueil_principal", "Main_Page", "Page_d'accueil",
    "Portail:Accueil", "Special:Search", "Spécial:Recherche",
)
_HOME_LIST = ", ".join(f"{lit(p)}, url_encode({lit(p)})" for p in HOMES)
_PREFIX_TESTS = " or ".join(
    f"starts_with(title, {spelling} || {separator})"
    for p in PREFIXES
    for spelling in (lit(p), f"url_encode({lit(p)})")
    for separator in ("':'", "'%3A'", "'%3a'")
)
# A talk title: nothing between "Discussion" and the first separator but characters other than colon and percent.
_TALK_REST = "substr(title, 11)"
_TALK_STOP = f"ltrim({_TALK_REST}, replace(replace({_TALK_REST}, ':', ''), '%', ''))"
_TALK_TEST = (
    "(starts_with(title, 'Discussion') and ("
    f"starts_with({_TALK_STOP}, ':') or starts_with({_TALK_STOP}, '%3A') or starts_with({_TALK_STOP}, '%3a')))"
)

PLATFORM = "case when project = 'fr.m' then 'mobile' else 'desktop' end"
SPLIT = (
    "cast(sum(views) as bigint) as {total}, "
    "cast(sum(case when platform = 'desktop' then views else 0 end) as bigint) as views_desktop, "
    "cast(sum(case when platform = 'mobile' then views else 0 end) as bigint) as views_mobile"
)


def ctes(**parts: str) -> str:
    return "with " + ",\n".join(f"{k} as ({v})" for k, v in parts.items()) + "\n"


PROJECT_FILTER = "project in ('fr', 'fr.m')"
HOME_FILTER = f"title not in ({_HOME_LIST})"
NS_FILTER = f"not ({_PREFIX_TESTS} or {_TALK_TEST})"
EMPTY_FILTER = "length(title) > 0"
CLEAN = f"{PROJECT_FILTER} and {HOME_FILTER} and {NS_FILTER} and {EMPTY_FILTER}"

BASE = {
    "pv": PV_SQL,
    "clean": f"select *, {PLATFORM} as platform from pv where {CLEAN}",
}


def _share(col: str, digits: int) -> str:
    return (
        f"round(cast(100 as double) * {col} / coalesce(nullif(sum({col}) over (), 0), 1), {digits})"
    )


TOP_CTES = ctes(
    **BASE,
    agg=f"select title, {SPLIT.format(total='views')} from clean group by title",
    top="select * from agg order by views desc, title asc limit 100",
)
TOP_PAGES = TOP_CTES + (
    "select cast(row_number() over (order by views desc, title asc) as int) as rank, title, views, "
    f"views_desktop, views_mobile, {_share('views', 3)} as share_pct from top"
)

VIEWS_BY_TITLE = ctes(**BASE) + f"select title, {SPLIT.format(total='views')} from clean group by title"

VIEWS_BY_HOUR = ctes(**BASE) + (
    f"select hour, {SPLIT.format(total='views_total')}, count(distinct date) as n_days from clean group by hour"
)

HOURLY_PROFILE = ctes(
    **BASE,
    h=f"select hour, {SPLIT.format(total='views_total')}, count(distinct date) as n_days from clean group by hour",
) + (
    "select hour, views_total, round(views_total / greatest(n_days, 1)) as views_avg_day, "
    "views_desktop, views_mobile, "
    "round(case when views_total = 0 then null else cast(100 as double) * views_mobile / views_total end, 2) "
    "as mobile_share_pct, "
    f"{_share('views_total', 3)} as share_pct from h"
)

MONUMENT = "Sagrada_Família"
UNKNOWN_TITLE = "Tour_Eiffel"

REF_TITLES = "select distinct trim(title) as title from pv where project = 'fr' and trim(title) <> ''"
REQ_TITLES = f"select title from pv where project = 'fr.m' union all select {lit(UNKNOWN_TITLE)}"
TITLE_LISTS = {"pv": PV_SQL, "ref": REF_TITLES, "req": REQ_TITLES}
VARIANTS = "select distinct title, unnest([title, url_encode(title)]) as variant from ({src})"

TITLE_VARIANTS = ctes(**TITLE_LISTS) + "select distinct title, variant from (" + VARIANTS.format(src="select title from ref") + ")"
UNKNOWN_TITLES = ctes(**TITLE_LISTS) + (
    "select distinct title from req where not exists (select 1 from ref where ref.title = req.title)"
)


def _titles_daily(requested: str) -> str:
    return ctes(
        **TITLE_LISTS,
        v=VARIANTS.format(src=requested),
        hits=f"select v.title, pv.date, pv.views, {PLATFORM} as platform from pv join v on pv.title = v.variant "
        f"where {PROJECT_FILTER}",
    ) + f"select title, date, {SPLIT.format(total='views')} from hits group by title, date"


TITLES_DAILY = _titles_daily("select title from ref union select title from req")


def _title_daily(title: str) -> str:
    spellings = f"({lit(title)}, url_encode({lit(title)}))"
    return ctes(
        pv=PV_SQL,
        hits=f"select *, {PLATFORM} as platform from pv where {PROJECT_FILTER} and title in {spellings}",
    ) + f"select date, {SPLIT.format(total='views')} from hits group by date"


def _pv_where(where: str, platform: bool = False) -> str:
    extra = f", {PLATFORM} as platform" if platform else ""
    return ctes(pv=PV_SQL) + f"select project, title, views, day, hour, date{extra} from pv where {where}"


LINES = {"lines": LINES_SQL}


RUNS = {"runs": RUNS_SQL}
RUN_RANKS = (
    "select family, parallelism, duration_s, "
    "row_number() over (partition by family, parallelism order by duration_s) - 1 as rk, "
    "count(*) over (partition by family, parallelism) as cnt from runs"
)
RUN_SUMMARY = ctes(
    **RUNS,
    rk_all=RUN_RANKS,
    mid="select family, parallelism, avg(duration_s) as median_s from rk_all "
    "where rk = (cnt - 1) // 2 or rk = cnt // 2 group by family, parallelism",
    st="select family, parallelism, count(*) as n, min(duration_s) as min_s, max(duration_s) as max_s "
    "from runs group by family, parallelism",
) + (
    "select st.family, st.parallelism, st.n, mid.median_s, st.min_s, st.max_s, "
    "case when st.n > 1 then (st.max_s - st.min_s) / mid.median_s * 100 else 0.0 end as spread_pct "
    "from st join mid using (family, parallelism)"
)
RUN_SCALING = ctes(
    **RUNS,
    rk_all=RUN_RANKS,
    mid="select family, parallelism, avg(duration_s) as median_s from rk_all "
    "where rk = (cnt - 1) // 2 or rk = cnt // 2 group by family, parallelism",
    b="select *, first_value(parallelism) over w as p0, first_value(median_s) over w as m0 from mid "
    "window w as (partition by family order by parallelism)",
    c="select *, m0 / median_s as speedup, parallelism / p0 as nn from b",
) + (
    "select family, parallelism, median_s, speedup, speedup / nn as efficiency, "
    "case when nn = 1 then null when speedup = 0 then 0.0 "
    "else greatest(((nn / speedup) - 1) / (nn - 1), 0.0) end as seq_fraction from c"
)


# The calendar ends after the data, so hours must be missing.
CAL_START, CAL_DAYS = "2024-01-01", 40
CAL_SQL = (
    "select unnest(generate_series(timestamp '2024-01-01 00:00:00', "
    "timestamp '2024-01-01 00:00:00' + interval 40 day - interval 1 hour, interval 1 hour)) as hour_ts"
)
FILE_HOURS = (
    "select distinct cast(strptime(day, '%Y%m%d') as timestamp) + to_hours(hour) as hour_ts "
    "from lines where file_name <> 'other.gz'"
)
PROJECT_HOURS = "select distinct project, cast(date as timestamp) + to_hours(hour) as hour_ts from pv"
COVERAGE = {"lines": LINES_SQL, "pv": PV_SQL, "cal": CAL_SQL}
DAY_HOUR = "strftime(c.hour_ts, '%Y%m%d') as day, cast(hour(c.hour_ts) as int) as hour"
COVERAGE_GAPS = ctes(**COVERAGE, obs=FILE_HOURS) + (
    f"select {DAY_HOUR} from cal c where c.hour_ts not in (select hour_ts from obs)"
)
COVERAGE_SUMMARY = ctes(**COVERAGE, obs=FILE_HOURS) + (
    "select cast(960 as bigint) as expected, count(*) as present, cast(960 - count(*) as bigint) as missing, "
    "count(*) = 960 as complete from obs where hour_ts in (select hour_ts from cal)"
)
COVERAGE_GAPS_BY_PROJECT = ctes(
    **COVERAGE,
    obs=PROJECT_HOURS,
    keys="select distinct project from obs",
) + (
    f"select k.project, {DAY_HOUR} from keys k cross join cal c "
    "where not exists (select 1 from obs o where o.project = k.project and o.hour_ts = c.hour_ts)"
)
COVERAGE_SUMMARY_BY_PROJECT = ctes(
    **COVERAGE,
    obs=f"select *, hour_ts in (select hour_ts from cal) as expected_hour from ({PROJECT_HOURS})",
) + (
    "select project, cast(960 as bigint) as expected, count(*) filter (expected_hour) as present, "
    "cast(960 - count(*) filter (expected_hour) as bigint) as missing, count(*) filter (expected_hour) = 960 as complete "
    "from obs group by project"
)
EMPTY_DUMPS = "(values ('pageviews-20231231-230000.gz', '20231231', 23), ('pageviews-20240301-000000.gz', '20240301', 0))"
# A range that begins and ends inside a day.
HOURS = ("2024-01-10 07:00", "2024-01-12 18:00")
IN_HOURS = f"ts >= timestamp '{HOURS[0]}' and ts < timestamp '{HOURS[1]}' + interval 1 hour"
DUMP_STATES = ctes(
    **LINES,
    names="select distinct file_name, day, hour from lines where file_name <> 'other.gz'",
    states="select *, case when file_name = (select min(file_name) from names) then 'truncated' "
    "when file_name = (select max(file_name) from names) then 'corrupt' else 'intact' end as state from names",
    cal=CAL_SQL,
    obs="select cast(strptime(day, '%Y%m%d') as timestamp) + to_hours(hour) as hour_ts from states where state = 'intact'",
)
CALENDAR_HOURS = ctes(**COVERAGE, obs=FILE_HOURS) + (
    f"select {DAY_HOUR}, c.hour_ts in (select hour_ts from obs) as present from cal c"
)
TOP_PAGES_EN = ctes(
    pv=PV_SQL,
    agg="select title, cast(sum(views) as bigint) as views, "
    "cast(coalesce(sum(views) filter (project <> 'fr.b'), 0) as bigint) as views_desktop, "
    "cast(coalesce(sum(views) filter (project = 'fr.b'), 0) as bigint) as views_mobile "
    f"from pv where project in ('en', 'fr.b') and {HOME_FILTER} and {NS_FILTER} and {EMPTY_FILTER} group by title",
    top="select * from agg order by views desc, title asc limit 100",
) + (
    "select cast(row_number() over (order by views desc, title asc) as int) as rank, title, views, "
    f"views_desktop, views_mobile, {_share('views', 3)} as share_pct from top"
)

RATE_WINDOW, RATE_STEP = "6 hours", "1 hour"
LABEL_PATTERN = "e.+"
SAMPLES = {"s": SAMPLES_SQL}
LATEST = "select name, k, arg_max(v, row(ts, event_id)) as value from s group by name, k"
INC = (
    "select *, case when pv is null then 0 when v >= pv then v - pv else v end as inc from ("
    "select *, lag(v) over (partition by name, k order by ts, event_id) as pv from s)"
)
RATE_WINDOWS = (
    "select name, k, date_trunc('hour', ts) + to_hours(j + 1) as wend, ts, event_id, inc "
    "from inc cross join range(0, 6) r(j)"
)
RATE = ctes(
    **SAMPLES,
    inc=INC,
    w=RATE_WINDOWS,
    per=(
        "select name, k, wend, sum(inc) - arg_min(inc, row(ts, event_id)) as increase, count(*) as n "
        "from w group by name, k, wend"
    ),
) + "select name, wend as ts, {sign}cast(sum(increase) as double) / 21600 as rate from per where n >= 2 group by name, wend"
SUM_BY_LABEL = (
    "select name, b + interval 1 hour as ts, cast(sum(last) as bigint) as value from ("
    "select name, k, date_trunc('hour', ts) as b, arg_max(v, row(ts, event_id)) as last from s group by name, k, b) "
    "group by name, b"
)

# Evaluation at instants: step and lookback are such that series go stale between samples.
INSTANT_STEP, INSTANT_LOOKBACK, INSTANT_AT = "30 minutes", "90 minutes", "2024-01-15 12:00:00"
INSTANTS = ctes(
    **SAMPLES,
    lasts="select name, k, ts, arg_max(v, event_id) as v from s group by name, k, ts",
    grid="select name, k, unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)) + interval 2 day, "
    "interval 30 minute)) as t from s group by name, k",
    live="select grid.name, grid.k, grid.t as ts, lasts.v as value from grid asof join lasts "
    "on grid.name = lasts.name and grid.k = lasts.k and grid.t >= lasts.ts "
    "where grid.t < lasts.ts + interval 90 minute",
)
INSTANT_AT_SQL = ctes(**SAMPLES) + (
    "select name, k, arg_max(v, row(ts, event_id)) as value from s "
    f"where ts > timestamp '{INSTANT_AT}' - interval 90 minute and ts <= timestamp '{INSTANT_AT}' group by name, k"
)
# Rates over raw samples: each sample is dealt to the six windows (t - 6 h, t] that hold it.
RATE_AT_EDGES = ctes(
    **SAMPLES,
    inc=INC,
    w="select *, epoch_us(ts) as us, ((epoch_us(ts) + 3599999999) // 3600000000 + j) * 3600000000 as t "
    "from inc cross join range(0, 6) r(j)",
    g="select name, k, t, count(*) as n, cast(sum(inc) - arg_min(inc, row(ts, event_id)) as double) as grown, "
    "cast(arg_min(v, row(ts, event_id)) as double) as v0, min(us) as u0, max(us) as u1 from w group by name, k, t",
    d="select *, (u1 - u0) / 1000000 as span, (u0 - (t - 21600000000)) / 1000000 as head, (t - u1) / 1000000 as tail "
    "from g where n >= 2 and u1 > u0",
    e="select *, case when head >= span / (n - 1) * 1.1::double then span / (n - 1) / 2 else head end as head1, "
    "case when tail >= span / (n - 1) * 1.1::double then span / (n - 1) / 2 else tail end as tail1 from d",
    f="select *, case when grown > 0 and v0 >= 0 then least(head1, span * (v0 / grown)) else head1 end as head2 from e",
    rates="select name, k, make_timestamp(t) as ts, n as samples, "
    "grown * ((span + head2 + tail1) / span) / 21600 as rate from f",
)


def all_oracles() -> dict[str, str]:
    return {
        "pv_scan": ctes(pv=PV_SQL) + "select * from pv",
        "pv_malformed": ctes(**LINES) + "select reason, count(*) as n_lines from lines group by reason",
        "pv_file_hours": ctes(**LINES)
        + "select distinct file_name, day, hour from lines where file_name <> 'other.gz'",
        "pv_input_files": ctes(**LINES) + "select count(distinct file_name) as input_files from lines",
        "pv_project_filter": _pv_where(PROJECT_FILTER),
        "pv_drop_home": _pv_where(HOME_FILTER),
        "pv_drop_namespaces": _pv_where(NS_FILTER),
        "pv_drop_empty": _pv_where(EMPTY_FILTER),
        "pv_clean": _pv_where(CLEAN),
        "pv_platform": _pv_where(PROJECT_FILTER, platform=True),
        "title_match": _pv_where(f"title in ({lit(MONUMENT)}, url_encode({lit(MONUMENT)}))"),
        "reference_titles": ctes(**TITLE_LISTS) + "select title from ref",
        "title_variants": TITLE_VARIANTS,
        "unknown_titles": UNKNOWN_TITLES,
        "titles_daily": TITLES_DAILY,
        "dump_titles_daily": _titles_daily("select title from req"),
        "runs_load": ctes(**RUNS) + "select * from runs",
        "runs_committed": ctes(**RUNS)
        + "select * from runs qualify row_number() over (partition by run_id "
        "order by ts_utc desc, job desc, month desc, parallelism desc, duration_s desc, rows_in desc, rows_out desc) = 1",
        "run_ordinal": ctes(**RUNS)
        + "select row_number() over (order by ts_utc, run_id) as ordinal, "
        "run_id, ts_utc, job, duration_s from runs",
        "run_families": ctes(**RUNS) + "select distinct family, parallelism from runs",
        "run_summary": RUN_SUMMARY,
        "run_scaling": RUN_SCALING,
        "coverage_calendar": ctes(**COVERAGE, obs=FILE_HOURS)
        + "select strftime(h, '%Y%m%d') as day, cast(hour(h) as int) as hour from ("
        "select unnest(generate_series(date_trunc('day', min(hour_ts)), "
        "date_trunc('day', max(hour_ts)) + interval 23 hour, interval 1 hour)) as h from obs)",
        "calendar_hours": CALENDAR_HOURS,
        "dump_scan": ctes(pv=PV_SQL) + "select * from pv",
        "dump_hours": ctes(**LINES)
        + "select distinct file_name, day, hour from lines where file_name <> 'other.gz' "
        f"union all select * from {EMPTY_DUMPS} v(file_name, day, hour)",
        "dump_count": ctes(**LINES) + "select count(distinct file_name) + 2 as input_files from lines",
        "dump_scan_of_hours": ctes(pv=PV_SQL.rstrip() + f" and {IN_HOURS}") + "select * from pv",
        "dumps_opened": ctes(**LINES)
        + f"select count(distinct file_name) filter (file_name <> 'other.gz' and {IN_HOURS}) as opened, "
        "count(distinct file_name) + 2 as listed from lines",
        "dump_states": DUMP_STATES
        + f"select * from states union all select *, 'intact' from {EMPTY_DUMPS} v(file_name, day, hour) "
        "union all select distinct file_name, null, null, 'intact' from lines where file_name = 'other.gz'",
        "coverage_intact": DUMP_STATES + f"select {DAY_HOUR} from cal c where c.hour_ts not in (select hour_ts from obs)",
        "top_pages_other_projects": TOP_PAGES_EN,
        "coverage_gaps": COVERAGE_GAPS,
        "coverage_summary": COVERAGE_SUMMARY,
        "coverage_gaps_by_project": COVERAGE_GAPS_BY_PROJECT,
        "coverage_summary_by_project": COVERAGE_SUMMARY_BY_PROJECT,
        "metric_samples": ctes(**SAMPLES) + "select * from s",
        "metric_latest": ctes(**SAMPLES) + LATEST,
        "metric_latest_sum": ctes(**SAMPLES, l=LATEST) + "select name, cast(sum(value) as bigint) as value from l group by name",
        "metric_sum_of_two": ctes(**SAMPLES, l=LATEST)
        + "select cast(sum(case when name = 'view' then value end) + sum(case when name = 'click' then value end) "
        "as bigint) as value from l",
        "metric_rate": RATE.format(sign=""),
        "metric_rate_signed": RATE.format(sign="-"),
        "metric_instant": INSTANTS + "select * from live",
        "metric_instant_sum": INSTANTS + "select name, ts, cast(sum(value) as bigint) as value from live group by name, ts",
        "metric_instant_at": INSTANT_AT_SQL,
        "metric_rate_edges": RATE_AT_EDGES + "select * from rates",
        "metric_rate_edges_sum": RATE_AT_EDGES + "select name, ts, round(sum(rate), 6) as rate from rates group by name, ts",
        "metric_sum_by_label": ctes(**SAMPLES) + SUM_BY_LABEL,
        "metric_label_regex": ctes(**SAMPLES, l=LATEST)
        + f"select * from l where regexp_full_match(name, {lit(LABEL_PATTERN)})",
        "metric_reduce": ctes(**SAMPLES, g=SUM_BY_LABEL)
        + "select name, arg_max(value, ts) as last_value, avg(value) as mean_value, max(value) as max_value "
        "from g group by name",
        "csv_roundtrip": TOP_PAGES,
        "observed_counts": TOP_CTES
        + "select (select count(*) from pv) as rows_in, (select count(*) from top) as rows_out",
        "pv_landed": ctes(pv=PV_SQL) + "select * from pv",
        "landed_top_pages": TOP_PAGES,
        "pv_clustered": ctes(pv=PV_SQL) + "select * from pv",
        "clustered_title_daily": _title_daily(MONUMENT),
        "rollup_top_pages": TOP_PAGES,
        "rollup_title_daily": _title_daily(MONUMENT),
        "rollup_hourly_profile": HOURLY_PROFILE,
        "top_pages": TOP_PAGES,
        "views_by_title": VIEWS_BY_TITLE,
        "views_by_hour": VIEWS_BY_HOUR,
        "hourly_profile": HOURLY_PROFILE,
        "title_daily": _title_daily(MONUMENT),
    }


__all__ = ["all_oracles", "LINES_SQL", "RUNS_SQL", "SAMPLES_SQL"]
