"""Test inputs realised on the shared test tables, in Spark and (independently) in SQL.

The page-view dumps, the run manifest and the metric samples do not exist as
tables; they are derived here from ``events`` and ``lineitem`` so that every
query's work grows with those tables. Spark builds raw dump *lines* (with
deliberate damage) and parses them with the real scan; the SQL side builds the
parsed table directly, which keeps the two paths independent.
"""

from __future__ import annotations

import gzip
import posixpath
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.constants import HOME_PAGES, NAMESPACE_PREFIXES
from .functions.timefmt import day_text, hour_text, iso_seconds_text, month_text
from .operators.series import running_total
from .sources.pageviews import parse_pageview_lines
from .sources.tables import with_family


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(posixpath.join(sf_dir, f"{name}.parquet"))


# --------------------------------------------------------------- page views --
# Fixture mapping (fixed values): event type -> project, user_id % 12 -> kind of title.
_PROJECT_SQL = (
    "case event_type when 'view' then 'fr' when 'click' then 'fr.m' when 'purchase' then 'en' "
    "when 'signup' then 'fr.b' else 'fr' end"
)
# Talk pages, the last of which the cleaning rules keep, and titles that only look like dropped ones.
TALK_TITLES = (
    "Discussion:U", "Discussion_utilisateur:U", "Discussion_aide%3AU", "Discussion%3aU", "Discussion_Wikip%C3%A9dia:X",
)
NEAR_MISSES = (
    "Special_Page", "Spécialité", "Spécialité:U", "spécial:U", "X:Special:Y", "Aide", "Discussionner", "U:Discussion:X",
    "Main_Page_2", "main_Page", "Accueil", "--", "Page_d%27accueil_", "Portail_Accueil", "Modules:U", "Media%3",
)


#: Dumps without a line, which only a listing finds.
EMPTY_DUMPS = ("pageviews-20231231-230000.gz", "pageviews-20240301-000000.gz")


def _nth_sql(titles: list[str]) -> str:
    """One of ``titles`` by ``event_id``, in SQL that both engines read."""
    cases = " ".join(f"when {k} then '{t.replace(chr(39), chr(39) * 2)}'" for k, t in enumerate(titles))
    return f"case cast(event_id % {len(titles)} as int) {cases} end"


def _title_sql(text: str) -> str:
    """Every namespace prefix and home page, raw and encoded, talk pages, near misses, and ordinary titles."""
    raw = [f"{p}:U" for p in NAMESPACE_PREFIXES]
    encoded = [quote(p, safe="") + s + "U" for p in NAMESPACE_PREFIXES for s in ("%3A", "%3a")]
    home = [quote(p, safe="") for p in HOME_PAGES]
    return (
        "case cast(user_id % 12 as int) "
        f"when 0 then {_nth_sql(raw)} when 1 then {_nth_sql(encoded)} "
        f"when 2 then {_nth_sql(list(TALK_TITLES))} when 3 then {_nth_sql(list(HOME_PAGES))} "
        f"when 4 then {_nth_sql(home)} when 5 then '' "
        "when 6 then 'Sagrada_Família' when 7 then 'Sagrada_Fam%C3%ADlia' "
        f"when 8 then {_nth_sql(list(NEAR_MISSES))} "
        f"else concat('Page_', cast(user_id as {text}), '_', cast(event_id % 7 as {text})) end"
    )


def pageview_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, ts, project, title, views`` from ``events``."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "ts",
        f"{_PROJECT_SQL} as project",
        f"{_title_sql('string')} as title",
        "cast(floor(value) as int) as views",
    )


def pageview_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw dump lines ``value, file_name``, one per event, with deliberate damage:

    ``event_id % 97 = 0`` -> two-field line; else ``% 101 = 0`` -> non-numeric views;
    ``% 103 = 0`` -> unrecognised file name. No line is removed here: the scan must drop them.
    """
    base = pageview_base(spark, sf_dir)
    eid = F.col("event_id")
    good = F.concat_ws(" ", "project", "title", F.col("views").cast("string"), F.lit("0"))
    bad_views = F.concat_ws(" ", "project", "title", F.lit("abc"), F.lit("0"))
    value = (
        F.when(eid % 97 == 0, F.lit("broken line")).when(eid % 101 == 0, bad_views).otherwise(good)
    )
    hourly = F.concat(F.lit("pageviews-"), day_text("ts"), F.lit("-"), hour_text("ts"), F.lit("0000.gz"))
    file_name = F.when(eid % 103 == 0, F.lit("other.gz")).otherwise(hourly)
    return base.select(value.alias("value"), file_name.alias("file_name"))


def write_dumps(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write the dump lines as real gzip dumps under ``path``, one file per name, and two empty dumps.

    Spark writes one folder per name; its one file is then moved to the dump's
    name through the Hadoop file system.
    """
    lines = pageview_lines(spark, sf_dir)
    parts = posixpath.join(path, "parts")
    lines.repartition("file_name").write.partitionBy("file_name").option("compression", "gzip").text(parts)
    jvm = spark.sparkContext._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(Path(path, "dumps"))
    for status in fs.globStatus(Path(parts, "file_name=*/part-*")):
        name = status.getPath().getParent().getName().removeprefix("file_name=")
        if not fs.rename(status.getPath(), Path(posixpath.join(path, "dumps", name))):
            raise OSError(f"could not move {status.getPath()} to {name}")
    for name in EMPTY_DUMPS:
        stream = fs.create(Path(posixpath.join(path, "dumps", name)), False)
        stream.write(bytearray(gzip.compress(b"")))
        stream.close()


def damage_dumps(spark: SparkSession, path: str) -> None:
    """Cut the end off the first dump under ``path`` (by name), and change a byte of the last one's checksum."""
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    folder = Path(posixpath.join(path, "dumps"))
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder))
    names = [n for n in names if n.startswith("pageviews-") and n not in EMPTY_DUMPS]
    for name, damage in ((names[0], lambda b: b[:-12]), (names[-1], lambda b: b[:-6] + bytes([b[-6] ^ 255]) + b[-5:])):
        file = posixpath.join(path, "dumps", name)
        content = bytes(spark.read.format("binaryFile").load(file).first()["content"])
        stream = fs.create(Path(file), True)
        stream.write(bytearray(damage(content)))
        stream.close()


def pageviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parsed page-view table, through the real line parser."""
    return parse_pageview_lines(pageview_lines(spark, sf_dir))


def titles_from(pv: DataFrame, project: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """A title list derived from the data: every title seen on ``project``, plus ``extra``."""
    seen = pv.where(F.col("project") == project).select("title")
    if not extra:
        return seen
    spark = pv.sparkSession
    return seen.unionByName(spark.createDataFrame([(t,) for t in extra], "title string"))


PV_SQL = f"""
select {_PROJECT_SQL} as project,
       {_title_sql('varchar')} as title,
       cast(floor(value) as int) as views,
       strftime(ts, '%Y%m%d') as day,
       cast(hour(ts) as int) as hour,
       cast(ts as date) as date
from events
where event_id % 97 <> 0 and event_id % 101 <> 0 and event_id % 103 <> 0
"""

LINES_SQL = f"""
select event_id, ts, {_PROJECT_SQL} as project, {_title_sql('varchar')} as title,
       case when event_id % 97 = 0 then 'field_count'
            when event_id % 101 = 0 then 'views'
            when event_id % 103 = 0 then 'file_name'
            else 'ok' end as reason,
       case when event_id % 103 = 0 then 'other.gz'
            else 'pageviews-' || strftime(ts, '%Y%m%d-%H') || '0000.gz' end as file_name,
       case when event_id % 103 = 0 then null else strftime(ts, '%Y%m%d') end as day,
       case when event_id % 103 = 0 then null else cast(hour(ts) as int) end as hour
from events
"""


# --------------------------------------------------------------------- runs --


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run manifest from ``lineitem``: one run per line item.

    family = return flag, parallelism = line number, duration = quantity * 10 / (line number + 1).
    """
    li = table(spark, sf_dir, "lineitem")
    manifest = li.select(
        F.concat_ws(
            "_", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
        ).alias("run_id"),
        iso_seconds_text("l_shipdate").alias("ts_utc"),
        F.concat_ws("_", "l_returnflag", "l_linestatus").alias("job"),
        month_text("l_shipdate").alias("month"),
        F.col("l_linenumber").cast("int").alias("parallelism"),
        (F.col("l_quantity") * 10 / (F.col("l_linenumber") + 1)).alias("duration_s"),
        F.lit(-1).cast("bigint").alias("rows_in"),
        F.col("l_orderkey").cast("bigint").alias("rows_out"),
    )
    return with_family(manifest)


RUNS_SQL = """
select cast(l_orderkey as varchar) || '_' || cast(l_linenumber as varchar) || '_'
           || cast(l_partkey as varchar) || '_' || cast(l_suppkey as varchar) as run_id,
       strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') as ts_utc,
       l_returnflag || '_' || l_linestatus as job,
       strftime(l_shipdate, '%Y-%m') as month,
       cast(l_linenumber as int) as parallelism,
       l_quantity * 10 / (l_linenumber + 1) as duration_s,
       cast(-1 as bigint) as rows_in,
       cast(l_orderkey as bigint) as rows_out,
       l_returnflag as family
from lineitem
"""


# ------------------------------------------------------------------ samples --


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric samples from ``events``: one counter per (name = event type, k = user_id % 3).

    ``v`` is the running sum of the event value in cents, ordered by (ts, event_id).
    """
    ev = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("name"),
        (F.col("user_id") % 3).cast("int").alias("k"),
        "ts",
        "event_id",
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
    )
    return running_total(ev, ["name", "k"], "ts", "event_id", "cents", "v").select(
        "name", "k", "ts", "event_id", "v"
    )


SAMPLES_SQL = """
select event_type as name, cast(user_id % 3 as int) as k, ts, event_id,
       cast(sum(cast(round(value * 100) as bigint)) over (
           partition by event_type, cast(user_id % 3 as int) order by ts, event_id
           rows between unbounded preceding and current row) as bigint) as v
from events
"""

