"""Small side tables: reference titles, run manifest, hourly calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.csvformat import CSV_OPTIONS
from ..functions.timefmt import day_text

RUNS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("ts_utc", T.StringType()),
        T.StructField("job", T.StringType()),
        T.StructField("month", T.StringType()),
        T.StructField("parallelism", T.IntegerType()),
        T.StructField("duration_s", T.DoubleType()),
        T.StructField("rows_in", T.LongType()),
        T.StructField("rows_out", T.LongType()),
    ]
)


# ----------------------------------------------------------------- titles --


def clean_titles(titles: DataFrame, col: str = "title") -> DataFrame:
    """Reference title list: trimmed, non-empty, distinct (``title``)."""
    t = F.trim(F.col(col))
    return titles.select(t.alias("title")).where(F.col("title").isNotNull() & (F.col("title") != "")).distinct()


def _read_named(spark: SparkSession, path: str | list[str], names: list[str]) -> DataFrame:
    """The columns ``names`` of a CSV with a header, as text, wherever they stand in it."""
    raw = spark.read.options(**CSV_OPTIONS).csv(path)
    absent = [n for n in names if n not in raw.columns]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}; its header is {', '.join(raw.columns)}")
    return raw.select(*names)


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """The ``title`` column of a CSV with a header. A missing path gives an empty list."""
    try:
        raw = _read_named(spark, path, ["title"])
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raw = spark.createDataFrame([], "title string")
    return clean_titles(raw)


# ------------------------------------------------------------------- runs --


def job_family(job: Column | str) -> Column:
    """The part of a job name before its first underscore; a name without one is its own family."""
    c = F.col(job) if isinstance(job, str) else job
    return F.substring_index(c, "_", 1)


def with_family(runs: DataFrame) -> DataFrame:
    return runs.withColumn("family", job_family("job"))


def _number(name: str, kind: T.DataType) -> Column:
    """A text column as a number; text that is none fails the job, an empty field is null."""
    text = F.trim(F.col(name))
    number = text.try_cast(kind)
    damaged = F.raise_error(F.concat(F.lit(f"run manifest: {name} is not a number: "), F.col(name))).cast(kind)
    return F.when(text.isNull() | (text == ""), F.lit(None).cast(kind)).when(number.isNull(), damaged).otherwise(number)


def once_by_id(runs: DataFrame) -> DataFrame:
    """Each run_id once: of repeated ones the row that starts last, then the greatest; rows without an id all stay.

    The window orders by the columns themselves: a struct of them would be shuffled beside them.
    """
    order = ["ts_utc", *[c for c in runs.columns if c not in ("run_id", "ts_utc")]]
    first = F.row_number().over(Window.partitionBy("run_id").orderBy(*[F.desc(c) for c in order]))
    return runs.withColumn("_copy", first).where("_copy = 1 or run_id is null").drop("_copy")


def read_runs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Run manifest (CSV with header, columns by name) plus its ``family`` column, every row of it.

    A folder's files and subfolders that begin with an underscore are uncommitted and not read.
    """
    raw = _read_named(spark, path, RUNS_SCHEMA.fieldNames())
    columns = [
        (F.col(f.name) if isinstance(f.dataType, T.StringType) else _number(f.name, f.dataType)).alias(f.name)
        for f in RUNS_SCHEMA.fields
    ]
    return with_family(raw.select(*columns))


def read_committed_runs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The runs of a manifest, each run_id once, whatever retries and interrupted compactions have left.

    ``family`` follows from ``job``, so it is derived after the shuffle.
    """
    return with_family(once_by_id(read_runs(spark, path).drop("family")))


# --------------------------------------------------------------- calendar --


def _hour_seq(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(start, end, F.expr("INTERVAL 1 HOUR")))


def hourly_calendar(spark: SparkSession, start: str | dt.date, days: int) -> DataFrame:
    """All hours of ``days`` days from ``start``: ``hour_ts timestamp_ntz, day string, hour int``.

    Generated from one row by ``explode(sequence(...))``; its size is days * 24.
    """
    start_date = dt.date.fromisoformat(str(start))
    first = dt.datetime.combine(start_date, dt.time())
    last = first + dt.timedelta(days=days) - dt.timedelta(hours=1)
    one = spark.range(1).select(
        F.lit(first.isoformat(sep=" ")).cast("timestamp_ntz").alias("s"),
        F.lit(last.isoformat(sep=" ")).cast("timestamp_ntz").alias("e"),
    )
    return with_day_hour(one.select(_hour_seq(F.col("s"), F.col("e")).alias("hour_ts")))


def calendar_spanning(hours: DataFrame, hour_ts: str = "hour_ts") -> DataFrame:
    """Hourly calendar over the whole days spanned by ``hours`` (first 00:00 to last 23:00).

    The bounds come from a one-row aggregate, so no value travels through the
    driver; its days are dealt out before each becomes 24 hours.
    """
    bounds = hours.agg(F.to_date(F.min(hour_ts)).alias("s"), F.to_date(F.max(hour_ts)).alias("e"))
    days = bounds.select(F.explode(F.sequence("s", "e")).alias("d")).repartition("d")
    midnight = F.col("d").cast("timestamp_ntz")
    return with_day_hour(days.select(_hour_seq(midnight, midnight + F.expr("INTERVAL 23 HOURS")).alias("hour_ts")))


def with_day_hour(df: DataFrame, hour_ts: str = "hour_ts") -> DataFrame:
    """Add the dump naming columns ``day`` (yyyyMMdd) and ``hour`` (0-23)."""
    return df.withColumn("day", day_text(hour_ts)).withColumn("hour", F.hour(hour_ts).cast("int"))


def hour_timestamp(day: str = "day", hour: str = "hour") -> Column:
    """``timestamp_ntz`` of a dump hour from its ``day`` (yyyyMMdd) and ``hour``; null if the day is invalid.

    Built from a date plus an hour interval, so it does not depend on the session time zone.
    """
    midnight = F.try_to_date(F.col(day), "yyyyMMdd").cast("timestamp_ntz")
    return midnight + F.make_dt_interval(F.lit(0), F.col(hour))
