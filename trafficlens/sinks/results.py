"""Result writers.

Row counts come from an ``Observation`` attached right above the written
frame: the count is gathered by the write itself, so there is no second pass
and no re-read of the output. Writes never overwrite (``errorifexists``) unless
told to. Paths are any Hadoop file system URI shared by the cluster.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.csvformat import CSV_OPTIONS


def observe_rows(df: DataFrame, name: str | None = None) -> tuple[DataFrame, Observation]:
    """Attach a row counter to ``df``; read ``obs.get['rows']`` after the action that consumes it.

    Place it above a shuffle or aggregate (or at the top of the written frame): below
    a range-partitioned sort the sampling job would count rows twice.
    """
    obs = Observation(name or f"rows_{uuid.uuid4().hex[:8]}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_result(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    single_file: bool = False,
    partition_by: list[str] | None = None,
    options: dict[str, str] | None = None,
) -> int:
    """Write ``df`` to ``path`` and return the number of rows written (one pass).

    ``single_file`` coalesces to one task: only for results already small (top
    pages, daily or hourly series), where the frame is one partition anyway.
    """
    counted, obs = observe_rows(df, "result_rows")
    if single_file:
        counted = counted.coalesce(1)
    writer = counted.write.mode(mode).format(fmt).options(**(options or {}))
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return int(obs.get.get("rows", 0))


def read_result_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a CSV result written by :func:`write_result` with its schema."""
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as its object."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def claim_folder(spark: SparkSession, path: str) -> str:
    """Create ``path`` for one caller; FileExistsError when it exists or another run claims it.

    The claim is a file created without overwriting, which a Hadoop file system
    grants once, so two runs that start together cannot both get the folder.
    """
    fs, jpath = file_system(spark, path)
    if fs.exists(jpath):
        raise FileExistsError(f"{path} exists; runs never overwrite")
    jvm = spark.sparkContext._jvm
    try:
        fs.create(jvm.org.apache.hadoop.fs.Path(jpath, "_CLAIMED"), False).close()
    except Exception as error:  # noqa: BLE001 - py4j wraps the file system's exception
        raise FileExistsError(f"{path} was claimed by another run") from error
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = file_system(spark, path)
    return bool(fs.exists(jpath))


def single_part(spark: SparkSession, directory: str, suffix: str = "") -> str:
    """Path of the one ``part-*`` file of ``directory``; raises if it does not hold exactly one."""
    fs, jdir = file_system(spark, directory)
    parts = [s.getPath() for s in fs.listStatus(jdir) if s.getPath().getName().startswith("part-")]
    parts = [p for p in parts if p.getName().endswith(suffix)]
    if len(parts) != 1:
        raise RuntimeError(f"expected one part file in {directory}, found {len(parts)}")
    return str(parts[0].toString())


def name_single_part(spark: SparkSession, directory: str, name: str, suffix: str = "") -> str:
    """Rename the one ``part-*`` file of ``directory`` to ``directory/name`` (metadata only); returns the new path."""
    part = single_part(spark, directory, suffix)
    fs, jdir = file_system(spark, directory)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(jdir, name)
    if not fs.rename(file_system(spark, part)[1], target):
        raise RuntimeError(f"could not rename {part} to {target}")
    return str(target.toString())
