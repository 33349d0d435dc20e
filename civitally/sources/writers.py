"""Clean tables, marts and versioned result sets."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folder column of the clean table: the year of the date, in the zone the table is written in.
YEAR_FOLDER = "incident_year"


def write_clean(df: DataFrame, path: str) -> None:
    """Overwrite the clean table, one folder per incident year, sorted by date.

    The rebalance lets Spark size the write tasks at run time: a large month is split over
    many of them and small months are put together. Within a file rows are in date order,
    so a filter on ``date`` skips row groups; ``incident_year`` skips folders, and
    ``operators.pruning`` names it in date filters.
    """
    rows = df.withColumns({YEAR_FOLDER: F.year("date"), "_month": F.month("date")})
    spread = rows.hint("rebalance", YEAR_FOLDER, "_month").drop("_month")
    (spread.sortWithinPartitions(YEAR_FOLDER, "date")
     .write.mode("overwrite").partitionBy(YEAR_FOLDER).parquet(path))


def write_mart(df: DataFrame, root: str, name: str, sort: tuple[str, ...] = ()) -> None:
    """Overwrite one mart. Marts are small aggregates, so one sorted file each.

    The rows are moved to one task after the aggregate has run in all of them.
    """
    single = df.repartition(1)
    rows = single.sortWithinPartitions(*sort) if sort else single
    rows.write.mode("overwrite").parquet(f"{root}/{name}")


def write_jdbc(df: DataFrame, table: str, options: Mapping[str, str]) -> None:
    """Overwrite a database table over JDBC (url, user, password, driver)."""
    df.write.format("jdbc").options(**options).option("dbtable", table).mode("overwrite").save()


_MARKER = "version long, folder string"


class VersionConflict(RuntimeError):
    """Another run has replaced the version this one was to replace."""


def publish(tables: Mapping[str, DataFrame], root: str, replaces: int | None = None) -> int:
    """Replace a set of tables together.

    Every table is written to a new folder of this run's own. Then the run claims the next version number,
    which only one run can, and one appended row in ``published`` makes the version visible. A
    failed run leaves the former version in place, and readers never see a mix of two versions. Of two runs
    at once each gets a number and the later number is read. With ``replaces`` (0: nothing published yet) the
    run must be the one that follows that version; if another has come first, it raises
    VersionConflict and publishes nothing. Older folders stay for readers still on them: ``retired``
    lists those that may be removed.
    """
    spark = next(iter(tables.values())).sparkSession
    folder = uuid.uuid4().hex
    for name, df in tables.items():
        df.write.parquet(f"{root}/{folder}/{name}")
    version = (latest_version(spark, root) or 0) + 1
    if replaces is not None:
        if version != replaces + 1 or not claim(spark, root, version):
            raise VersionConflict(f"version {replaces} of {root} has been replaced by another run")
    else:
        while not claim(spark, root, version):
            version += 1
    row = spark.range(1).select(F.lit(version).cast("long").alias("version"), F.lit(folder).alias("folder"))
    row.coalesce(1).write.mode("append").parquet(f"{root}/published")
    return version


def claim(spark: SparkSession, root: str, version: int) -> bool:
    """True for the one run that creates the file of this version number.

    Exclusive creation is up to the file system: HDFS and local ones have it, of object stores those
    with conditional writes. A number whose run failed after the claim is passed over by the next one.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/claims/{version}")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.getScheme() == "file":
        # Hadoop's local file system looks first and creates then; the operating system does both at once.
        file = Path(path.toUri().getPath())
        file.parent.mkdir(parents=True, exist_ok=True)
        try:
            file.touch(exist_ok=False)
        except FileExistsError:
            return False
        return True
    try:
        system.create(path, False).close()
    except Py4JJavaError as error:
        if "AlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def _published(spark: SparkSession, root: str) -> DataFrame | None:
    """Rows of all complete versions, or None where nothing has been published."""
    try:
        return spark.read.schema(_MARKER).parquet(f"{root}/published")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def latest_version(spark: SparkSession, root: str) -> int | None:
    """Number of the newest complete version under ``root``, or None."""
    rows = _published(spark, root)
    return rows.agg(F.max("version")).first()[0] if rows else None


def retired(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Folders of versions older than the ``keep`` newest, for the owner to remove."""
    rows = _published(spark, root)
    if rows is None:
        return []
    last = rows.agg(F.max("version")).scalar()
    return [f"{root}/{r.folder}" for r in rows.filter(F.col("version") <= last - keep).collect()]


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the newest complete version."""
    rows = _published(spark, root)
    newest = rows.agg(F.max(F.struct("version", "folder")).alias("v")).first().v if rows else None
    if newest is None:
        raise FileNotFoundError(f"nothing published under {root}")
    return spark.read.parquet(f"{root}/{newest.folder}/{name}")
