"""Marts kept up to date from new files alone.

Cubes are sums, first and last values, so those of new files are merged into the stored ones. Which
files have been counted is published together with the cubes they are in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.cubes import build_cubes, merge_cubes
from ..session import cut_lineage
from ..sources import writers

_FILE = ("path", "length", "modificationTime")


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """path, length and modificationTime of every data file under ``path``; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return files.load(path).select(*_FILE)


def refresh_cubes(spark: SparkSession, clean: str, out: str) -> int:
    """Bring the cubes under ``out`` up to date with the table ``clean``; the number of files read for it.

    Only files not yet counted are read. If a counted file is gone or has been written anew, all are, because
    its rows cannot be taken out. Cubes and list of files appear together as one version. Of two refreshes at
    once the second one raises VersionConflict, so no file is counted twice. A folder without files has
    no cubes. Names of new files pass the driver, as all names do when Spark lists a folder.
    """
    version = writers.latest_version(spark, out) or 0
    listed = cut_lineage(table_files(spark, clean))
    counted = writers.read_published(spark, out, "files") if version else listed.limit(0)
    whole = not version or not counted.join(listed, list(_FILE), "left_anti").isEmpty()
    fresh = listed if whole else listed.join(counted, list(_FILE), "left_anti")
    paths = [r.path for r in fresh.select("path").collect()]
    if not paths:
        return 0
    cubes = build_cubes(spark.read.option("basePath", clean).parquet(*paths))
    if not whole:
        cubes = merge_cubes(writers.read_published(spark, out, "cubes"), cubes)
    writers.publish({"cubes": cubes, "files": listed}, out, replaces=version)
    return len(paths)
