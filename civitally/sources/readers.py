"""Raw files, clean tables, marts and dimensions as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions import fixed_values as fv


def read_raw(
    spark: SparkSession, path: str, header: tuple[str, ...] | None = None,
    partitions: int | None = None, malformed: str | None = None, multi_line: bool = False,
) -> DataFrame:
    """CSV files with a header, every column as text.

    ``header`` names the columns without looking at the file. A gzip file is read by one
    task, so its rows are spread before anything else happens: over ``partitions``, or as
    many tasks as a shuffle has. Other files are spread only if ``partitions`` is given.

    Rows with too few or too many fields, or a quote that is not closed, are padded or cut, unless
    ``malformed`` names a column: it then holds such a row's whole line, and is NULL in all others. With
    ``multi_line`` quoted fields may hold line ends; each file is then read by one task.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line)
    if malformed is not None:
        names = header or tuple(reader.csv(path).columns)
        if malformed in names:
            raise ValueError(f"the file has a column named {malformed}")
        fields = schema.text_schema(names).add(malformed, "string")
        # Fields are counted only while no column is pruned.
        reader = reader.schema(fields).option("mode", "PERMISSIVE").option("columnPruning", False).option(
            "columnNameOfCorruptRecord", malformed)
    elif header is not None:
        reader = reader.schema(schema.text_schema(header))
    rows = reader.csv(path)
    if partitions:
        return rows.repartition(partitions)
    return rows.repartition() if path.endswith(".gz") else rows


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """The clean incident table; filters and columns are pushed to the files."""
    return spark.read.parquet(path)


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    """Holiday dimension from parquet: holiday_date, holiday_name."""
    return spark.read.schema(schema.HOLIDAY_SCHEMA).parquet(path)


def read_jdbc(spark: SparkSession, table: str, options: Mapping[str, str]) -> DataFrame:
    """A table over JDBC; ``options`` holds url, user, password and driver.

    For a large table add partitionColumn, lowerBound, upperBound and numPartitions.
    """
    return spark.read.format("jdbc").options(**options).option("dbtable", table).load()


def holidays_from_dates(spark: SparkSession, dates: Mapping[str, str]) -> DataFrame:
    """Holiday dimension from ``{date: name}``."""
    rows = spark.createDataFrame(list(dates.items()), "holiday_date string, holiday_name string")
    return rows.withColumn("holiday_date", F.to_date("holiday_date"))


def area_centroids(spark: SparkSession) -> DataFrame:
    """community_area, lat, lng of the 77 community areas."""
    return spark.createDataFrame(list(fv.AREA_CENTROIDS), "community_area string, lat double, lng double")


def read_mart(spark: SparkSession, root: str, name: str, listed_only: bool = False) -> DataFrame:
    """A written mart by name. Unknown names raise before anything is read."""
    from ..plans.marts import catalogue, marts

    known = set(marts())
    if listed_only:
        known = {table for tables in catalogue().values() for table in tables.values()}
    if name not in known:
        raise KeyError(f"unknown mart: {name}")
    return spark.read.parquet(f"{root}/{name}")


def mart_docs(spark: SparkSession) -> DataFrame:
    """table, keys, description of every mart."""
    from ..plans.marts import marts

    rows = [(m.name, list(m.keys), m.description) for m in marts().values()]
    return spark.createDataFrame(rows, "table string, keys array<string>, description string")
