"""All mart counts from one scan of the incident table.

Four small aggregates carry everything the marts need: by hour, by date and type, by
label and type, by area and type. GROUPING SETS computes them in one pass. A grouping id
keeps a NULL key apart from "not grouped".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.choice import first_of
from .distinct import SKETCH_BITS

# Grouping sets by name; the key columns are those of ``cube_input``.
CUBES = {
    "by_hour": ("hour",),
    "by_date_type": ("date_only", "primary_type"),
    "by_label_type": ("location_description", "primary_type"),
    "by_area_type": ("community_area", "primary_type"),
}
_KEYS = ("hour", "date_only", "location_description", "community_area", "primary_type")


def cube_input(df: DataFrame, *distinct: str) -> DataFrame:
    """The five keys, the timestamp and a column to count values of; nothing else is read from the files."""
    return df.select(
        *(F.col(c).alias("_distinct") for c in distinct),
        F.hour("date").alias("hour"),
        F.to_date("date").alias("date_only"),
        "location_description",
        "community_area",
        "primary_type",
        "date",
    )


def build_cubes(df: DataFrame, distinct: str | None = None) -> DataFrame:
    """Counts and first/last timestamp for every grouping set, one row per key.

    Columns: cube, the five keys (NULL where not grouped), n, first_at, last_at. ``distinct`` names a column
    whose different values are counted too, in a ``sketch`` that merges (``operators.distinct``).
    """
    keys = [F.col(name) for name in _KEYS]
    sets = [[F.col(name) for name in columns] for columns in CUBES.values()]
    read = cube_input(df) if distinct is None else cube_input(df, distinct)
    more = [] if distinct is None else [F.hll_sketch_agg("_distinct", SKETCH_BITS).alias("sketch")]
    grouped = read.groupingSets(sets, *keys).agg(
        F.count("*").alias("n"),
        F.min("date").alias("first_at"),
        F.max("date").alias("last_at"),
        *more,
        F.grouping_id(*_KEYS).alias("_gid"),
    )
    return grouped.withColumn("cube", _cube_name(F.col("_gid"))).select(
        "cube", *_KEYS, "n", "first_at", "last_at", *(["sketch"] if more else [])
    )


def merge_cubes(one: DataFrame, other: DataFrame) -> DataFrame:
    """Cubes of two parts of a table as those of the whole."""
    more = [F.hll_union_agg("sketch").alias("sketch")] if "sketch" in one.columns else []
    return one.unionByName(other).groupBy("cube", *_KEYS).agg(
        F.sum("n").alias("n"), F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"), *more)


def data_range(cubes: DataFrame) -> DataFrame:
    """First and last timestamp of the table, from its smallest cube."""
    return cube(cubes, "by_hour").agg(F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"))


def cube(cubes: DataFrame, name: str) -> DataFrame:
    """Rows of one grouping set with its own key columns."""
    return cubes.filter(F.col("cube") == name).select(*CUBES[name], "n", "first_at", "last_at")


def _cube_name(gid: Column) -> Column:
    chain = []
    for name, columns in CUBES.items():
        bits = "".join("0" if key in columns else "1" for key in _KEYS)
        chain.append((gid == int(bits, 2), name))
    return first_of(chain, F.lit(None))
