"""Checks that return the offending rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Hashes of repeated keys (8 bytes each) that may be sent to every task.
REPEATED_KEYS = 1_000_000


def key_hash(keys: Sequence[str]) -> Column:
    """64-bit hash of a key, never NULL; NULLs are marked, because the hash passes over them."""
    return F.xxhash64(*[part for k in keys for part in (F.col(k).isNull(), F.col(k))])


def repeated_hashes(df: DataFrame, keys: Sequence[str], most: int = REPEATED_KEYS) -> DataFrame | None:
    """``key_hash`` of the keys that several rows have, stored; None if there are more than ``most``.

    Only the hash and a count are shuffled, added up in each task before, whatever the width of key and row.
    Two keys of one hash are taken for repeated, so what is not listed is certainly unique. Bitmaps
    of hash buckets would not be smaller: to tell n keys apart each task would need a map of the whole range.
    """
    counts = df.select(key_hash(keys).alias("_hash")).groupBy("_hash").agg(F.count("*").alias("_n"))
    found = cut_lineage(counts.filter("_n > 1").select("_hash"))
    return found if found.limit(most + 1).count() <= most else None


def with_hash_in(df: DataFrame, keys: Sequence[str], hashes: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose key hash is listed (``left_anti``: is not), without moving them."""
    return df.join(F.broadcast(hashes), key_hash(keys) == hashes["_hash"], how)


def key_violations(df: DataFrame, keys: Sequence[str], most: int = REPEATED_KEYS) -> DataFrame:
    """Keys that occur more than once or hold a NULL, with their row counts.

    Keys are compared themselves only where their hash is repeated or a part is NULL; with more than
    ``most`` repeated hashes all of them are.
    """
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    hashes = repeated_hashes(df, keys, most)
    asked = df
    if hashes is not None:
        # A listed key with a NULL has all its rows here, so that its count is whole.
        asked = with_hash_in(df.filter(~has_null), keys, hashes).select(*keys).unionByName(df.filter(has_null).select(*keys))
    return (
        asked.groupBy(*keys).agg(F.count("*").alias("n_rows"))
        .filter((F.col("n_rows") > 1) | has_null)
    )


def missing_months(
    months: DataFrame, index: str = "month_idx", by: Sequence[str] = ()
) -> DataFrame:
    """Months between the first and the last one of each series that have no row.

    The input is read once: every present month looks at the next one and gives the hole between.
    """
    present = months.select(*by, F.col(index).alias("month_idx")).distinct()
    following = F.lead("month_idx").over(Window.partitionBy(*by).orderBy("month_idx"))
    holes = present.withColumn("_next", following).filter(F.col("_next") > F.col("month_idx") + 1)
    return holes.select(
        *by, F.explode(F.sequence(F.col("month_idx") + 1, F.col("_next") - 1)).alias("month_idx"))


def fail_on_gaps(months: DataFrame, index: str = "month_idx") -> None:
    """Raise if a month is missing. Looks at one row at most."""
    gap = missing_months(months, index)
    if not gap.isEmpty():
        raise ValueError("the monthly series has missing months")


def eligible_series(
    series: DataFrame, value: str = "value", where: Column | None = None
) -> DataFrame:
    """Series whose every value is above 0 in the given rows, with their smallest value."""
    rows = series if where is None else series.filter(where)
    return rows.groupBy("series").agg(F.min(value).alias("min_value")).filter("min_value > 0")
