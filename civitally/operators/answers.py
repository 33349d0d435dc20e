"""Summaries of result tables, ad-hoc SQL and comparison answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as fv
from ..functions.rates import direction, pct_difference, rate

ROW_LIMIT = 200


def ad_hoc(spark: SparkSession, sql: str, limit: int | None = ROW_LIMIT) -> DataFrame:
    """Answer one query over the registered views.

    The text is parsed by Spark as a subquery, so a command or a second statement is a syntax
    error and changes nothing; files cannot be named in place of views. ``limit`` holds
    only for a text without a LIMIT of its own; None returns all rows.
    """
    by_path = "spark.sql.runSQLOnFiles"
    before = spark.conf.get(by_path)
    spark.conf.set(by_path, "false")
    try:
        found = spark.sql(f"SELECT * FROM (\n{sql.strip().rstrip(';')}\n)")
    finally:
        spark.conf.set(by_path, before)
    return found if limit is None or _has_limit(found) else found.limit(limit)


def _has_limit(wrapped: DataFrame) -> bool:
    """Whether the query inside the wrapping SELECT has an outermost LIMIT, by its analysed plan."""
    node = wrapped._jdf.queryExecution().analyzed()
    for name in ("Project", "SubqueryAlias"):
        if node.nodeName() == "WithCTE":
            node = node.plan()
        if node.nodeName() == name:
            node = node.child()
    if node.nodeName() == "WithCTE":
        node = node.plan()
    return node.nodeName() in ("GlobalLimit", "LocalLimit")


def extremes(df: DataFrame, label: str, measure: str) -> DataFrame:
    """Highest and lowest label with their values; NULL counts as 0, first label wins ties."""
    value = F.coalesce(F.col(measure), F.lit(0))
    name = F.col(label)
    return df.agg(
        F.min(F.struct((-value).alias("v"), name.alias("k"))).alias("hi"),
        F.min(F.struct(value.alias("v"), name.alias("k"))).alias("lo"),
    ).select(
        F.col("hi.k").alias("highest_label"),
        (-F.col("hi.v")).alias("highest_value"),
        F.col("lo.k").alias("lowest_label"),
        F.col("lo.v").alias("lowest_value"),
    )


def summarize(df: DataFrame, label: str, measure: str, stands_out: float = 1.2) -> DataFrame:
    """Rows, total, mean, highest and lowest of any result, and whether one group stands out.

    A zero or missing value is never the highest or the lowest unless no other value
    exists. The first label wins ties.
    """
    value = F.col(measure).try_cast("double")
    nonzero = F.when(value != 0, value)
    infinity = F.lit(float("inf"))
    hi_key = F.struct((-F.coalesce(nonzero, -infinity)).alias("o"), F.col(label).alias("k"),
                      value.alias("v"))
    lo_key = F.struct(F.coalesce(nonzero, infinity).alias("o"), F.col(label).alias("k"),
                      value.alias("v"))
    stats = df.agg(
        F.count("*").alias("rows_analyzed"),
        F.sum(value).alias("total"),
        F.avg(value).alias("mean"),
        F.min(hi_key).alias("hi"),
        F.min(lo_key).alias("lo"),
    )
    highest = F.coalesce(F.col("hi.v"), F.lit(0.0)).cast("bigint")
    lowest = F.coalesce(F.col("lo.v"), F.lit(0.0)).cast("bigint")
    ratio = F.when(F.col("mean") > 0, highest / F.col("mean")).otherwise(0.0)
    return stats.select(
        "rows_analyzed",
        F.col("total").cast("bigint").alias("total_count"),
        F.round("mean", 2).alias("average_count"),
        F.col("hi.k").cast("string").alias("highest_label"),
        highest.alias("highest_count"),
        F.col("lo.k").cast("string").alias("lowest_label"),
        lowest.alias("lowest_count"),
        (ratio >= stands_out).alias("stands_out"),
    )


def count_stats(df: DataFrame, measure: str) -> DataFrame:
    """Total and mean (2 decimals) of a count column."""
    return df.agg(F.sum(measure).alias("total"), F.round(F.avg(measure), 2).alias("average"))


def pick_measure(schema: T.StructType) -> str | None:
    """Measure column by preference, else the first numeric one. Reads no data."""
    for name in fv.MEASURE_COLUMNS:
        if name in schema.names:
            return name
    return next((f.name for f in schema if isinstance(f.dataType, T.NumericType)), None)


def pick_label(schema: T.StructType) -> str | None:
    """Label column by preference, else the first text one that is not an id or index."""
    for name in fv.LABEL_COLUMNS:
        if name in schema.names:
            return name
    return next(
        (f.name for f in schema
         if isinstance(f.dataType, T.StringType) and f.name.lower() not in ("id", "index")),
        None,
    )


def first_last_change(df: DataFrame, order: str, measure: str) -> DataFrame:
    """Value at the first and last position and the change between them in percent."""
    ends = df.agg(
        F.min(order).alias(f"first_{order}"),
        F.min_by(measure, order).alias("first_value"),
        F.max(order).alias(f"last_{order}"),
        F.max_by(measure, order).alias("last_value"),
    )
    return ends.withColumn("change_pct", pct_difference("last_value", "first_value"))


def per_day_rates(
    counts: DataFrame, event: str, event_days: Column, years: Column,
    keys: Sequence[str] = ("day_type", "primary_type"), measure: str = "total",
) -> DataFrame:
    """Mean per day on the event's days and on all others of the covered years."""
    days = F.when(F.col("day_type") == event, event_days).otherwise(years * 365.25 - event_days)
    return counts.select(
        *keys, F.col(measure).alias("total"), F.round(rate(measure, days), 1).alias("daily_avg")
    )


def compare_flags(wide: DataFrame, key: str, on: str, off: str) -> DataFrame:
    """Difference in percent between the two columns of a flag pivot."""
    change = pct_difference(on, off)
    return wide.select(key, F.col(on), F.col(off), change.alias("pct_diff"),
                       direction(change).alias("direction"))
