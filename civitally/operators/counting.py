"""Counts by derived keys, shares, pivots, ranks and top rows.

Every count is a hash aggregate with a map-side partial, so one key holding a large part
of the rows reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rates import rate

Keys = Sequence[str] | Mapping[str, Column]


def count_by(
    df: DataFrame, keys: Keys, name: str = "total", where: Column | None = None
) -> DataFrame:
    """Rows per key. Keys are column names, or a mapping from new name to expression."""
    rows = df if where is None else df.filter(where)
    return rows.groupBy(*_key_columns(keys)).agg(F.count("*").alias(name))


def sum_by(
    counts: DataFrame, keys: Keys, measure: str, name: str, where: Column | None = None
) -> DataFrame:
    """Roll counts up to coarser keys."""
    rows = counts if where is None else counts.filter(where)
    return rows.groupBy(*_key_columns(keys)).agg(F.sum(measure).alias(name))


def sum_by_label(
    df: DataFrame, label: str, derived: Mapping[str, Column], name: str = "total",
    other_keys: Sequence[str] = (), where: Column | None = None,
) -> DataFrame:
    """Count by expressions of a label: group the labels first, then evaluate and roll up.

    The expressions and ``where`` (regex chains over the label and the other keys) run once
    per distinct label and not once per row. ``where`` is a conditional sum, because Spark
    would push a filter on grouping keys back down to the rows.
    """
    counts = count_by(df, [label, *other_keys], "_n")
    keys = {**derived, **{k: F.col(k) for k in other_keys}}
    if where is None:
        return sum_by(counts, keys, "_n", name)
    kept = counts.groupBy(*_key_columns(keys)).agg(F.sum(F.when(where, F.col("_n"))).alias(name))
    return kept.filter(F.col(name).isNotNull())


def share_by(
    df: DataFrame, keys: Keys, part: Column, part_name: str, total_name: str = "total",
    rate_name: str | None = None, weight: str | None = None,
) -> DataFrame:
    """Rows matching ``part``, all rows and their ratio per key, in one pass.

    Keys without a matching row are left out. With ``weight`` the input already holds counts.
    """
    one = F.lit(1) if weight is None else F.col(weight)
    shares = df.groupBy(*_key_columns(keys)).agg(
        F.sum(F.when(part, one)).alias(part_name), F.sum(one).alias(total_name)
    ).filter(F.col(part_name) > 0)
    if rate_name:
        shares = shares.withColumn(rate_name, rate(part_name, total_name))
    return shares


def join_totals(parts: DataFrame, totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join of two aggregates on their key; ``share_by`` gives the same in one pass."""
    return parts.join(totals, on=list(keys), how="inner")


def wide_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """One row with the number of rows meeting each condition."""
    return df.agg(*[F.count_if(test).alias(name) for name, test in conditions.items()])


def pivot_flags(
    counts: DataFrame, key: str, flag: str, values: Sequence[str], measure: str = "total"
) -> DataFrame:
    """One column per flag value, 0 where the key has no such row."""
    wide = counts.groupBy(key).pivot(flag, list(values)).agg(F.sum(measure))
    return wide.na.fill(0, subset=list(values))


def rank_within(
    counts: DataFrame, group: str, item: str, measure: str = "total",
    total_name: str = "group_total", rank_name: str = "rank",
) -> DataFrame:
    """Items ranked by measure inside each group, with the group's total on every row.

    ``counts`` has one row per group and item. Ties are ranked by item.
    """
    by_size = Window.partitionBy(group).orderBy(F.desc(measure), F.col(item).asc_nulls_first())
    return counts.withColumns({
        total_name: F.sum(measure).over(Window.partitionBy(group)),
        rank_name: F.row_number().over(by_size),
    })


def top_item_per_group(
    counts: DataFrame, group: str, item: str, measure: str = "total",
    total_name: str = "group_total",
) -> DataFrame:
    """The largest item of each group with the group's total.

    A keyed aggregate, so it combines map-side and a hot group never fills one task.
    """
    # The largest measure wins; among equals the first item by name, NULL before any name.
    contender = F.struct((-F.col(measure)).alias("order"), F.col(item).alias("item"))
    best = counts.groupBy(group).agg(
        F.min(contender).alias("_best"), F.sum(measure).alias(total_name)
    )
    return best.select(
        group,
        F.col("_best.item").alias(item),
        (-F.col("_best.order")).alias(measure),
        total_name,
    )


def top_rows(df: DataFrame, n: int, measure: str, ties: Sequence[str]) -> DataFrame:
    """The n rows with the largest measure; ``ties`` decides between equals."""
    return df.orderBy(F.desc(measure), *[F.asc(t) for t in ties]).limit(n)


def first_rows(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """The first n rows in the given order; pass descending keys for the last rows."""
    return df.orderBy(*order).limit(n)


def hash_sample(
    df: DataFrame, key: str | Sequence[str], fraction: float, seed: int = 42
) -> DataFrame:
    """Rows whose key hashes below ``fraction``; where it is NULL, all columns stand in for it.

    The same rows whatever the partitioning or retries, unlike ``DataFrame.sample``. Equal
    rows go together. Several key columns are hashed with a mark for NULL.
    """
    keys = [key] if isinstance(key, str) else list(key)
    parts = [F.col(k).cast("string") for k in keys]
    if len(keys) > 1:
        parts = [F.coalesce(p, F.lit("\u0000")) for p in parts]
    rest = F.md5(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))).cast("binary"))
    named = F.concat_ws("|", F.lit(str(seed)), *parts)
    unnamed = F.concat_ws("|", F.lit(str(seed)), rest)
    empty = reduce(lambda a, b: a & b, [F.col(k).isNull() for k in keys])
    digest = F.md5(F.when(empty, unnamed).otherwise(named).cast("binary"))
    slot = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return df.filter(slot < int(fraction * 2**32))


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, min and max of each column, one row per column.

    All columns are measured in one scan; text is read as numbers where it can be.
    """
    numbers = df.select(*[F.col(c).try_cast("double").alias(c) for c in columns])
    stats = numbers.agg(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("n"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("stddev"),
            F.min(c).alias("min_value"),
            F.max(c).alias("max_value"),
        ).alias(f"s{i}")
        for i, c in enumerate(columns)
    ])
    rows = F.array(*[F.col(f"s{i}") for i in range(len(columns))])
    return stats.select(F.inline(rows))


def _key_columns(keys: Keys) -> list[Column]:
    if isinstance(keys, Mapping):
        return [expression.alias(name) for name, expression in keys.items()]
    return [F.col(name) for name in keys]
