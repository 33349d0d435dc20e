"""From the raw text table to the clean incident table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema
from ..functions import fixed_values as fv
from ..functions import text
from ..session import shared_table
from ..sources.writers import YEAR_FOLDER
from . import quality


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Lower-case column names with underscores for spaces."""
    return df.toDF(*[name.lower().replace(" ", "_") for name in df.columns])


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows with a value in every listed column."""
    return df.dropna(subset=list(columns))


def dedup_by_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None,
    ordered: Sequence[str] = (), stored: bool = False, most: int = quality.REPEATED_KEYS,
) -> DataFrame:
    """One row per key, always the same one: first in ``order``, then by every other column.

    ``ordered`` names the columns that ``order`` already decides. NULL keys count as one key. By default
    all rows are shuffled and sorted by key (``first_by_key``), which reads ``df`` once. Say ``stored`` if
    it can be read several times at little cost: a first pass over the keys alone then finds those that several
    rows have, rows of all others stay where they are, and only the few in question are shuffled and
    sorted whole. With more than ``most`` repeated keys all rows are.
    """
    hashes = quality.repeated_hashes(df, keys, most) if stored else None
    if hashes is None:
        return first_by_key(df, keys, order, ordered)
    alone = quality.with_hash_in(df, keys, hashes, "left_anti")
    return alone.unionByName(first_by_key(quality.with_hash_in(df, keys, hashes), keys, order, ordered))


def first_by_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None, ordered: Sequence[str] = (),
) -> DataFrame:
    """``dedup_by_key`` by one window over all rows.

    Spark limits each key to one row per map task before the shuffle (WindowGroupLimit), so a
    hot key reaches its reducer as one row per task.
    """
    ties = [F.col(f"`{name}`").asc_nulls_last() for name in df.columns
            if name not in keys and name not in ordered]
    window = Window.partitionBy(*keys).orderBy(*(order or ()), *ties)
    return df.withColumn("_pick", F.row_number().over(window)).filter("_pick = 1").drop("_pick")


def clean_incidents(
    raw: DataFrame,
    exclusions: Sequence[str] = fv.CLEANING_EXCLUSIONS,
    required: Sequence[str] = schema.REQUIRED_COLUMNS,
    dropped: Sequence[str] = schema.DROPPED_COLUMNS,
    staged: bool = False,
) -> DataFrame:
    """Clean incident rows from the raw text table.

    Required columns are tested before dates are parsed, so an unreadable date stays as
    NULL. Duplicates are removed before labels are excluded, and a NULL label is excluded
    with them. Columns that go away are dropped first. ``staged`` writes the parsed
    rows to the shared folder before duplicates are looked for, so that a text source is parsed once.
    """
    table = snake_case_columns(raw)
    kept = require(table, required).drop(*dropped)
    parsed = kept.withColumns({
        "date": text.parse_ts("date", schema.TIMESTAMP_FORMAT),
        "arrest": text.parse_bool("arrest"),
        "domestic": text.parse_bool("domestic"),
    })
    if staged:
        parsed = shared_table(parsed, "parsed")
    unique = dedup_by_key(parsed, ["id"], [F.col("date").desc_nulls_last()], ["date"], stored=staged)
    return unique.filter(text.not_containing("location_description", exclusions))


def typed_view(df: DataFrame, name: str | None = None) -> DataFrame:
    """Clean table with numbers cast and x, y renamed; registered as a view if named.

    The folder column of a written table comes along: ``year`` is the text year of the source, which
    may be missing or wrong, so only the folder column can skip folders.
    """
    typed = df.select(
        "id",
        "date",
        text.parse_int("year").alias("year"),
        "primary_type",
        "description",
        "location_description",
        "arrest",
        "domestic",
        text.parse_int("community_area").alias("community_area"),
        F.col("x").try_cast("double").alias("longitude"),
        F.col("y").try_cast("double").alias("latitude"),
        *(c for c in df.columns if c == YEAR_FOLDER),
    )
    if name:
        typed.createOrReplaceTempView(name)
    return typed


def quality_report(clean: DataFrame) -> DataFrame:
    """measure, item, value: description of x and y, counts of the flags, distinct types, in one scan."""
    flags = [F.count_if(F.col(c).eqNullSafe(F.lit(v))).cast("double").alias(f"{c}|{v}")
             for c in ("arrest", "domestic") for v in (True, False, None)]
    numbers = [f(F.col(c).try_cast("double")).cast("double").alias(f"{c}|{name}") for c in ("x", "y") for name, f in (
        ("count", F.count), ("mean", F.avg), ("stddev", F.stddev_samp), ("min", F.min), ("max", F.max))]
    stats = clean.agg(*flags, *numbers, F.count_distinct("primary_type").cast("double").alias("primary_type|distinct"))
    rows = F.array(*[F.struct(F.lit(n.split("|")[0]).alias("item"), F.lit(n.split("|")[1].lower()).alias("measure"),
                              F.col(f"`{n}`").alias("value")) for n in stats.columns])
    return stats.select(F.inline(rows))


def clean_report(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Rows and columns before and after; pass the written tables to avoid a second clean."""
    sides = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(stage).alias("stage"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for stage, df in (("before", raw), ("after", clean))
    ]
    return sides[0].unionByName(sides[1])
