"""Filters on dates that name the year folders of the clean table as well."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendars as cal
from ..sources.writers import YEAR_FOLDER


def of_years(df: DataFrame, years: Iterable[int], ts: str = "date") -> DataFrame:
    """Rows of the listed years."""
    years = sorted(set(years))
    return _filtered(df, ts, cal.in_years(ts, years), [(dt.date(y, 1, 1), dt.date(y + 1, 1, 1)) for y in years])


def on_dates(df: DataFrame, dates: Iterable[str | dt.date], ts: str = "date") -> DataFrame:
    """Rows of the listed dates."""
    days = sorted({cal.as_date(d) for d in dates})
    one_day = dt.timedelta(days=1)
    return _filtered(df, ts, cal.in_dates(ts, days, prune=True), [(d, d + one_day) for d in days])


def between(df: DataFrame, start: str | dt.date, end: str | dt.date, ts: str = "date") -> DataFrame:
    """Rows from ``start`` up to, not including, ``end``."""
    low, high = cal.as_date(start), cal.as_date(end)
    inside = (F.col(ts) >= F.lit(low)) & (F.col(ts) < F.lit(high))
    return _filtered(df, ts, inside, [(low, high)])


def _filtered(df: DataFrame, ts: str, test: Column, ranges: Sequence[tuple[dt.date, dt.date]]) -> DataFrame:
    folder = folder_years(df, ts, ranges)
    return df.filter(test if folder is None else test & folder)


def folder_years(df: DataFrame, ts: str, ranges: Sequence[tuple[dt.date, dt.date]]) -> Column | None:
    """Condition on the folder column that holds wherever ``ts`` lies in a range; None without that column.

    Instants may be read in another time zone than the folders were written in, and time zones
    are at most 26 hours apart; so ranges of instants are taken two days wider on both sides.
    Timestamps without a zone are taken as they are.
    """
    if ts != "date" or YEAR_FOLDER not in df.columns:
        return None
    wide = dt.timedelta(days=2 if isinstance(df.schema[ts].dataType, T.TimestampType) else 0)
    years = {y for low, high in ranges if low < high
             for y in range((low - wide).year, (high + wide - dt.timedelta(days=1)).year + 1)}
    return F.col(YEAR_FOLDER).isin(sorted(years)) if years else F.lit(False)
