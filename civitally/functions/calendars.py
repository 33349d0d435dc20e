"""Calendar parts, bands, event predicates and labels as Spark columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed_values as fv
from .choice import first_of

_MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)


def add_calendar_parts(df: DataFrame, ts: str = "date") -> DataFrame:
    """Add hour, month, day, date_only and year; ``year`` replaces a stored text year."""
    at = F.col(ts)
    return df.withColumns({
        "hour": F.hour(at),
        "month": F.month(at),
        "day": F.dayofmonth(at),
        "date_only": F.to_date(at),
        "year": F.year(at),
    })


def month_day(ts: str | Column) -> Column:
    """Month-day key such as ``07-04``."""
    return F.date_format(ts, "MM-dd")


def band(value: Column, bands: Sequence[tuple[str, Iterable[int]]], default: str | None) -> Column:
    """Name of the first band whose values contain ``value``.

    NULL falls into ``default``; with ``default=None`` it stays NULL.
    """
    chain = []
    for name, members in bands:
        if isinstance(members, range) and members.step == 1:
            test = value.between(members.start, members.stop - 1)
        else:
            test = value.isin(list(members))
        chain.append((test, name))
    return first_of(chain, F.lit(default))


def time_period(hour: Column, null_bucket: bool = True) -> Column:
    """Daytime, Evening or Overnight. Without ``null_bucket`` a NULL hour has no period."""
    if null_bucket:
        return band(hour, fv.TIME_PERIODS, fv.TIME_PERIOD_DEFAULT)
    bands = (*fv.TIME_PERIODS, (fv.TIME_PERIOD_DEFAULT, fv.OVERNIGHT_HOURS))
    return band(hour, bands, None)


def season(month: Column) -> Column:
    """Summer, Late Winter or Other; a NULL month is Other."""
    return band(month, fv.SEASONS, fv.SEASON_DEFAULT)


def day_flag(predicate: Column, on: str, off: str | None = None) -> Column:
    """``on`` where the predicate is true, else ``off`` (NULL counts as off)."""
    return F.when(predicate, on).otherwise(off or f"Non-{on}")


def in_month(ts: str | Column, month: int) -> Column:
    return F.month(ts) == month


def on_day(ts: str | Column, month: int, day: int) -> Column:
    return (F.month(ts) == month) & (F.dayofmonth(ts) == day)


def in_days(ts: str | Column, month: int, first: int, last: int) -> Column:
    return (F.month(ts) == month) & F.dayofmonth(ts).between(first, last)


def in_month_days(ts: str | Column, keys: Sequence[str]) -> Column:
    return month_day(ts).isin(list(keys))


def in_dates(ts: str | Column, dates: Iterable[str | dt.date], prune: bool = False) -> Column:
    """True on the listed dates.

    ``prune`` is for filters on a stored column: it says the same once more as ranges on the
    timestamp, in a form that reaches the file statistics, which ``to_date`` cannot.
    """
    column = F.col(ts) if isinstance(ts, str) else ts
    days = sorted({as_date(d) for d in dates})
    listed = F.to_date(column).isin(days)
    if not prune:
        return listed
    one_day = dt.timedelta(days=1)
    ranges: list[list[dt.date]] = []
    for day in days:
        if ranges and ranges[-1][1] == day:
            ranges[-1][1] = day + one_day
        else:
            ranges.append([day, day + one_day])
    return listed & _any_range(column, ranges)


def in_years(ts: str | Column, years: Iterable[int]) -> Column:
    """True in the listed years, as timestamp ranges for file pruning."""
    column = F.col(ts) if isinstance(ts, str) else ts
    ranges: list[list[dt.date]] = []
    for year in sorted(set(years)):
        start, end = dt.date(year, 1, 1), dt.date(year + 1, 1, 1)
        if ranges and ranges[-1][1] == start:
            ranges[-1][1] = end
        else:
            ranges.append([start, end])
    return _any_range(column, ranges)


def as_date(value: str | dt.date) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def _any_range(column: Column, ranges: list[list[dt.date]]) -> Column:
    test = F.lit(False)
    for position, (start, end) in enumerate(ranges):
        inside = (column >= F.lit(start)) & (column < F.lit(end))
        test = inside if position == 0 else test | inside
    return test


def month_name(month: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in _MONTH_NAMES]), month)


def hour_label(hour: Column) -> Column:
    """12-hour label such as ``11 PM``."""
    twelve = F.when(hour % 12 == 0, 12).otherwise(hour % 12)
    return F.concat(twelve.cast("string"), F.when(hour < 12, " AM").otherwise(" PM"))


def month_label(year: Column, month: Column) -> Column:
    """``YYYY-MM``."""
    return F.format_string("%d-%02d", year, month)


def month_key(year: Column, month: Column) -> Column:
    """``year * 100 + month``, for range tests."""
    return year * 100 + month


def month_index(year: Column, month: Column) -> Column:
    """Months since year 0; consecutive months differ by one."""
    return year * 12 + month - 1


def index_of(label: str) -> int:
    """Month index of a ``YYYY-MM`` text."""
    year, month = label.split("-")
    return int(year) * 12 + int(month) - 1


def year_of(index: Column) -> Column:
    return F.floor(index / 12).cast("int")


def month_of(index: Column) -> Column:
    return (index % 12 + 1).cast("int")


def label_of(index: Column) -> Column:
    """``YYYY-MM`` of a month index."""
    return month_label(year_of(index), month_of(index))


def index_from_label(label: Column) -> Column:
    """Month index of a ``YYYY-MM`` label."""
    return F.substring(label, 1, 4).cast("int") * 12 + F.substring(label, 6, 2).cast("int") - 1
