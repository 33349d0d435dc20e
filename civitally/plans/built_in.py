"""Fixed answers over the marts: one result table for every question route.

``text.route`` names the mart a question is about; ``answer`` gives the rows that answer it.
All inputs are marts, so every answer is a small projection, rate or top list.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.rates import per_unit
from ..operators import counting as ct
from ..operators.answers import per_day_rates

ReadMart = Callable[[str], DataFrame]

# Days of each event, as (days per covered year, fixed days).
EVENT_DAYS = {
    "christmas_vs_nonchristmas_by_type": ("Christmas", 31, 0),
    "halloween_vs_nonhalloween_by_type": ("Halloween", 1, 0),
    "thanksgiving_vs_nonthanksgiving_by_type": ("Thanksgiving", 0, 21),
}

# Top lists as (mart, label, measure, rows); None keeps every row.
TOP_LISTS = {
    "great_recession_by_type": ("primary_type", "total", 10),
    "community_area_crimes": ("community_area", "total_crimes", 10),
    "theft_by_location": ("location_description", "total_thefts", 10),
    "time_period_crimes": ("time_period", "total_crimes", None),
    "sport_location_crimes": ("crime_category", "total_crimes", None),
    "crimes_by_location": ("location_category", "total_crimes", None),
    "airport_theft_count_comparison": ("location_type", "theft_rate", None),
    "downtown_vs_residential_theft_robbery": ("area_type", "rate", None),
    "transit_vs_commercial_robbery_count": ("location_type", "robbery_count", None),
}

# Marts shown in order of their key.
ORDERED = {"hourly_crimes": "hour", "monthly_crimes": "month", "yearly_crimes": "year"}


def answer(
    table: str, read: ReadMart, crime: str | None = None, holidays: DataFrame | None = None
) -> DataFrame:
    """Rows that answer a question routed to ``table``; ``crime`` narrows event comparisons."""
    if table in EVENT_DAYS:
        event, per_year, fixed = EVENT_DAYS[table]
        years = _covered_years(read)
        rows = read(table)
        if crime:
            rows = rows.filter(F.col("primary_type") == crime)
        return per_day_rates(rows, event, years * per_year + fixed, years)
    if table == "holiday_vs_nonholiday":
        if holidays is None:
            raise ValueError("the holiday comparison needs the holiday dimension")
        days = holidays.agg(F.count("*")).scalar()
        return per_day_rates(read(table), "Holiday", days, _covered_years(read), ["day_type"],
                             "total_crimes")
    if table == "season_crimes":
        per_month = F.round(per_unit("total_crimes", "season", fv.MONTHS_PER_SEASON))
        return read(table).withColumn("per_month", per_month).orderBy(F.desc("per_month"))
    if table in ORDERED:
        return read(table).orderBy(ORDERED[table])
    if table not in TOP_LISTS:
        raise KeyError(f"no fixed answer for {table}")
    label, measure, rows = TOP_LISTS[table]
    if rows is None:
        return read(table).orderBy(F.desc(measure), label)
    return ct.top_rows(read(table), rows, measure, [label])


def _covered_years(read: ReadMart):
    return read("yearly_crimes").agg(F.count("*")).scalar()
