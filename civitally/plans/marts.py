"""The 24 summary tables, each derived from one of the cubes.

``build_cubes`` scans the incident table once. Every mart below is a small aggregate of
a cube, so regex rules run on distinct labels and no mart reads the incident table again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendars as cal
from ..functions import fixed_values as fv
from ..functions import text
from ..operators import counting as ct
from ..operators.cubes import cube


@dataclass(frozen=True)
class Mart:
    """A summary table: key columns, what it holds, and how to derive it.

    ``category`` and ``label`` place it in the catalogue; both are None if it is not listed.
    """

    name: str
    keys: tuple[str, ...]
    description: str
    build: Callable[[DataFrame, DataFrame], DataFrame]
    category: str | None = None
    label: str | None = None


_MARTS: dict[str, Mart] = {}

# Categories of the catalogue, and the names and descriptions of marts below.
_TIME = "Time-of-Day"
_SEASONAL = "Seasonal / Monthly / Holiday"
_PLACES = "Location-Based / Spatial"
_TRENDS = "Long-Term Trends"


def _mart(keys: tuple[str, ...], description: str, category: str | None = None,
          label: str | None = None):
    def register(build: Callable[[DataFrame, DataFrame], DataFrame]):
        _MARTS[build.__name__] = Mart(
            build.__name__, keys, description, build, category, label)
        return build

    return register


def marts() -> dict[str, Mart]:
    return dict(_MARTS)


def catalogue() -> dict[str, dict[str, str]]:
    """Category -> label -> table of the listed marts."""
    listed: dict[str, dict[str, str]] = {}
    for mart in _MARTS.values():
        if mart.category and mart.label:
            listed.setdefault(mart.category, {})[mart.label] = mart.name
    return listed


def derive_marts(cubes: DataFrame, holidays: DataFrame) -> dict[str, DataFrame]:
    """Every mart from the cubes and the holiday dimension (holiday_date, holiday_name)."""
    return {name: mart.build(cubes, holidays) for name, mart in _MARTS.items()}


def _by_type(cubes: DataFrame, where: Column) -> DataFrame:
    return ct.sum_by(cube(cubes, "by_date_type"), ["primary_type"], "n", "total", where)


def _by_flag(cubes: DataFrame, on_days: Column, event: str, types: tuple[str, ...]) -> DataFrame:
    keys = {"day_type": cal.day_flag(on_days, event), "primary_type": F.col("primary_type")}
    where = F.col("primary_type").isin(list(types))
    return ct.sum_by(cube(cubes, "by_date_type"), keys, "n", "total", where)


def _labels(cubes: DataFrame, tidy: bool = True) -> DataFrame:
    """Counts by label and type; the label is tidied as all place marts need it."""
    counts = cube(cubes, "by_label_type")
    label = text.tidy_text("location_description") if tidy else F.col("location_description")
    return counts.withColumn("location_description", label)


def _dated(cubes: DataFrame, key: Column, key_name: str) -> DataFrame:
    return ct.sum_by(cube(cubes, "by_date_type"), {key_name: key}, "n", "total_crimes")


@_mart(("hour",), "Incidents for each hour of the day.", _TIME, "Hourly Crimes")
def hourly_crimes(cubes, holidays):
    return ct.sum_by(cube(cubes, "by_hour"), ["hour"], "n", "crime_count")


@_mart(("time_period",), "Incidents in daytime, evening and overnight.", _TIME,
       "Time Period Crimes")
def time_period_crimes(cubes, holidays):
    return ct.sum_by(cube(cubes, "by_hour"), {"time_period": cal.time_period(F.col("hour"))},
                     "n", "total_crimes")


@_mart(("month",), "Incidents per calendar month.", _SEASONAL, "Monthly Crimes")
def monthly_crimes(cubes, holidays):
    return _dated(cubes, F.month("date_only"), "month")


@_mart(("season",), "Incidents in summer, late winter and the other months.", _SEASONAL,
       "Season Crimes")
def season_crimes(cubes, holidays):
    return _dated(cubes, cal.season(F.month("date_only")), "season")


@_mart(("day_type",), "Incidents on holidays and on other days.", _SEASONAL,
       "Holiday vs Non-Holiday")
def holiday_vs_nonholiday(cubes, holidays):
    return holiday_split(cube(cubes, "by_date_type"), holidays, weight="n")


@_mart(("primary_type",), "Incidents by type in December.")
def christmas_by_type(cubes, holidays):
    return _by_type(cubes, cal.in_month("date_only", 12))


@_mart(("day_type", "primary_type"), "Property incidents in December and in other months.",
       _SEASONAL, "Christmas")
def christmas_vs_nonchristmas_by_type(cubes, holidays):
    return _by_flag(cubes, cal.in_month("date_only", 12), "Christmas", fv.CHRISTMAS_TYPES)


@_mart(("primary_type",), "Incidents by type on Thanksgiving.")
def thanksgiving_by_type(cubes, holidays):
    return _by_type(cubes, cal.in_dates("date_only", fv.THANKSGIVING_DATES))


@_mart(("day_type", "primary_type"), "Four types on Thanksgiving and on other days.",
       _SEASONAL, "Thanksgiving")
def thanksgiving_vs_nonthanksgiving_by_type(cubes, holidays):
    on_days = cal.in_dates("date_only", fv.THANKSGIVING_DATES)
    return _by_flag(cubes, on_days, "Thanksgiving", fv.THANKSGIVING_TYPES)


@_mart(("primary_type",), "Incidents by type on Halloween.")
def halloween_by_type(cubes, holidays):
    return _by_type(cubes, cal.on_day("date_only", 10, 31))


@_mart(("day_type", "primary_type"), "Three types on Halloween and on other days.",
       _SEASONAL, "Halloween")
def halloween_vs_nonhalloween_by_type(cubes, holidays):
    return _by_flag(cubes, cal.on_day("date_only", 10, 31), "Halloween", fv.HALLOWEEN_TYPES)


@_mart(("location_category",), "Incidents per category of place.", _PLACES, "Crimes by Location")
def crimes_by_location(cubes, holidays):
    return ct.sum_by(_categories(cubes), ["location_category"], "n", "total_crimes")


@_mart(("location_category",), "Most common type per category of place.", _PLACES,
       "Crimes by Location & Type")
def crimes_by_location_and_type(cubes, holidays):
    counts = ct.sum_by(_categories(cubes), ["location_category", "primary_type"], "n", "total")
    return ct.top_item_per_group(
        counts, "location_category", "primary_type", total_name="location_total")


@_mart(("community_area",), "Incidents per community area.", _PLACES, "Community Area Crimes")
def community_area_crimes(cubes, holidays):
    return ct.sum_by(cube(cubes, "by_area_type"), ["community_area"], "n", "total_crimes",
                     text.has_text("community_area"))


@_mart(("location_type",), "Theft share at airports and other places.", _PLACES,
       "Airport Theft Comparison")
def airport_theft_count_comparison(cubes, holidays):
    kind = text.classify("location_description", fv.AIRPORT_CATEGORIES, fv.AIRPORT_DEFAULT)
    return _typed_share(cubes, kind, "THEFT", "theft_count", "theft_rate")


@_mart(("area_type",), "Theft and robbery share downtown and elsewhere.", _PLACES,
       "Downtown vs Residential")
def downtown_vs_residential_theft_robbery(cubes, holidays):
    counts = cube(cubes, "by_area_type").filter(text.has_text("community_area"))
    return area_share(counts, weight="n")


@_mart(("location_type",), "Robbery share in transit, commercial and other places.", _PLACES,
       "Transit vs Commercial")
def transit_vs_commercial_robbery_count(cubes, holidays):
    kind = text.classify("location_description", fv.TRANSIT_CATEGORIES, fv.TRANSIT_DEFAULT)
    return _typed_share(cubes, kind, "ROBBERY", "robbery_count", "robbery_rate")


@_mart(("location_description",), "Thefts and all incidents per normalised place.", _PLACES,
       "Theft by Location")
def theft_by_location(cubes, holidays):
    counts = _labels(cubes).filter(text.has_text("location_description"))
    label = {"location_description": text.normalize_label("location_description")}
    return ct.share_by(counts, label, F.col("primary_type") == "THEFT", "total_thefts",
                       "total_crimes", weight="n")


@_mart(("crime_category",), "Incidents at sports venues by group of types.", _PLACES,
       "Sports Location Crimes")
def sport_location_crimes(cubes, holidays):
    group = text.classify_values("primary_type", fv.TYPE_GROUPS, fv.TYPE_GROUP_DEFAULT)
    return ct.sum_by(_venues(cubes), {"crime_category": group}, "n", "total_crimes")


@_mart(("location_description", "primary_type"), "Incidents per sports venue and type.")
def sport_location_crimes_by_type(cubes, holidays):
    return ct.sum_by(_venues(cubes), ["location_description", "primary_type"], "n",
                     "total_crimes")


@_mart(("year",), "Incidents per year.", _TRENDS, "Yearly Crimes")
def yearly_crimes(cubes, holidays):
    return _dated(cubes, F.year("date_only"), "year")


@_mart(("primary_type",), "Incidents by type in 2007 to 2009.", _TRENDS,
       "Great Recession by Type")
def great_recession_by_type(cubes, holidays):
    return _by_type(cubes, cal.in_years("date_only", fv.RECESSION_YEARS))


@_mart(("year", "month"), "Incidents per month, without a partial last month.")
def monthly_trend(cubes, holidays):
    kept = _whole_months(cubes)
    return ct.sum_by(kept, {"year": F.year("date_only"), "month": F.month("date_only")}, "n",
                     "total_crimes")


@_mart(("year", "month", "primary_type"),
       "Incidents per month and type, without a partial last month.")
def monthly_trend_by_type(cubes, holidays):
    keys = {"year": F.year("date_only"), "month": F.month("date_only"),
            "primary_type": F.col("primary_type")}
    return ct.sum_by(_whole_months(cubes), keys, "n", "total",
                     F.col("primary_type").isNotNull())


def holiday_split(df: DataFrame, holidays: DataFrame, weight: str | None = None) -> DataFrame:
    """Counts on and off the dimension's dates.

    Rows are counted by date before the join, and dates are made unique, so the join is
    between two small tables and cannot multiply rows.
    """
    if weight is None:
        df, weight = df.groupBy("date_only").agg(F.count("*").alias("n")), "n"
    dates = holidays.select(F.col("holiday_date").cast("date").alias("holiday_date")).distinct()
    joined = df.join(dates, F.col("date_only") == F.col("holiday_date"), "left")
    flag = cal.day_flag(F.col("holiday_date").isNotNull(), "Holiday")
    return ct.sum_by(joined, {"day_type": flag}, weight, "total_crimes")


def area_share(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Theft and robbery count, all incidents and rate, downtown and elsewhere."""
    downtown = F.col("community_area").try_cast("int").isin(list(fv.DOWNTOWN_AREAS))
    kind = {"area_type": cal.day_flag(downtown, "Downtown", "Residential")}
    part = F.col("primary_type").isin(list(fv.AREA_RATE_TYPES))
    return ct.share_by(df, kind, part, "tr_crimes", "total_crimes", "rate", weight)


def _typed_share(cubes, kind: Column, crime: str, part_name: str, rate_name: str) -> DataFrame:
    counts = _labels(cubes).filter(F.col("location_description").isNotNull())
    return ct.share_by(counts, {"location_type": kind}, F.col("primary_type") == crime,
                       part_name, "total_crimes", rate_name, weight="n")


def _categories(cubes: DataFrame) -> DataFrame:
    kept = _labels(cubes).filter(
        text.has_text("location_description")
        & text.not_containing("location_description", fv.LOCATION_EXCLUSIONS))
    return kept.withColumn("location_category", text.classify(
        "location_description", fv.LOCATION_CATEGORIES, fv.LOCATION_CATEGORY_DEFAULT))


def _venues(cubes: DataFrame) -> DataFrame:
    return _labels(cubes).filter(
        text.has_text("location_description")
        & F.col("location_description").rlike(fv.SPORT_PATTERN))


def _whole_months(cubes: DataFrame) -> DataFrame:
    from ..operators.series import drop_partial_month

    return drop_partial_month(cube(cubes, "by_date_type"), "date_only")
