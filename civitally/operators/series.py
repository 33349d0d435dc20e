"""Monthly series in long form: one row per (series, month_idx), value as double.

``month_idx`` counts months since year 0 (``calendars.month_index``). Every step is keyed
by series, so the work spreads over as many tasks as there are series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendars as cal
from ..functions import fixed_values as fv

TOTAL = "ALL"


def drop_partial_month(df: DataFrame, ts: str = "date", min_last_day: int = 28) -> DataFrame:
    """Drop the last month if the data stops before its 28th day; NULL dates go as well.

    The cut-off is a scalar subquery over one column: nothing is collected, and rows are
    tested with a plain comparison that reaches the file statistics.
    """
    last = F.max(ts)
    cutoff = F.when(F.dayofmonth(last) >= min_last_day, F.date_add(F.to_date(last), 1)).otherwise(
        F.to_date(F.trunc(last, "month")))
    return df.filter(F.col(ts) < df.agg(cutoff.cast(df.schema[ts].dataType)).scalar())


def _whole_months(
    df: DataFrame, ts: str, kind: str | None = None, min_last_day: int = 28
) -> DataFrame:
    """Rows per year, month (and kind) without a partial last month, from one scan.

    The last date is the largest of the groups' own, so only the groups are looked at twice.
    """
    groups = [F.year(ts).alias("year"), F.month(ts).alias("month"), *([kind] if kind else [])]
    counts = df.filter(F.col(ts).isNotNull()).groupBy(*groups).agg(
        F.count("*").alias("n"), F.max(F.col(ts).cast("timestamp_ntz")).alias("_latest"))
    # As many rows as there are months and kinds, whatever the size of the input.
    last = F.max("_latest").over(Window.partitionBy())
    cut = (F.dayofmonth(last) < min_last_day) & (F.col("year") == F.year(last)) & (
        F.col("month") == F.month(last))
    return counts.withColumn("_cut", cut).filter(~F.col("_cut")).drop("_cut", "_latest")


def monthly_trend(df: DataFrame, ts: str = "date", min_last_day: int = 28) -> DataFrame:
    """Rows per year and month, without a partial last month."""
    return _whole_months(df, ts, None, min_last_day).withColumnRenamed("n", "total_crimes")


def monthly_trend_by_type(
    df: DataFrame, ts: str = "date", kind: str = "primary_type", min_last_day: int = 28
) -> DataFrame:
    """Rows per year, month and type, without a partial last month and NULL types."""
    counts = _whole_months(df, ts, kind, min_last_day)
    return counts.filter(F.col(kind).isNotNull()).withColumnRenamed("n", "total")


def monthly_series(df: DataFrame, ts: str = "date", kind: str = "primary_type") -> DataFrame:
    """One series per type and one for the total, from a single scan.

    Rows are counted per month and type first; the total is summed from those counts.
    """
    index = cal.month_index(F.col("year"), F.col("month")).alias("month_idx")
    counts = _whole_months(df, ts, kind).select(index, kind, "n")
    named = F.filter(F.array(F.lit(TOTAL), F.col(kind)), lambda s: s.isNotNull())
    return counts.select(F.explode(named).alias("series"), "month_idx", "n").groupBy(
        "series", "month_idx"
    ).agg(F.sum("n").cast("double").alias("value"))


def trend_series(trend: DataFrame, by_type: DataFrame, kind: str = "primary_type") -> DataFrame:
    """The same series from the two written monthly marts."""
    index = cal.month_index(F.col("year"), F.col("month")).alias("month_idx")
    total = trend.select(F.lit(TOTAL).alias("series"), index,
                         F.col("total_crimes").cast("double").alias("value"))
    each = by_type.select(F.col(kind).alias("series"), index,
                          F.col("total").cast("double").alias("value"))
    return total.unionByName(each)


def top_series(
    series: DataFrame, n: int = fv.TOP_TYPES, year: int = fv.RANK_YEAR
) -> DataFrame:
    """The n largest series of one year, without the total."""
    chosen = series.filter((F.col("series") != TOTAL) & (cal.year_of(F.col("month_idx")) == year))
    totals = chosen.groupBy("series").agg(F.sum("value").alias("total"))
    return totals.orderBy(F.desc("total"), F.asc("series")).limit(n)


def densify(series: DataFrame) -> DataFrame:
    """Every series on every month from the first to the last one of all, 0 where empty."""
    ends = series.agg(
        F.struct(F.min("month_idx").alias("lo"), F.max("month_idx").alias("hi")).alias("ends")
    ).scalar()
    months = F.sequence(ends["lo"], ends["hi"])
    calendar = series.select("series").distinct().select(
        "series", F.explode(months).alias("month_idx")
    )
    return calendar.join(series, ["series", "month_idx"], "left").select(
        "series", "month_idx", F.coalesce("value", F.lit(0.0)).alias("value")
    )


def between_months(first: str | None, last: str | None, index: str = "month_idx") -> Column:
    """True from ``first`` to ``last`` (``YYYY-MM``, both inclusive; None is open)."""
    test = F.lit(True)
    if first is not None:
        test = test & (F.col(index) >= cal.index_of(first))
    if last is not None:
        test = test & (F.col(index) <= cal.index_of(last))
    return test


def split_periods(
    series: DataFrame, start: str | None = None, *,
    backtest_train_end: str = fv.BACKTEST_TRAIN_END, backtest: tuple[str, str] = (
        fv.BACKTEST_START, fv.BACKTEST_END),
    train_end: str = fv.TRAIN_END, shock: tuple[str, str] = (fv.SHOCK_START, fv.SHOCK_END),
) -> DataFrame:
    """One row per month and period it belongs to; periods overlap."""
    periods = {
        "backtest_train": between_months(start, backtest_train_end),
        "backtest_test": between_months(*backtest),
        "train": between_months(start, train_end),
        "shock": between_months(*shock),
    }
    names = F.array(*[F.when(test, F.lit(name)) for name, test in periods.items()])
    held = F.filter(names, lambda name: name.isNotNull())
    return series.withColumn("period", F.explode(held))


def forecast_months(series: DataFrame, first: str = fv.SHOCK_START,
                    horizon: int = fv.HORIZON) -> DataFrame:
    """The months to forecast for every series."""
    start = cal.index_of(first)
    months = F.sequence(F.lit(start), F.lit(start + horizon - 1))
    return series.select("series").distinct().select("series", F.explode(months).alias("month_idx"))


def seasonal_naive(series: DataFrame, lag: int = 12) -> DataFrame:
    """Baseline: the value one year before, on a dense series."""
    window = Window.partitionBy("series").orderBy("month_idx")
    return series.withColumn("predicted", F.lag("value", lag).over(window))


def error_metrics(
    pairs: DataFrame, keys: Sequence[str] = ("series",), actual: str = "actual",
    predicted: str = "predicted",
) -> DataFrame:
    """MAE and MAPE per key; MAPE leaves out months whose actual is 0."""
    gap = F.abs(F.col(actual) - F.col(predicted))
    return pairs.groupBy(*keys).agg(
        F.avg(gap).alias("mae"),
        (F.avg(F.try_divide(gap, F.col(actual))) * 100).alias("mape"),
    )


def with_actual(forecast: DataFrame, series: DataFrame, how: str = "inner") -> DataFrame:
    """Forecast rows with the actual value of their month; ``left`` keeps months without one."""
    actual = series.select("series", "month_idx", F.col("value").alias("actual"))
    return forecast.join(actual, ["series", "month_idx"], how)


def shock_gap(forecast: DataFrame, actual: DataFrame) -> DataFrame:
    """Distance of every shock month from its forecast."""
    gap = F.col("actual") - F.col("predicted")
    return with_actual(forecast, actual).withColumns({
        "gap": gap,
        "gap_pct": F.try_divide(gap, F.col("predicted")) * 100,
        "below_interval": F.col("actual") < F.col("lower"),
    })


def shock_summary(gaps: DataFrame) -> DataFrame:
    """Per series: overall gap, worst month and months below the interval."""
    worst = F.struct(F.try_divide(F.col("actual"), F.col("predicted")).alias("ratio"), "month_idx")
    return gaps.groupBy("series").agg(
        ((F.try_divide(F.sum("actual"), F.sum("predicted")) - 1) * 100).alias("shock_gap_pct"),
        F.min("gap_pct").alias("worst_month_gap_pct"),
        F.min(worst).alias("_worst"),
        F.count_if("below_interval").cast("int").alias("months_below_interval"),
    ).select(
        "series", "shock_gap_pct", "worst_month_gap_pct",
        F.col("_worst.month_idx").alias("worst_month_idx"), "months_below_interval",
    )


def interval_coverage(forecast: DataFrame, actual: DataFrame) -> DataFrame:
    """Months whose actual lies inside the interval, of all months compared."""
    inside = F.col("actual").between(F.col("lower"), F.col("upper"))
    return with_actual(forecast, actual).groupBy("series").agg(
        F.count_if(inside).alias("months_inside"), F.count("*").alias("months")
    )
