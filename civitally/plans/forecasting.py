"""The forecast analysis: backtest, choice of set-up, forecast, shock gap, result tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendars as cal
from ..functions import fixed_values as fv
from ..operators import series as ts, smoothing


@dataclass(frozen=True)
class Periods:
    """Month limits of an analysis (``YYYY-MM``, inclusive)."""

    backtest_train_end: str = fv.BACKTEST_TRAIN_END
    backtest_start: str = fv.BACKTEST_START
    backtest_end: str = fv.BACKTEST_END
    train_end: str = fv.TRAIN_END
    shock_start: str = fv.SHOCK_START
    shock_end: str = fv.SHOCK_END
    horizon: int = fv.HORIZON
    train_starts: tuple[str | None, ...] = fv.TRAIN_STARTS
    seasonals: tuple[str, ...] = fv.SEASONAL_TYPES
    rank_year: int = fv.RANK_YEAR
    top_n: int = fv.TOP_TYPES

    @property
    def backtest_months(self) -> int:
        return cal.index_of(self.backtest_end) - cal.index_of(self.backtest_start) + 1


def candidate_series(series: DataFrame, periods: Periods = Periods()) -> DataFrame:
    """The total and the top series, dense."""
    top = ts.top_series(series, periods.top_n, periods.rank_year).select("series")
    total = series.filter(F.col("series") == ts.TOTAL).select("series").distinct()
    return ts.densify(series).join(top.unionByName(total), "series", "left_semi")


def skipped_series(
    candidates: DataFrame, setup: DataFrame, periods: Periods = Periods()
) -> DataFrame:
    """series, reason: candidates that cannot be fitted from the chosen start to the end of training.

    ``zero``: a value of 0 or below; ``short``: fewer months than two seasons.
    """
    start = setup.select(cal.index_from_label(F.col("train_start"))).scalar()
    known = candidates.select("series").distinct()
    used = candidates.filter(
        (F.col("month_idx") >= start) & ts.between_months(None, periods.train_end))
    stats = used.groupBy("series").agg(F.min("value").alias("least"), F.count("*").alias("n"))
    reason = F.when(F.col("least") <= 0, "zero").when(
        F.coalesce("n", F.lit(0)) < smoothing.MIN_MONTHS, "short")
    judged = known.join(stats, "series", "left").select("series", reason.alias("reason"))
    return judged.filter(F.col("reason").isNotNull())


def analysed_series(
    candidates: DataFrame, setup: DataFrame, periods: Periods = Periods()
) -> DataFrame:
    """Candidates without the skipped ones. ``setup`` is chosen on the total beforehand."""
    return candidates.join(skipped_series(candidates, setup, periods), "series", "left_anti")


def backtest_forecasts(
    series: DataFrame, periods: Periods = Periods(), interval: float | None = None,
    refine: int = 0,
) -> DataFrame:
    """Forecast of the held-out year for every series and set-up."""
    train = series.filter(ts.between_months(None, periods.backtest_train_end))
    setups = smoothing.with_setups(train, periods.train_starts, periods.seasonals)
    return smoothing.ets_forecast(
        setups, periods.backtest_months, interval=interval, refine=refine
    )


def backtest_scores(series: DataFrame, periods: Periods = Periods(), refine: int = 0) -> DataFrame:
    """MAE and MAPE per series and set-up."""
    forecasts = backtest_forecasts(series, periods, refine=refine)
    return ts.error_metrics(ts.with_actual(forecasts, series), smoothing.SETUP)


def choose_setup(scores: DataFrame) -> DataFrame:
    """The set-up with the lowest MAPE per series; ties go to the earlier start, then season."""
    best = F.min(F.struct("mape", "train_start", "seasonal", "mae")).alias("best")
    return scores.groupBy("series").agg(best).select(
        "series", "best.train_start", "best.seasonal", "best.mae", "best.mape"
    )


def forecasts_with_setup(
    series: DataFrame, setup: DataFrame, train_end: str, horizon: int,
    periods: Periods = Periods(), interval: float | None = 0.8, refine: int = 0,
) -> DataFrame:
    """Forecast every series after ``train_end`` with the one set-up in ``setup``."""
    one = setup.select(F.struct("train_start", "seasonal").alias("setup")).scalar()
    train = series.filter(ts.between_months(None, train_end)).filter(
        F.col("month_idx") >= cal.index_from_label(one["train_start"]))
    wanted = train.select("series", one["train_start"].alias("train_start"),
                          one["seasonal"].alias("seasonal"), "month_idx", "value")
    return smoothing.ets_forecast(wanted, horizon, interval=interval, refine=refine)


def backtest_table(
    series: DataFrame, setup: DataFrame, periods: Periods = Periods(), refine: int = 0
) -> DataFrame:
    """Held-out months with actual, baseline, model and interval, rounded to whole counts."""
    model = forecasts_with_setup(
        series, setup, periods.backtest_train_end, periods.backtest_months, periods, refine=refine
    ).select("series", "month_idx", F.col("predicted").alias("model"), "lower", "upper")
    baseline = ts.seasonal_naive(series).filter(
        ts.between_months(periods.backtest_start, periods.backtest_end)
    ).select("series", "month_idx", F.col("value").alias("actual"),
             F.col("predicted").alias("baseline"))
    joined = baseline.join(model, ["series", "month_idx"])
    measures = ("actual", "baseline", "model", "lower", "upper")
    return joined.select("series", "month_idx", *[F.round(m).alias(m) for m in measures])


def series_analysis(
    series: DataFrame, setup: DataFrame, forecast: DataFrame, periods: Periods = Periods(),
    refine: int = 0,
) -> DataFrame:
    """Backtest errors and shock gap of every series with the given set-up."""
    model = forecasts_with_setup(
        series, setup, periods.backtest_train_end, periods.backtest_months, periods,
        interval=None, refine=refine,
    )
    model_scores = ts.error_metrics(ts.with_actual(model, series)).select(
        "series", "mae", "mape")
    baseline = ts.seasonal_naive(series).filter(
        ts.between_months(periods.backtest_start, periods.backtest_end)
    ).withColumnRenamed("value", "actual")
    baseline_scores = ts.error_metrics(baseline).select(
        "series", F.col("mape").alias("baseline_mape"))
    gaps = ts.shock_summary(ts.shock_gap(forecast, shock_months(series, periods)))
    return model_scores.join(baseline_scores, "series").join(gaps, "series")


def shock_months(series: DataFrame, periods: Periods = Periods()) -> DataFrame:
    return series.filter(ts.between_months(periods.shock_start, periods.shock_end))


def forecast_rows(forecast: DataFrame, series: DataFrame, periods: Periods = Periods()) -> DataFrame:
    """Result table: one row per series and forecast month, actual only in the shock months."""
    joined = ts.with_actual(forecast, shock_months(series, periods), "left")
    index = F.col("month_idx")
    return joined.select(
        "series", cal.year_of(index).alias("year"), cal.month_of(index).alias("month"),
        "predicted", F.col("lower").alias("lower_bound"), F.col("upper").alias("upper_bound"),
        "actual",
    )


def forecast_metrics(
    analysis: DataFrame, setup: DataFrame, periods: Periods = Periods()
) -> DataFrame:
    """Result table: model, training range and scores of every series."""
    one = setup.select(F.struct("train_start", "seasonal").alias("setup")).scalar()
    season = F.when(one["seasonal"] == "add", "additive").otherwise("multiplicative")
    return analysis.select(
        "series",
        F.format_string("Holt-Winters ETS, damped additive trend, %s seasonality", season)
        .alias("model"),
        one["train_start"].alias("train_start"),
        F.lit(periods.train_end).alias("train_end"),
        "mae", "mape", "baseline_mape",
        F.col("shock_gap_pct").alias("covid_gap_pct"),
        "worst_month_gap_pct", "months_below_interval",
    )


def coverage(backtest: DataFrame) -> DataFrame:
    """Result table: held-out months of each series, and those whose count lies in the interval."""
    inside = F.col("actual").between(F.col("lower"), F.col("upper"))
    return backtest.groupBy("series").agg(
        F.count_if(inside).alias("months_inside"), F.count("*").alias("months"))


def type_report(analysis: DataFrame) -> DataFrame:
    """Result table: the series but the total, the largest loss against the forecast first."""
    shown = analysis.filter(F.col("series") != ts.TOTAL).select(
        "series", "mape", "baseline_mape", "shock_gap_pct", "worst_month_gap_pct", "months_below_interval")
    return shown.withColumn("place", F.row_number().over(Window.orderBy("shock_gap_pct", "series"))).orderBy("place")


def series_list(metrics: DataFrame) -> DataFrame:
    """Series names, the total first."""
    listed = metrics.select("series").distinct()
    return listed.orderBy((F.col("series") == ts.TOTAL).desc(), F.col("series").asc())


def chart_rows(
    forecast_table: DataFrame, series: DataFrame, name: str,
    history_start: int = fv.HISTORY_START_YEAR,
) -> DataFrame:
    """History and forecast of one series; the last history month also starts the prediction.

    A name that was not forecast raises KeyError with the names that were (a handful).
    """
    forecast = forecast_table.filter(F.col("series") == name)
    if forecast.isEmpty():
        known = sorted(r.series for r in forecast_table.select("series").distinct().collect())
        raise KeyError(f"no forecast of {name!r}; there are {', '.join(known)}")
    key = cal.month_key(F.col("year"), F.col("month"))
    first = forecast.agg(F.min(key).alias("first")).scalar()
    index = F.col("month_idx")
    history = series.filter(F.col("series") == name).select(
        cal.year_of(index).alias("year"), cal.month_of(index).alias("month"),
        F.col("value").alias("actual"),
    ).filter((F.col("year") >= history_start) & (key < first))
    last = history.agg(F.max(key).alias("last")).scalar()
    date = cal.month_label(F.col("year"), F.col("month")).alias("date")
    past = history.select(
        date, "actual", F.when(key == last, F.col("actual")).alias("predicted"))
    ahead = forecast.select(
        date, "actual", "predicted", F.col("lower_bound").alias("lower"),
        F.col("upper_bound").alias("upper"))
    return past.unionByName(ahead, allowMissingColumns=True)
