from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from civitally.functions import calendars as cal
from civitally.operators import series as ts, smoothing
from civitally.plans import forecasting as fc
from civitally.plans.jobs import run_forecast
from civitally.session import cut_lineage
from civitally.sources import readers, writers

from .conftest import rows

START = cal.index_of("2007-01")
MONTHS = cal.index_of("2020-06") - START + 1


def season(i):
    return 1 + 0.2 * math.sin(2 * math.pi * i / 12)


def make(spark, name, level, months=MONTHS, drop=1.0, zero_at=None):
    shock = cal.index_of("2020-03") - START
    data = []
    for i in range(months):
        value = round((level + 0.1 * i) * season(i) * (drop if i >= shock else 1.0))
        data.append((name, START + i, 0.0 if i == zero_at else float(value)))
    return spark.createDataFrame(data, "series string, month_idx int, value double")


@pytest.fixture(scope="module")
def monthly(spark):
    parts = [make(spark, "ALL", 1000, drop=0.7), make(spark, "THEFT", 500, drop=0.5),
             make(spark, "BATTERY", 300), make(spark, "RARE", 200, zero_at=120),
             make(spark, "EARLY", 150, zero_at=20)]
    df = parts[0]
    for part in parts[1:]:
        df = df.unionByName(part)
    return cut_lineage(df)


def test_densify_fills_with_zero(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 3, 4.0), ("b", 2, 5.0)],
                               "series string, month_idx int, value double")
    assert rows(ts.densify(df)) == [
        ("a", 1, 2.0), ("a", 2, 0.0), ("a", 3, 4.0), ("b", 1, 0.0), ("b", 2, 5.0), ("b", 3, 0.0)]


def test_mape_skips_zero_actuals(spark):
    df = spark.createDataFrame([("s", 0.0, 5.0), ("s", 10.0, 8.0)],
                               "series string, actual double, predicted double")
    row = ts.error_metrics(df).first()
    assert row.mae == 3.5 and row.mape == pytest.approx(20.0)


def test_series_with_a_zero_month_is_not_analysed(monthly):
    spark = monthly.sparkSession
    candidates = fc.candidate_series(monthly)
    for start, skipped in (("2012-01", {"RARE": "zero"}), ("2007-01", {"RARE": "zero", "EARLY": "zero"})):
        setup = spark.createDataFrame([(start, "mul")], "train_start string, seasonal string")
        names = {r.series for r in fc.analysed_series(candidates, setup).select("series").distinct().collect()}
        assert names == {"ALL", "THEFT", "BATTERY", "RARE", "EARLY"} - set(skipped)
        assert dict(rows(fc.skipped_series(candidates, setup))) == skipped
    late = spark.createDataFrame([("2019-01", "mul")], "train_start string, seasonal string")
    assert {r.reason for r in fc.skipped_series(candidates, late).collect()} == {"short"}


def test_periods(monthly):
    counts = {r.period: r["count"] for r in
              ts.split_periods(monthly.filter("series = 'ALL'")).groupBy("period").count().collect()}
    assert counts == {"backtest_train": 146, "backtest_test": 12, "train": 158, "shock": 4}


def plain_fit(y, seasonal):
    """The recursion written out one parameter point at a time."""
    best = None
    for alpha, beta, gamma, phi in smoothing.parameter_grid():
        level = sum(y[:12]) / 12
        trend = (sum(y[12:24]) / 12 - level) / 12
        s = [v / level if seasonal == "mul" else v - level for v in y[:12]]
        squares = logs = 0.0
        for t, v in enumerate(y):
            base = level + phi * trend
            mean = base * s[t % 12] if seasonal == "mul" else base + s[t % 12]
            if mean <= 0:
                squares = math.inf
                break
            e = v / mean - 1
            squares += e * e
            logs += math.log(mean)
            if seasonal == "mul":
                level, trend = base * (1 + alpha * e), phi * trend + beta * base * e
                s[t % 12] *= 1 + gamma * e
            else:
                level, trend = base + alpha * mean * e, phi * trend + beta * mean * e
                s[t % 12] += gamma * mean * e
        objective = len(y) * math.log(squares) + 2 * logs if squares < math.inf else math.inf
        if best is None or objective < best[0]:
            best = (objective, alpha, beta, gamma, phi, level, trend, list(s))
    return best


@pytest.mark.parametrize("seasonal", ["mul", "add"])
def test_fit_equals_plain_recursion(spark, monthly, seasonal):
    train = monthly.filter("series = 'THEFT'").filter(ts.between_months(None, "2013-04"))
    found = smoothing.ets_forecast(smoothing.with_setups(train, (None,), (seasonal,)), 14).orderBy(
        "month_idx").collect()
    y = [r.value for r in train.orderBy("month_idx").collect()]
    objective, alpha, beta, gamma, phi, level, trend, s = plain_fit(y, seasonal)
    assert found[0].objective == pytest.approx(objective)
    assert (found[0].alpha, found[0].beta, found[0].gamma, found[0].phi) == (alpha, beta, gamma, phi)
    for h, row in enumerate(found, start=1):
        base = level + trend * sum(phi ** i for i in range(1, h + 1))
        part = s[(len(y) + h - 1) % 12]
        expected = base * part if seasonal == "mul" else base + part
        assert row.month_idx == START + len(y) + h - 1
        assert row.predicted == pytest.approx(expected)
        assert row.lower < row.predicted < row.upper


def test_refining_never_makes_the_fit_worse(monthly):
    setups = smoothing.with_setups(
        monthly.filter("series = 'BATTERY'").filter(ts.between_months(None, "2015-12")))
    plain = {r.seasonal + r.train_start: r.objective for r in smoothing.ets_forecast(
        setups, 1, interval=None).collect()}
    finer = {r.seasonal + r.train_start: r.objective for r in smoothing.ets_forecast(
        setups, 1, interval=None, refine=4).collect()}
    assert len(plain) == 4 and all(finer[k] <= plain[k] + 1e-9 for k in plain)


def test_short_or_zero_series_have_no_forecast(spark):
    short = make(spark, "S", 10, months=20)
    zero = make(spark, "Z", 100, months=40, zero_at=30)
    assert smoothing.ets_forecast(smoothing.with_setups(short.unionByName(zero))).count() == 0


def test_start_equal_to_first_month_is_fitted_once(spark):
    df = make(spark, "A", 100, months=40)
    setups = smoothing.with_setups(df, (None, "2007-01"), ("mul",))
    assert setups.count() == 40


def test_draws_look_normal_and_repeat():
    draws = smoothing._draws(0, 1000, 12)
    assert abs(draws.mean()) < 0.03 and abs(draws.std() - 1) < 0.03
    assert np.array_equal(draws, smoothing._draws(0, 1000, 12))
    assert not np.array_equal(draws, smoothing._draws(1, 1000, 12))


def test_setup_has_the_lowest_error(spark):
    scores = spark.createDataFrame(
        [("ALL", "2012-01", "mul", 5.0, 3.0), ("ALL", "2007-01", "add", 4.0, 2.0),
         ("ALL", "2007-01", "mul", 9.0, 2.0)],
        "series string, train_start string, seasonal string, mae double, mape double")
    assert rows(fc.choose_setup(scores)) == [("ALL", "2007-01", "add", 4.0, 2.0)]


def test_forecast_job(spark, monthly, tmp_path):
    year, month = cal.year_of(F.col("month_idx")), cal.month_of(F.col("month_idx"))
    trend = monthly.filter("series = 'ALL'").select(
        year.alias("year"), month.alias("month"), F.col("value").cast("long").alias("total_crimes"))
    by_type = monthly.filter("series <> 'ALL' AND value > 0").select(
        year.alias("year"), month.alias("month"), F.col("series").alias("primary_type"),
        F.col("value").cast("long").alias("total"))
    out = str(tmp_path / "forecast")
    assert run_forecast(trend, by_type, out, refine=1) == 1
    metrics = {r.series: r for r in readers_published(spark, out, "forecast_metrics").collect()}
    skipped = {r.series for r in readers_published(spark, out, "skipped_series").collect()}
    early = {"EARLY"} - skipped
    assert set(metrics) == {"ALL", "THEFT", "BATTERY"} | early and "RARE" in skipped
    assert readers_published(spark, out, "backtest").count() == 12 * len(metrics)
    assert metrics["ALL"].covid_gap_pct == pytest.approx(-30, abs=3)
    assert metrics["THEFT"].covid_gap_pct == pytest.approx(-50, abs=3)
    assert abs(metrics["BATTERY"].covid_gap_pct) < 3
    assert metrics["ALL"].months_below_interval == 4
    assert metrics["ALL"].train_end == "2020-02"
    assert metrics["ALL"].mape < metrics["ALL"].baseline_mape
    table = readers_published(spark, out, "crime_forecast")
    assert table.count() == 12 * len(metrics)
    assert table.filter("actual IS NOT NULL").count() == 12
    chart = fc.chart_rows(table, monthly, "ALL").toPandas().sort_values("date")
    assert chart["date"].iloc[0] == "2016-01" and len(chart) == 50 + 12
    with pytest.raises(KeyError, match="there are ALL, BATTERY"):
        fc.chart_rows(table, monthly, "NONE")
    joint = chart[chart["date"] == "2020-02"].iloc[0]
    assert joint["actual"] == joint["predicted"]
    assert pd.isna(joint["lower"])
    assert [r.series for r in fc.series_list(
        readers_published(spark, out, "forecast_metrics")).collect()] == ["ALL", "BATTERY", *sorted(early), "THEFT"]


def readers_published(spark, root, name):
    return writers.read_published(spark, root, name)


def test_gap_in_the_total_series_stops_the_job(spark, monthly, tmp_path):
    year, month = cal.year_of(F.col("month_idx")), cal.month_of(F.col("month_idx"))
    trend = monthly.filter(f"series = 'ALL' AND month_idx <> {START + 5}").select(
        year.alias("year"), month.alias("month"), F.col("value").cast("long").alias("total_crimes"))
    by_type = spark.createDataFrame([], "year int, month int, primary_type string, total long")
    with pytest.raises(ValueError, match="missing months"):
        run_forecast(trend, by_type, str(tmp_path))


def test_failed_publish_keeps_the_former_version(spark, tmp_path):
    root = str(tmp_path / "r")
    good = spark.range(3)
    assert writers.latest_version(spark, root) is None
    with pytest.raises(FileNotFoundError):
        writers.read_published(spark, root, "a")
    assert writers.publish({"a": good, "b": good}, root) == 1
    broken = spark.range(1).select(F.raise_error(F.lit("stop")).alias("id"))
    with pytest.raises(Exception):
        writers.publish({"a": spark.range(9), "b": broken}, root)
    assert writers.latest_version(spark, root) == 1
    assert writers.read_published(spark, root, "a").count() == 3
    assert writers.publish({"a": spark.range(5), "b": good}, root) == 2
    assert writers.read_published(spark, root, "a").count() == 5


def test_holiday_reader(spark, tmp_path):
    dates = readers.holidays_from_dates(spark, {"2019-07-04": "Independence Day"})
    dates.write.parquet(str(tmp_path / "h"))
    assert readers.read_holidays(spark, str(tmp_path / "h")).count() == 1
    assert readers.mart_docs(spark).count() == 24


def test_two_publishers_at_once_get_a_version_each(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "r")
    assert writers.publish({"a": spark.range(1)}, root) == 1
    seen, other = writers.latest_version, []

    def interleaved(session, where):
        # The other run publishes between this one's look at the versions and its claim.
        found = seen(session, where)
        if not other:
            other.append(None)
            other[0] = writers.publish({"a": spark.range(2)}, root)
        return found

    monkeypatch.setattr(writers, "latest_version", interleaved)
    assert writers.publish({"a": spark.range(3)}, root) == 3 and other == [2]
    monkeypatch.undo()
    assert writers.read_published(spark, root, "a").count() == 3
    assert spark.read.parquet(f"{root}/published").count() == 3


def test_a_replaced_version_is_a_conflict(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "r")
    assert writers.publish({"a": spark.range(1)}, root, replaces=0) == 1
    with pytest.raises(writers.VersionConflict):
        writers.publish({"a": spark.range(2)}, root, replaces=0)
    monkeypatch.setattr(writers, "latest_version", lambda *_: 0)
    with pytest.raises(writers.VersionConflict):
        writers.publish({"a": spark.range(2)}, root, replaces=0)
    monkeypatch.undo()
    assert writers.read_published(spark, root, "a").count() == 1
    assert writers.publish({"a": spark.range(4)}, root, replaces=1) == 2


def test_one_of_many_claims_a_version(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(8) as pool:
        for version in range(5):
            assert sum(pool.map(lambda _: writers.claim(spark, str(tmp_path), version), range(8))) == 1


@pytest.mark.parametrize("seasonal", ["mul", "add"])
def test_search_leaves_the_grid_and_moves_the_start(seasonal):
    # A volatile series: the level follows every error and the first season is an unusual one.
    rng = np.random.default_rng(4)
    level, trend, alpha, beta, phi = 1000.0, 5.0, 0.92, 0.04, 0.9
    season = 1 + 0.2 * np.sin(np.arange(12) / 12 * 2 * np.pi)
    season = season if seasonal == "mul" else (season - 1) * 1000
    y = []
    for t in range(120):
        base = level + phi * trend
        mean = base * season[t % 12] if seasonal == "mul" else base + season[t % 12]
        error = rng.normal() * 0.08
        y.append(max(mean * (1 + error), 1.0))
        scale = base if seasonal == "mul" else mean
        level, trend = base + alpha * scale * error, phi * trend + beta * scale * error
    y = np.array(y)
    y[:12] *= 1 + 0.1 * rng.normal(size=12)
    grid = np.array(smoothing.parameter_grid())
    coarse = smoothing._best_point(y, grid, seasonal, 0)
    fine = smoothing._best_point(y, grid, seasonal, 8)
    assert fine[1] < coarse[1] - 5 and fine[0][0] > max(smoothing.ALPHAS)
    # No single small move from the result is better.
    point = smoothing._search(y, np.concatenate([grid[0], smoothing._simple_start(y, seasonal, 1)[:, 0]]), seasonal, 8)
    assert smoothing._filter(y, point[None, :4], point[4:, None], seasonal)[0][0] < coarse[1]


def test_coverage_and_report_are_published(spark, tmp_path, monthly):
    backtest = spark.createDataFrame([("A", 1, 5.0, 1.0, 3.0, 4.0, 6.0), ("A", 2, 9.0, 1.0, 3.0, 4.0, 6.0)],
                                     "series string, month_idx int, actual double, baseline double, model double, lower double, upper double")
    assert rows(fc.coverage(backtest)) == [("A", 1, 2)]
    analysis = spark.createDataFrame(
        [("ALL", 1.0, 1.0, -9.0, -9.0, 1), ("B", 1.0, 2.0, 3.0, 4.0, 0), ("A", 1.0, 2.0, -5.0, 4.0, 2), ("C", 1.0, 2.0, -5.0, 4.0, 2)],
        "series string, mape double, baseline_mape double, shock_gap_pct double, worst_month_gap_pct double, months_below_interval int")
    assert [(r.series, r.place) for r in fc.type_report(analysis).collect()] == [("A", 1), ("C", 2), ("B", 3)]
