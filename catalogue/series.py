"""Monthly series, forecasts and result tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from civitally.functions import calendars as cal
from civitally.functions import fixed_values as fv
from civitally.operators import quality, series as ts, smoothing
from civitally.plans import forecasting as fc
from civitally.session import cut_lineage

from . import sql_parts as sp
from .registry import query
from .tables import crimes, read

P = fc.Periods()


# ---- SQL forms -------------------------------------------------------------------------

def _idx(label: str) -> int:
    year, month = label.split("-")
    return int(year) * 12 + int(month) - 1


_SERIES = f"""WITH {sp.CRIMES}, {sp.WHOLE_MONTHS},
counted AS (SELECT primary_type, CAST(year(date) * 12 + month(date) - 1 AS INTEGER) AS month_idx, count(*) AS n
  FROM whole GROUP BY ALL),
series AS (SELECT primary_type AS series, month_idx, CAST(n AS DOUBLE) AS value FROM counted
    WHERE primary_type IS NOT NULL
  UNION ALL SELECT 'ALL', month_idx, CAST(sum(n) AS DOUBLE) FROM counted GROUP BY month_idx),
dense AS (SELECT s.series, CAST(m.month_idx AS INTEGER) AS month_idx, coalesce(v.value, 0) AS value
  FROM (SELECT DISTINCT series FROM series) s
  CROSS JOIN (SELECT unnest(range(min(month_idx), max(month_idx) + 1)) AS month_idx FROM series) m
  LEFT JOIN series v ON v.series = s.series AND v.month_idx = m.month_idx)"""

_TOP = ("top AS (SELECT series, sum(value) AS total FROM series WHERE series <> 'ALL'"
        f" AND month_idx // 12 = {fv.RANK_YEAR} GROUP BY 1 ORDER BY total DESC, series LIMIT {fv.TOP_TYPES})")
_NAIVE = ("naive AS (SELECT *, lag(value, 12) OVER (PARTITION BY series ORDER BY month_idx) AS predicted"
          " FROM analysed)")
_GRID = "grid(alpha, beta, gamma, phi) AS (VALUES " + ", ".join(
    "({}::DOUBLE, {}::DOUBLE, {}::DOUBLE, {}::DOUBLE)".format(*p)
    for p in smoothing.parameter_grid()) + ")"
_LABEL = "printf('%d-%02d', {0} // 12, {0} % 12 + 1)"


def _fit(tag: str, source: str, where: str, setups: str, horizon: int) -> str:
    """Grid fit of every series and set-up, and its point forecast."""
    first = "(SELECT min(month_idx) FROM dense)"
    starts = ", ".join(
        f"({first if s is None else _idx(s)}, '{k}')" for s in P.train_starts for k in P.seasonals)
    return f"""
{tag}_setups AS (SELECT DISTINCT CAST(v.a AS INTEGER) AS start, {_LABEL.format('v.a')} AS train_start, v.b AS seasonal
  FROM (VALUES {starts}) AS v(a, b)),
{tag}_train AS (SELECT a.series, u.train_start, u.seasonal, list(a.value ORDER BY month_idx) AS ys,
    CAST(count(*) AS INTEGER) AS n, max(month_idx) AS last_idx
  FROM {source} a JOIN {tag}_setups u ON a.month_idx >= u.start WHERE {where} {setups} GROUP BY ALL
  HAVING min(a.value) > 0 AND count(*) >= {smoothing.MIN_MONTHS}),
{tag}_start AS (SELECT *, list_transform(ys, lambda v: {_state('v')}) AS steps,
    CASE seasonal WHEN 'mul' THEN list_transform(ys[1:12], lambda v: v / list_avg(ys[1:12]))
      ELSE list_transform(ys[1:12], lambda v: v - list_avg(ys[1:12])) END AS season
  FROM {tag}_train),
{tag}_run AS (SELECT series, train_start, seasonal, alpha, beta, gamma, phi, n, last_idx,
    list_reduce(steps, lambda a, x: {_next('x.y / ' + _MEAN + ' - 1')},
      {_state('0', 'list_avg(ys[1:12])', '(list_avg(ys[13:24]) - list_avg(ys[1:12])) / 12', 'season')}) AS st
  FROM {tag}_start CROSS JOIN grid),
{tag}_best AS (SELECT *, st.l AS l, st.b AS b, st.s AS s, sqrt(st.sq / n) AS sigma,
    n * ln(st.sq) + 2 * st.lg AS objective, row_number() OVER (PARTITION BY series, train_start, seasonal
      ORDER BY n * ln(st.sq) + 2 * st.lg, alpha, beta, gamma, phi) AS rn
  FROM {tag}_run QUALIFY rn = 1),
{tag}_fc AS (SELECT series, train_start, seasonal, CAST(last_idx + h AS INTEGER) AS month_idx, h, alpha, beta, gamma,
    phi, objective, sigma,
    CASE seasonal WHEN 'mul' THEN (l + b * list_sum(list_transform(range(1, h + 1), lambda i: phi ** i))) * s[(h - 1) % 12 + 1]
      ELSE l + b * list_sum(list_transform(range(1, h + 1), lambda i: phi ** i)) + s[(h - 1) % 12 + 1] END AS predicted
  FROM {tag}_best CROSS JOIN (SELECT unnest(range(1, {horizon + 1})) AS h))"""


# State of the smoothing recursion as a struct, folded over the months with list_reduce.
_BASE = "(a.l + phi * a.b)"
_MEAN = f"(CASE seasonal WHEN 'mul' THEN {_BASE} * a.s[1] ELSE {_BASE} + a.s[1] END)"


def _state(y: str, level: str = "0", trend: str = "0", season: str = "[]", sq: str = "0", lg: str = "0",
           path: str = "[]") -> str:
    return (f"{{'y': ({y})::DOUBLE, 'l': ({level})::DOUBLE, 'b': ({trend})::DOUBLE, 's': ({season})::DOUBLE[],"
            f" 'sq': ({sq})::DOUBLE, 'lg': ({lg})::DOUBLE, 'path': ({path})::DOUBLE[]}}")


def _next(error: str, path: str = "[]") -> str:
    """State after a relative error."""
    level = f"CASE seasonal WHEN 'mul' THEN {_BASE} ELSE {_MEAN} END"
    season = f"CASE seasonal WHEN 'mul' THEN a.s[1] ELSE {_MEAN} END"
    e = f"({error})"
    return _state(
        "0", f"{_BASE} + alpha * ({level}) * {e}", f"phi * a.b + beta * ({level}) * {e}",
        f"a.s[2:12] || [a.s[1] + gamma * ({season}) * {e}]", f"a.sq + {e} * {e}",
        f"a.lg + CASE WHEN {_MEAN} > 0 THEN ln({_MEAN}) END", path)


def _paths(tag: str, horizon: int) -> str:
    """Simulated paths of the best points and their 10 % and 90 % quantiles."""
    return f"""
{tag}_u AS (SELECT p, h, md5('0|' || p || '|' || h) AS d FROM (SELECT unnest(range(0, {smoothing.PATHS})) AS p)
  CROSS JOIN (SELECT unnest(range(1, {horizon + 1})) AS h)),
{tag}_z AS (SELECT p, h, sqrt(-2 * ln((CAST(('0x' || substr(d, 1, 13))::UBIGINT AS DOUBLE) + 1) / (4503599627370496::DOUBLE + 1)))
  * cos(2 * pi() * CAST(('0x' || substr(d, 14, 13))::UBIGINT AS DOUBLE) / 4503599627370496::DOUBLE) AS z FROM {tag}_u),
{tag}_zs AS (SELECT p, list({_state('z')} ORDER BY h) AS steps FROM {tag}_z GROUP BY p),
{tag}_sim AS (SELECT series, train_start, seasonal, last_idx,
    list_reduce(steps, lambda a, x: {_next('sigma * x.y', f"a.path || [{_MEAN} * (1 + sigma * x.y)]")},
      {_state('0', 'l', 'b', 's')}).path AS path
  FROM {tag}_best CROSS JOIN {tag}_zs),
{tag}_steps AS (SELECT series, train_start, seasonal, last_idx + generate_subscripts(path, 1) AS month_idx, unnest(path) AS y
  FROM {tag}_sim),
{tag}_bounds AS (SELECT series, train_start, seasonal, CAST(month_idx AS INTEGER) AS month_idx,
    quantile_cont(y, 0.1) AS lower, quantile_cont(y, 0.9) AS upper FROM {tag}_steps GROUP BY ALL)"""


_BT_WHERE = f"a.month_idx <= {_idx(fv.BACKTEST_TRAIN_END)}"
_SCORE = "avg(abs(v.value - f.predicted)) AS mae, avg(abs(v.value - f.predicted) / nullif(v.value, 0)) * 100 AS mape"
# The set-up is chosen on the total; a series is left out for a zero from the chosen start on.
_ANALYSED = f"""{_SERIES}, {_TOP}, {_GRID},
{_fit('c', 'dense', _BT_WHERE, "AND a.series = 'ALL'", P.backtest_months)},
tried AS (SELECT f.train_start, f.seasonal, {_SCORE} FROM c_fc f
  JOIN dense v ON v.series = f.series AND v.month_idx = f.month_idx GROUP BY ALL),
setup AS (SELECT train_start, seasonal FROM tried ORDER BY mape, train_start, seasonal LIMIT 1),
chosen AS (SELECT CAST(substr(train_start, 1, 4) AS INTEGER) * 12 + CAST(substr(train_start, 6, 2) AS INTEGER) - 1
  AS start_idx FROM setup),
skipped AS (SELECT series, CASE WHEN min(value) <= 0 THEN 'zero' ELSE 'short' END AS reason FROM dense
  WHERE (series = 'ALL' OR series IN (SELECT series FROM top)) AND month_idx <= {_idx(fv.TRAIN_END)}
  AND month_idx >= (SELECT start_idx FROM chosen) GROUP BY 1 HAVING min(value) <= 0 OR count(*) < {smoothing.MIN_MONTHS}),
analysed AS (SELECT * FROM dense WHERE (series = 'ALL' OR series IN (SELECT series FROM top))
  AND series NOT IN (SELECT series FROM skipped))"""
_BACKTEST = f"""{_ANALYSED}, {_fit('bt', 'analysed', _BT_WHERE, '', P.backtest_months)},
scores AS (SELECT f.series, f.train_start, f.seasonal, {_SCORE} FROM bt_fc f
  JOIN analysed v ON v.series = f.series AND v.month_idx = f.month_idx GROUP BY ALL)"""
_CHOSEN = f"{_ANALYSED}, {_NAIVE}"
_WANTED = "AND (u.train_start, u.seasonal) IN (SELECT (train_start, seasonal) FROM setup)"
_FORECAST = (_CHOSEN + "," + _fit("f", "analysed", f"a.month_idx <= {_idx(fv.TRAIN_END)}", _WANTED, P.horizon)
             + "," + _paths("f", P.horizon) + """,
forecast AS (SELECT f.*, b.lower, b.upper FROM f_fc f JOIN f_bounds b USING (series, train_start, seasonal, month_idx))""")
_SHOCK = f"month_idx BETWEEN {_idx(fv.SHOCK_START)} AND {_idx(fv.SHOCK_END)}"
_GAPS = f"""{_FORECAST}, gaps AS (SELECT f.series, f.month_idx, v.value AS actual, f.predicted, f.lower, f.upper,
  v.value - f.predicted AS gap, (v.value - f.predicted) / f.predicted * 100 AS gap_pct, v.value < f.lower AS below_interval
  FROM forecast f JOIN analysed v ON v.series = f.series AND v.month_idx = f.month_idx WHERE f.{_SHOCK}),
shocks AS (SELECT series, (sum(actual) / sum(predicted) - 1) * 100 AS shock_gap_pct, min(gap_pct) AS worst_month_gap_pct,
  arg_min(month_idx, actual / predicted) AS worst_month_idx, CAST(count(*) FILTER (below_interval) AS INTEGER)
  AS months_below_interval FROM gaps GROUP BY 1)"""
_BT_MONTHS = f"month_idx BETWEEN {_idx(fv.BACKTEST_START)} AND {_idx(fv.BACKTEST_END)}"
_ANALYSIS = f"""{_GAPS}, {_fit('m', 'analysed', _BT_WHERE, _WANTED, P.backtest_months)},
model AS (SELECT f.series, {_SCORE} FROM m_fc f JOIN analysed v ON v.series = f.series AND v.month_idx = f.month_idx GROUP BY 1),
base AS (SELECT series, avg(abs(value - predicted) / nullif(value, 0)) * 100 AS baseline_mape FROM naive
  WHERE {_BT_MONTHS} GROUP BY 1),
analysis AS (SELECT series, mae, mape, baseline_mape, shock_gap_pct, worst_month_gap_pct, worst_month_idx,
  months_below_interval FROM model JOIN base USING (series) JOIN shocks USING (series))"""


def _rounded(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


# ---- Spark forms -----------------------------------------------------------------------

def _round(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


def _monthly(spark, sf_dir):
    return cut_lineage(ts.monthly_series(crimes(spark, sf_dir)))


def _prepared(spark, sf_dir):
    """The analysed series and the set-up chosen on the total."""
    candidates, setup = _chosen(spark, sf_dir)
    return cut_lineage(fc.analysed_series(candidates, setup, P)), setup


def _chosen(spark, sf_dir):
    candidates = cut_lineage(fc.candidate_series(ts.monthly_series(crimes(spark, sf_dir)), P))
    total = candidates.filter(F.col("series") == ts.TOTAL)
    return candidates, cut_lineage(fc.choose_setup(fc.backtest_scores(total, P)))


def _analysed(spark, sf_dir):
    return _prepared(spark, sf_dir)[0]


def _forecast(series, setup):
    return cut_lineage(fc.forecasts_with_setup(series, setup, P.train_end, P.horizon, P))


@query(f"{_SERIES} SELECT * FROM series")
def monthly_series(spark, sf_dir):
    return ts.monthly_series(crimes(spark, sf_dir))


@query(f"{_SERIES} SELECT * FROM dense")
def dense_series(spark, sf_dir):
    return ts.densify(_monthly(spark, sf_dir))


@query(f"{_SERIES}, {_TOP} SELECT * FROM top")
def top_series(spark, sf_dir):
    return ts.top_series(_monthly(spark, sf_dir))


@query(f"{_SERIES} SELECT series, min(value) AS min_value FROM dense"
       f" WHERE month_idx <= {_idx(fv.TRAIN_END)} GROUP BY 1 HAVING min(value) > 0")
def eligible_series(spark, sf_dir):
    dense = ts.densify(_monthly(spark, sf_dir))
    return quality.eligible_series(dense, where=ts.between_months(None, fv.TRAIN_END))


@query(f"{_SERIES}, periods(period, a, b) AS (VALUES ('backtest_train', 0, {_idx(fv.BACKTEST_TRAIN_END)}),"
       f" ('backtest_test', {_idx(fv.BACKTEST_START)}, {_idx(fv.BACKTEST_END)}),"
       f" ('train', 0, {_idx(fv.TRAIN_END)}), ('shock', {_idx(fv.SHOCK_START)}, {_idx(fv.SHOCK_END)}))"
       " SELECT series, month_idx, value, period FROM series JOIN periods ON month_idx BETWEEN a AND b")
def period_split(spark, sf_dir):
    return ts.split_periods(ts.monthly_series(crimes(spark, sf_dir)))


@query(f"{_SERIES} SELECT series, CAST({_idx(fv.SHOCK_START)} + h AS INTEGER) AS month_idx"
       f" FROM (SELECT DISTINCT series FROM series) CROSS JOIN (SELECT unnest(range(0, {fv.HORIZON})) AS h)")
def forecast_months(spark, sf_dir):
    return ts.forecast_months(ts.monthly_series(crimes(spark, sf_dir)))


@query(f"{_ANALYSED}, {_NAIVE} SELECT * FROM naive WHERE {_BT_MONTHS}")
def seasonal_naive(spark, sf_dir):
    months = ts.between_months(fv.BACKTEST_START, fv.BACKTEST_END)
    return ts.seasonal_naive(_analysed(spark, sf_dir)).filter(months)


@query(f"{_ANALYSED}, {_NAIVE} SELECT series, round(avg(abs(value - predicted)), 6) AS mae,"
       f" round(avg(abs(value - predicted) / nullif(value, 0)) * 100, 6) AS mape FROM naive"
       f" WHERE {_BT_MONTHS} GROUP BY 1")
def error_metrics(spark, sf_dir):
    naive = seasonal_naive(spark, sf_dir).withColumnRenamed("value", "actual")
    return _round(ts.error_metrics(naive), "mae", "mape")


_PARAMS = "alpha, beta, gamma, phi, round(objective, 6) AS objective, round(sigma, 9) AS sigma"


@query(f"{_BACKTEST} SELECT series, train_start, seasonal, month_idx, round(predicted, 6) AS predicted, {_PARAMS}"
       " FROM bt_fc")
def ets_forecast(spark, sf_dir):
    """Held-out year of every analysed series under all four set-ups."""
    found = fc.backtest_forecasts(_analysed(spark, sf_dir), P).drop("lower", "upper")
    return _round(found, "predicted", "objective").withColumn("sigma", F.round("sigma", 9))


@query(f"{_BACKTEST} SELECT DISTINCT series, train_start, seasonal, round(objective, 6) AS grid_objective,"
       " true AS at_most_grid, true AS inside_region FROM bt_fc")
def ets_search(spark, sf_dir):
    """The search that also moves the initial states, as the job runs it, against the grid's best point."""
    series = _analysed(spark, sf_dir)
    keys = ["series", "train_start", "seasonal"]
    grid = fc.backtest_forecasts(series, P).select(*keys, F.col("objective").alias("grid")).distinct()
    found = fc.backtest_forecasts(series, P, refine=8).select(*keys, "objective", "alpha", "beta", "gamma", "phi").distinct()
    inside = F.expr("beta > 0 AND beta < alpha AND alpha < 1 AND gamma > 0 AND gamma <= 1 - alpha AND phi BETWEEN 0.8 AND 0.98")
    return grid.join(found, keys).select(*keys, F.round("grid", 6).alias("grid_objective"), (
        F.col("objective") <= F.col("grid") + 1e-9).alias("at_most_grid"), inside.alias("inside_region"))


@query(f"{_ANALYSIS} SELECT series, {_rounded('mape', 'baseline_mape', 'shock_gap_pct', 'worst_month_gap_pct')},"
       " months_below_interval, CAST(row_number() OVER (ORDER BY shock_gap_pct, series) AS INTEGER) AS place"
       " FROM analysis WHERE series <> 'ALL'")
def type_report(spark, sf_dir):
    """Every series but the total, the largest loss first."""
    found, _ = _analysis(spark, sf_dir)
    return _round(fc.type_report(found), "mape", "baseline_mape", "shock_gap_pct", "worst_month_gap_pct")


@query(f"{_BACKTEST}, ranked AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY mape, train_start,"
       f" seasonal) AS rn FROM scores) SELECT series, train_start, seasonal, {_rounded('mae', 'mape')}"
       " FROM ranked WHERE rn = 1")
def model_choice(spark, sf_dir):
    return _round(fc.choose_setup(fc.backtest_scores(_analysed(spark, sf_dir), P)), "mae", "mape")


@query(f"{_FORECAST} SELECT series, train_start, seasonal, month_idx, {_rounded('predicted', 'lower', 'upper')}"
       " FROM forecast")
def ets_interval(spark, sf_dir):
    series, setup = _prepared(spark, sf_dir)
    found = fc.forecasts_with_setup(series, setup, P.train_end, P.horizon, P)
    return _round(found, "predicted", "lower", "upper").select(
        "series", "train_start", "seasonal", "month_idx", "predicted", "lower", "upper")


_BT_TABLE = (_CHOSEN + "," + _fit("m", "analysed", _BT_WHERE, _WANTED, P.backtest_months) + ","
             + _paths("m", P.backtest_months) + f""",
compared AS (SELECT n.series, n.month_idx, n.value AS actual, n.predicted AS baseline, f.predicted AS model, b.lower, b.upper
  FROM naive n JOIN m_fc f ON f.series = n.series AND f.month_idx = n.month_idx
  JOIN m_bounds b ON b.series = n.series AND b.month_idx = n.month_idx WHERE n.{_BT_MONTHS})""")


@query(f"{_BT_TABLE} SELECT series, month_idx, round(actual, 0) AS actual, round(baseline, 0) AS baseline,"
       " round(model, 0) AS model, round(lower, 0) AS lower, round(upper, 0) AS upper FROM compared")
def backtest_table(spark, sf_dir):
    series, setup = _prepared(spark, sf_dir)
    return fc.backtest_table(series, setup, P)


@query(f"{_BT_TABLE} SELECT series, count(*) FILTER (actual BETWEEN lower AND upper) AS months_inside,"
       " count(*) AS months FROM compared GROUP BY 1")
def interval_coverage(spark, sf_dir):
    series, setup = _prepared(spark, sf_dir)
    model = fc.forecasts_with_setup(
        series, setup, P.backtest_train_end, P.backtest_months, P)
    return ts.interval_coverage(model, series)


@query(f"{_GAPS} SELECT series, month_idx, actual, {_rounded('predicted', 'lower', 'upper', 'gap', 'gap_pct')},"
       " below_interval FROM gaps")
def shock_gap(spark, sf_dir):
    series, setup = _prepared(spark, sf_dir)
    forecast = _forecast(series, setup)
    gaps = ts.shock_gap(forecast, fc.shock_months(series, P))
    return _round(gaps, "predicted", "lower", "upper", "gap", "gap_pct").select(
        "series", "month_idx", "actual", "predicted", "lower", "upper", "gap", "gap_pct",
        "below_interval")


@query(f"{_GAPS} SELECT series, {_rounded('shock_gap_pct', 'worst_month_gap_pct')}, worst_month_idx,"
       " months_below_interval FROM shocks")
def shock_summary(spark, sf_dir):
    series, setup = _prepared(spark, sf_dir)
    forecast = _forecast(series, setup)
    summary = ts.shock_summary(ts.shock_gap(forecast, fc.shock_months(series, P)))
    return _round(summary, "shock_gap_pct", "worst_month_gap_pct")


_ANALYSIS_MEASURES = ("mae", "mape", "baseline_mape", "shock_gap_pct", "worst_month_gap_pct")


def _analysis(spark, sf_dir):
    series, setup = _prepared(spark, sf_dir)
    return fc.series_analysis(series, setup, _forecast(series, setup), P), setup


@query(f"{_ANALYSIS} SELECT series, {_rounded(*_ANALYSIS_MEASURES)}, worst_month_idx, months_below_interval"
       " FROM analysis ORDER BY shock_gap_pct")
def series_analysis(spark, sf_dir):
    found, _ = _analysis(spark, sf_dir)
    return _round(found, *_ANALYSIS_MEASURES).orderBy("shock_gap_pct", "series")


@query(f"{_ANALYSIS} SELECT series, 'Holt-Winters ETS, damped additive trend, ' || (SELECT CASE seasonal WHEN 'add'"
       " THEN 'additive' ELSE 'multiplicative' END FROM setup) || ' seasonality' AS model,"
       f" (SELECT train_start FROM setup) AS train_start, '{fv.TRAIN_END}' AS train_end,"
       f" {_rounded('mae', 'mape', 'baseline_mape')}, round(shock_gap_pct, 6) AS covid_gap_pct,"
       " round(worst_month_gap_pct, 6) AS worst_month_gap_pct, months_below_interval FROM analysis")
def forecast_metrics(spark, sf_dir):
    found, setup = _analysis(spark, sf_dir)
    return _round(fc.forecast_metrics(found, setup, P),
                  "mae", "mape", "baseline_mape", "covid_gap_pct", "worst_month_gap_pct")


_ROWS = f"""{_FORECAST}, result AS (SELECT f.series, CAST(f.month_idx // 12 AS INTEGER) AS year,
  CAST(f.month_idx % 12 + 1 AS INTEGER) AS month, f.predicted, f.lower AS lower_bound, f.upper AS upper_bound,
  v.value AS actual FROM forecast f LEFT JOIN analysed v ON v.series = f.series AND v.month_idx = f.month_idx AND v.{_SHOCK})"""


def _forecast_rows(spark, sf_dir):
    series, setup = _prepared(spark, sf_dir)
    return fc.forecast_rows(_forecast(series, setup), series, P), series


@query(f"{_ROWS} SELECT series, year, month, {_rounded('predicted', 'lower_bound', 'upper_bound')}, actual FROM result")
def forecast_rows(spark, sf_dir):
    rows, _ = _forecast_rows(spark, sf_dir)
    return _round(rows, "predicted", "lower_bound", "upper_bound")


def _chart_sql(name):
    return f"""{_ROWS}, past AS (SELECT month_idx, value FROM analysed WHERE series = '{name}'
    AND month_idx // 12 >= {fv.HISTORY_START_YEAR} AND month_idx < {_idx(fv.SHOCK_START)})
SELECT {_LABEL.format('month_idx')} AS date, value AS actual,
  CASE WHEN month_idx = (SELECT max(month_idx) FROM past) THEN value END AS predicted,
  NULL::DOUBLE AS lower, NULL::DOUBLE AS upper FROM past
UNION ALL SELECT printf('%d-%02d', year, month), actual, round(predicted, 6), round(lower_bound, 6),
  round(upper_bound, 6) FROM result WHERE series = '{name}'"""


def _chart(spark, sf_dir, name):
    rows, series = _forecast_rows(spark, sf_dir)
    return _round(fc.chart_rows(cut_lineage(rows), series, name), "predicted", "lower", "upper")


@query(_chart_sql(ts.TOTAL))
def forecast_chart_rows(spark, sf_dir):
    return _chart(spark, sf_dir, ts.TOTAL)


@query(_chart_sql("THEFT"))
def forecast_chart_rows_type(spark, sf_dir):
    return _chart(spark, sf_dir, "THEFT")


@query(f"{_ANALYSED} SELECT series, reason FROM skipped")
def skipped_series(spark, sf_dir):
    """Candidates that cannot be fitted from the chosen start, with the reason."""
    return fc.skipped_series(*_chosen(spark, sf_dir), P)


@query(f"{_ANALYSED} SELECT DISTINCT series FROM analysed")
def series_list(spark, sf_dir):
    return fc.series_list(_analysed(spark, sf_dir))


# The test tables' own monthly series: orders per priority.
_ORDERS = """orders_by_month AS (SELECT o_orderpriority AS series,
  CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INTEGER) AS month_idx, count(*) AS n FROM orders
  WHERE day((SELECT max(o_orderdate) FROM orders)) >= 28
    OR date_trunc('month', o_orderdate) < date_trunc('month', (SELECT max(o_orderdate) FROM orders)) GROUP BY ALL)"""


@query(f"WITH {_ORDERS} SELECT series, month_idx, CAST(n AS DOUBLE) AS value FROM orders_by_month"
       " UNION ALL SELECT 'ALL', month_idx, CAST(sum(n) AS DOUBLE) FROM orders_by_month GROUP BY month_idx")
def order_series(spark, sf_dir):
    return ts.monthly_series(read(spark, sf_dir, "orders"), "o_orderdate", "o_orderpriority")
