"""Counts by time and type."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from civitally.functions import calendars as cal
from civitally.functions import fixed_values as fv
from civitally.functions import rates, text
from civitally.operators import answers, counting as ct, distinct, series as ts
from civitally.operators.cubes import build_cubes
from civitally.plans.marts import derive_marts, holiday_split as split_by_holiday, marts
from civitally.session import shared_dir

from . import sql_parts as sp
from .registry import query
from .tables import RAW_CRIMES, crimes, holidays, raw_crimes, read, stack

M = sp.MARTS


@query("SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS crime_count FROM events GROUP BY 1")
def hourly_counts(spark, sf_dir):
    return ct.count_by(read(spark, sf_dir, "events"), {"hour": F.hour("ts")}, "crime_count")


@query(M["time_period_crimes"])
def time_period_counts(spark, sf_dir):
    key = {"time_period": cal.time_period(F.hour("date"))}
    return ct.count_by(crimes(spark, sf_dir), key, "total_crimes")


@query(M["monthly_crimes"])
def monthly_counts(spark, sf_dir):
    return ct.count_by(crimes(spark, sf_dir), {"month": F.month("date")}, "total_crimes")


@query(M["season_crimes"])
def season_counts(spark, sf_dir):
    return ct.count_by(crimes(spark, sf_dir), {"season": cal.season(F.month("date"))}, "total_crimes")


@query(M["yearly_crimes"])
def yearly_counts(spark, sf_dir):
    return ct.count_by(crimes(spark, sf_dir), {"year": F.year("date")}, "total_crimes")


@query(M["christmas_by_type"])
def month_types(spark, sf_dir):
    return ct.count_by(crimes(spark, sf_dir), ["primary_type"], where=cal.in_month("date", 12))


@query(M["halloween_by_type"])
def day_types(spark, sf_dir):
    return ct.count_by(crimes(spark, sf_dir), ["primary_type"], where=cal.on_day("date", 10, 31))


@query(M["thanksgiving_by_type"])
def date_list_types(spark, sf_dir):
    on_dates = cal.in_dates("date", fv.THANKSGIVING_DATES)
    return ct.count_by(crimes(spark, sf_dir), ["primary_type"], where=on_dates)


@query(M["great_recession_by_type"])
def period_types(spark, sf_dir):
    return ct.count_by(crimes(spark, sf_dir), ["primary_type"],
                       where=cal.in_years("date", fv.RECESSION_YEARS))


def _flagged(spark, sf_dir, test, event, types):
    keys = {"day_type": cal.day_flag(test, event), "primary_type": F.col("primary_type")}
    return ct.count_by(crimes(spark, sf_dir), keys, where=F.col("primary_type").isin(list(types)))


@query(M["christmas_vs_nonchristmas_by_type"])
def flag_month(spark, sf_dir):
    return _flagged(spark, sf_dir, cal.in_month("date", 12), "Christmas", fv.CHRISTMAS_TYPES)


@query(M["halloween_vs_nonhalloween_by_type"])
def flag_day(spark, sf_dir):
    return _flagged(spark, sf_dir, cal.on_day("date", 10, 31), "Halloween", fv.HALLOWEEN_TYPES)


@query(M["thanksgiving_vs_nonthanksgiving_by_type"])
def flag_dates(spark, sf_dir):
    return _flagged(spark, sf_dir, cal.in_dates("date", fv.THANKSGIVING_DATES), "Thanksgiving",
                    fv.THANKSGIVING_TYPES)


@query(f"{sp.WITH} SELECT {sp.flag(sp.ON_DATES, 'Thanksgiving')} AS day_type, count(*) AS total"
       " FROM crimes GROUP BY 1")
def date_list_split(spark, sf_dir):
    flag = cal.day_flag(cal.in_dates("date", fv.THANKSGIVING_DATES), "Thanksgiving")
    return ct.count_by(crimes(spark, sf_dir), {"day_type": flag})


@query(M["holiday_vs_nonholiday"])
def holiday_split(spark, sf_dir):
    dated = crimes(spark, sf_dir).select(F.to_date("date").alias("date_only"))
    return split_by_holiday(dated, holidays(spark))


@query(f"{sp.WITH} SELECT strftime(min(date), '%Y-%m-%d %H:%M:%S') AS min_date,"
       " strftime(max(date), '%Y-%m-%d %H:%M:%S') AS max_date FROM crimes")
def date_range(spark, sf_dir):
    fmt = "yyyy-MM-dd HH:mm:ss"
    return crimes(spark, sf_dir).agg(
        F.date_format(F.min("date"), fmt).alias("min_date"),
        F.date_format(F.max("date"), fmt).alias("max_date"),
    )


@query(f"{sp.WITH} SELECT count(*) FILTER (hour(date) >= 8 AND hour(date) < 16) AS daytime,"
       " count(*) FILTER (hour(date) >= 16 AND hour(date) < 24) AS evening,"
       " count(*) FILTER (hour(date) >= 0 AND hour(date) < 8) AS overnight FROM crimes")
def period_counts_wide(spark, sf_dir):
    period = cal.time_period(F.hour("date"), null_bucket=False)
    return ct.wide_counts(crimes(spark, sf_dir), {
        "daytime": period == "Daytime",
        "evening": period == "Evening",
        "overnight": period == "Overnight",
    })


@query(f"{sp.WITH} SELECT strftime(date, '%m-%d') AS month_day,"
       f" strftime(date, '%m-%d') IN {sp.listed(fv.FEDERAL_HOLIDAYS)} AS is_holiday,"
       " count(*) AS total FROM crimes GROUP BY ALL")
def month_day_split(spark, sf_dir):
    keys = {"month_day": cal.month_day("date"),
            "is_holiday": cal.in_month_days("date", fv.FEDERAL_HOLIDAYS)}
    return ct.count_by(crimes(spark, sf_dir), keys)


@query(f"{sp.WITH} SELECT strftime(date, '%m-%d') AS month_day, count(*) AS total FROM crimes"
       f" WHERE strftime(date, '%m-%d') NOT IN {sp.listed(fv.FEDERAL_HOLIDAYS)} GROUP BY 1")
def non_holiday_days(spark, sf_dir):
    return ct.count_by(crimes(spark, sf_dir), {"month_day": cal.month_day("date")},
                       where=~cal.in_month_days("date", fv.FEDERAL_HOLIDAYS))


_TOP_ON_DATES = """{w}, flagged AS (
  SELECT 'Christmas' AS event, primary_type FROM crimes WHERE month(date) = 12 AND day(date) BETWEEN 24 AND 26
  UNION ALL SELECT 'Halloween', primary_type FROM crimes WHERE month(date) = 10 AND day(date) = 31
  UNION ALL SELECT 'Thanksgiving', primary_type FROM crimes WHERE month(date) = 11 AND day(date) BETWEEN 22 AND 28
), counts AS (SELECT event, primary_type, count(*) AS total FROM flagged GROUP BY ALL)
SELECT event, primary_type, total, event_total FROM (
  SELECT *, row_number() OVER (PARTITION BY event ORDER BY total DESC, primary_type) AS rn,
         CAST(sum(total) OVER (PARTITION BY event) AS BIGINT) AS event_total FROM counts) WHERE rn = 1"""


@query(_TOP_ON_DATES.format(w=sp.WITH))
def top_type_on_dates(spark, sf_dir):
    event = (F.when(cal.in_days("date", 12, 24, 26), "Christmas")
             .when(cal.on_day("date", 10, 31), "Halloween")
             .when(cal.in_days("date", 11, 22, 28), "Thanksgiving"))
    rows = crimes(spark, sf_dir).select(event.alias("event"), "primary_type")
    counts = ct.count_by(rows, ["event", "primary_type"], where=F.col("event").isNotNull())
    return ct.top_item_per_group(counts, "event", "primary_type", total_name="event_total")


@query(f"{sp.WITH} SELECT primary_type, count(*) AS total FROM crimes GROUP BY 1")
def bench_types(spark, sf_dir):
    return ct.count_by(crimes(spark, sf_dir), ["primary_type"])


@query(f"{sp.WITH} SELECT location_description, primary_type, count(*) AS total FROM crimes"
       " WHERE location_description IS NOT NULL GROUP BY ALL")
def bench_label_types(spark, sf_dir):
    return ct.count_by(crimes(spark, sf_dir), ["location_description", "primary_type"],
                       where=F.col("location_description").isNotNull())


@query(f"{sp.WITH} SELECT count(*) AS n_rows, count(DISTINCT primary_type) AS n_types FROM crimes")
def row_and_distinct(spark, sf_dir):
    return crimes(spark, sf_dir).agg(
        F.count("*").alias("n_rows"), F.count_distinct("primary_type").alias("n_types"))


@query(f"WITH {RAW_CRIMES} SELECT CASE lower(trim(\"Arrest\")) WHEN 'true' THEN true WHEN 'false' THEN false END"
       " AS arrest, count(*) AS total FROM raw_crimes GROUP BY 1")
def bool_counts(spark, sf_dir):
    """Rows by the parsed arrest flag; unreadable ones are NULL."""
    return ct.count_by(raw_crimes(spark, sf_dir), {"arrest": text.parse_bool("Arrest")})


def _describe_sql(column):
    number = f"TRY_CAST({column} AS DOUBLE)"
    return (f"SELECT '{column}' AS column_name, count({number}) AS n, round(avg({number}), 6) AS mean,"
            f" round(stddev_samp({number}), 6) AS stddev, min({number}) AS min_value,"
            f" max({number}) AS max_value FROM crimes")


@query(f"{sp.WITH} {_describe_sql('x')} UNION ALL {_describe_sql('y')}")
def describe_cols(spark, sf_dir):
    stats = ct.describe_columns(crimes(spark, sf_dir), ["x", "y"])
    return stats.withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


@query(f"{sp.WITH} SELECT id, date, CAST(hour(date) AS INTEGER) AS hour, CAST(month(date) AS INTEGER) AS month,"
       " CAST(day(date) AS INTEGER) AS day, CAST(date AS DATE) AS date_only,"
       " CAST(year(date) AS INTEGER) AS year FROM crimes")
def calendar_parts(spark, sf_dir):
    return cal.add_calendar_parts(crimes(spark, sf_dir).select("id", "date"))


@query(f"{sp.WITH} SELECT monthname(date) AS month_name,"
       " strftime(date, '%-I %p') AS hour_label, strftime(date, '%Y-%m') AS month_label,"
       " count(*) AS total FROM crimes GROUP BY ALL")
def calendar_labels(spark, sf_dir):
    return ct.count_by(crimes(spark, sf_dir), {
        "month_name": cal.month_name(F.month("date")),
        "hour_label": cal.hour_label(F.hour("date")),
        "month_label": cal.month_label(F.year("date"), F.month("date")),
    })


@query("SELECT event_id, event_type FROM events WHERE"
       " ('0x' || substr(md5('42|' || CAST(event_id AS VARCHAR)), 1, 8))::UBIGINT"
       " < CAST(floor(0.25 * 4294967296) AS UBIGINT)")
def hash_sample(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select("event_id", "event_type")
    return ct.hash_sample(rows, "event_id", 0.25)


_PERIOD_TOTALS = sp.PERIOD.format(ts="ts")


@query(f"SELECT time_period, total_crimes, total_crimes / 8.0::DOUBLE AS avg_crimes FROM (SELECT {_PERIOD_TOTALS}"
       " AS time_period, count(*) AS total_crimes FROM events GROUP BY 1)")
def per_hour_rate(spark, sf_dir):
    counts = ct.count_by(read(spark, sf_dir, "events"),
                         {"time_period": cal.time_period(F.hour("ts"))}, "total_crimes")
    return counts.withColumn(
        "avg_crimes", rates.per_unit("total_crimes", "time_period", fv.HOURS_PER_PERIOD))


@query(f"SELECT season, total_crimes, round(total_crimes / CAST(CASE season WHEN 'Summer' THEN 3 WHEN"
       f" 'Late Winter' THEN 2 ELSE 7 END AS DOUBLE), 6) AS per_month FROM ({M['season_crimes']})")
def per_month_rate(spark, sf_dir):
    per_month = rates.per_unit("total_crimes", "season", fv.MONTHS_PER_SEASON)
    return season_counts(spark, sf_dir).withColumn("per_month", F.round(per_month, 6))


_DAYS = "(SELECT count(*) FROM ({years}))".format(years=M["yearly_crimes"])


def _per_day_sql(mart, event, days, keys="day_type, primary_type", total="total"):
    return (f"SELECT {keys}, {total} AS total, round({total} / CASE WHEN day_type = '{event}' THEN"
            f" CAST({days} AS DOUBLE) ELSE {_DAYS} * 365.25::DOUBLE - {days} END, 1) AS daily_avg"
            f" FROM ({M[mart]})")


def _years(spark, sf_dir):
    return yearly_counts(spark, sf_dir).agg(F.count("*")).scalar()


@query(_per_day_sql("christmas_vs_nonchristmas_by_type", "Christmas", f"({_DAYS} * 31)"))
def per_day_rate(spark, sf_dir):
    years = _years(spark, sf_dir)
    return answers.per_day_rates(flag_month(spark, sf_dir), "Christmas", years * 31, years)


@query(_per_day_sql("halloween_vs_nonhalloween_by_type", "Halloween", _DAYS))
def per_day_rate_halloween(spark, sf_dir):
    years = _years(spark, sf_dir)
    return answers.per_day_rates(flag_day(spark, sf_dir), "Halloween", years, years)


@query(_per_day_sql("thanksgiving_vs_nonthanksgiving_by_type", "Thanksgiving", "21"))
def per_day_rate_thanksgiving(spark, sf_dir):
    years = _years(spark, sf_dir)
    return answers.per_day_rates(flag_dates(spark, sf_dir), "Thanksgiving", F.lit(21), years)


@query(_per_day_sql("holiday_vs_nonholiday", "Holiday", "56", "day_type", "total_crimes"))
def per_day_rate_holiday(spark, sf_dir):
    days = holidays(spark).agg(F.count("*")).scalar()
    return answers.per_day_rates(holiday_split(spark, sf_dir), "Holiday", days,
                                 _years(spark, sf_dir), ["day_type"], "total_crimes")


def _pivot_sql(mart, event, rate):
    off = f"Non-{event}"
    on_days, off_days = fv.CHART_DAYS[event]
    count = ("CAST(coalesce(sum(total) FILTER (day_type = '{0}'), 0) AS {1})")
    if not rate:
        return (f"SELECT primary_type, {count.format(event, 'BIGINT')} AS \"{event}\","
                f" {count.format(off, 'BIGINT')} AS \"{off}\" FROM ({M[mart]}) GROUP BY 1")
    return (f"SELECT primary_type, round({count.format(event, 'DOUBLE')} / {on_days}, 6) AS \"{event}\","
            f" round({count.format(off, 'DOUBLE')} / {off_days}, 6) AS \"{off}\""
            f" FROM ({M[mart]}) GROUP BY 1")


@query(_pivot_sql("halloween_vs_nonhalloween_by_type", "Halloween", rate=False))
def flag_pivot(spark, sf_dir):
    return ct.pivot_flags(flag_day(spark, sf_dir), "primary_type", "day_type",
                          ["Halloween", "Non-Halloween"])


def _per_day_chart(wide, event):
    """Rows per day on and off an event, by the chart's own numbers of days."""
    on_days, off_days = fv.CHART_DAYS[event]
    kept = [c for c in wide.columns if not c.endswith(event)]
    return wide.select(*kept, F.round(F.col(event) / on_days, 6).alias(event),
                       F.round(F.col(f"Non-{event}") / off_days, 6).alias(f"Non-{event}"))


def _typed_chart(counts, event):
    return _per_day_chart(ct.pivot_flags(counts, "primary_type", "day_type", [event, f"Non-{event}"]), event)


@query(_pivot_sql("thanksgiving_vs_nonthanksgiving_by_type", "Thanksgiving", rate=True))
def flag_pivot_per_day(spark, sf_dir):
    return _typed_chart(flag_dates(spark, sf_dir), "Thanksgiving")


@query(_pivot_sql("christmas_vs_nonchristmas_by_type", "Christmas", rate=True))
def flag_pivot_per_day_christmas(spark, sf_dir):
    return _typed_chart(flag_month(spark, sf_dir), "Christmas")


@query(_pivot_sql("halloween_vs_nonhalloween_by_type", "Halloween", rate=True))
def flag_pivot_per_day_halloween(spark, sf_dir):
    return _typed_chart(flag_day(spark, sf_dir), "Halloween")


@query("SELECT round(CAST(coalesce(sum(total_crimes) FILTER (day_type = 'Holiday'), 0) AS DOUBLE) / {}, 6) AS \"Holiday\","
       " round(CAST(coalesce(sum(total_crimes) FILTER (day_type = 'Non-Holiday'), 0) AS DOUBLE) / {}, 6) AS \"Non-Holiday\""
       " FROM ({})".format(*fv.CHART_DAYS["Holiday"], M["holiday_vs_nonholiday"]))
def flag_pivot_per_day_holiday(spark, sf_dir):
    both = ["Holiday", "Non-Holiday"]
    counts = holiday_split(spark, sf_dir)
    return _per_day_chart(counts.groupBy().pivot("day_type", both).agg(F.sum("total_crimes")).na.fill(0, subset=both), "Holiday")


_PCT = _pivot_sql("christmas_vs_nonchristmas_by_type", "Christmas", rate=False)


@query(f'SELECT primary_type, "Christmas", "Non-Christmas",'
       f' round(("Christmas" / CAST("Non-Christmas" AS DOUBLE) - 1) * 100, 6) AS pct_diff,'
       f' CASE WHEN ("Christmas" / CAST("Non-Christmas" AS DOUBLE) - 1) >= 0 THEN \'higher\' ELSE \'lower\' END'
       f' AS direction FROM ({_PCT})')
def flag_pct_diff(spark, sf_dir):
    wide = ct.pivot_flags(flag_month(spark, sf_dir), "primary_type", "day_type",
                          ["Christmas", "Non-Christmas"])
    compared = answers.compare_flags(wide, "primary_type", "Christmas", "Non-Christmas")
    return compared.withColumn("pct_diff", F.round("pct_diff", 6))


@query("(SELECT 'first' AS side, event_id, ts, event_type FROM events ORDER BY ts, event_id LIMIT 5)"
       " UNION ALL (SELECT 'last', event_id, ts, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1)")
def first_last_rows(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    first = ct.first_rows(rows, 5, [F.asc("ts"), F.asc("event_id")])
    last = ct.first_rows(rows, 1, [F.desc("ts"), F.desc("event_id")])
    return first.withColumn("side", F.lit("first")).unionByName(last.withColumn("side", F.lit("last")))


@query(M["monthly_trend"])
def monthly_trend(spark, sf_dir):
    return ts.monthly_trend(crimes(spark, sf_dir))


@query(M["monthly_trend_by_type"])
def monthly_trend_by_type(spark, sf_dir):
    return ts.monthly_trend_by_type(crimes(spark, sf_dir))


_CUBE_SQL = f"""{sp.WITH}, parts AS (SELECT CAST(hour(date) AS INTEGER) AS hour, CAST(date AS DATE) AS date_only,
  location_description, community_area, primary_type, date FROM crimes)
SELECT 'by_hour' AS cube, hour, NULL::DATE AS date_only, NULL::VARCHAR AS location_description,
  NULL::VARCHAR AS community_area, NULL::VARCHAR AS primary_type, count(*) AS n,
  min(date) AS first_at, max(date) AS last_at FROM parts GROUP BY hour
UNION ALL SELECT 'by_date_type', NULL, date_only, NULL, NULL, primary_type, count(*), min(date), max(date)
  FROM parts GROUP BY date_only, primary_type
UNION ALL SELECT 'by_label_type', NULL, NULL, location_description, NULL, primary_type, count(*), min(date), max(date)
  FROM parts GROUP BY location_description, primary_type
UNION ALL SELECT 'by_area_type', NULL, NULL, NULL, community_area, primary_type, count(*), min(date), max(date)
  FROM parts GROUP BY community_area, primary_type"""


@query(_CUBE_SQL)
def mart_cube(spark, sf_dir):
    return build_cubes(crimes(spark, sf_dir))


def _measures(name):
    """All measure columns of a mart."""
    several = {
        "hourly_crimes": ("crime_count",),
        "crimes_by_location_and_type": ("total", "location_total"),
        "airport_theft_count_comparison": ("theft_count", "total_crimes", "theft_rate"),
        "downtown_vs_residential_theft_robbery": ("tr_crimes", "total_crimes", "rate"),
        "transit_vs_commercial_robbery_count": ("robbery_count", "total_crimes", "robbery_rate"),
        "theft_by_location": ("total_thefts", "total_crimes"),
    }
    by_type = name.endswith(("_by_type", "_and_type")) and name != "sport_location_crimes_by_type"
    return several.get(name, ("total",) if by_type else ("total_crimes",))


def _all_marts_sql():
    parts = []
    for name, mart in marts().items():
        key = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in mart.keys)
        parts += [f"SELECT '{name}' AS mart, {key} AS key, '{m}' AS measure, round(CAST({m} AS DOUBLE), 6) AS value"
                  f" FROM ({M[name]})" for m in _measures(name)]
    return " UNION ALL ".join(parts)


def stored_cubes(spark, sf_dir):
    """The cubes as the job keeps them: parquet parted by cube, so a mart reads its own cube only."""
    folder = f"{shared_dir(spark).rstrip('/')}/cubes-{uuid.uuid4().hex}"
    build_cubes(crimes(spark, sf_dir)).write.partitionBy("cube").parquet(folder)
    return spark.read.parquet(folder)


@query(_all_marts_sql())
def all_marts(spark, sf_dir):
    """Every measure of every mart from one scan, stacked as (mart, key, measure, value)."""
    frames = []
    for name, df in derive_marts(stored_cubes(spark, sf_dir), holidays(spark)).items():
        key = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in marts()[name].keys]
        values = F.array(*[F.struct(F.lit(m).alias("measure"), F.round(F.col(m).cast("double"), 6).alias("value"))
                           for m in _measures(name)])
        frames.append(df.select(F.lit(name).alias("mart"), F.concat_ws("|", *key).alias("key"), F.inline(values)))
    return stack(frames)


@query(f"{sp.WITH} SELECT primary_type, count(*) AS n, count(DISTINCT id) AS n_ids, true AS within"
       " FROM crimes GROUP BY 1")
def distinct_ids(spark, sf_dir):
    """Different ids per type, exact, and whether the sketches merged from all months are within 4 standard errors."""
    rows = crimes(spark, sf_dir)
    monthly = distinct.sketch_by(rows.withColumn("month", F.month("date")), ["primary_type", "month"], "id")
    guessed = distinct.estimate(distinct.merge_by(monthly, ["primary_type"]), "guess")
    exact = rows.groupBy("primary_type").agg(F.count_distinct("id").alias("n_ids"))
    bound = 4 * distinct.STANDARD_ERROR * F.col("n_ids") + 1
    return exact.join(guessed, exact.primary_type.eqNullSafe(guessed.primary_type)).select(
        exact.primary_type, "n", "n_ids", (F.abs(F.col("guess") - F.col("n_ids")) <= bound).alias("within"))
