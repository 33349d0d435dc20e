"""Ad-hoc SQL, summaries, routing and nearest rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from civitally.functions import fixed_values as fv
from civitally.functions import text
from civitally.operators import answers, cleaning as cl, vectors
from civitally.plans import built_in
from civitally.plans.marts import derive_marts

from . import sql_parts as sp
from .counts import monthly_counts, stored_cubes, yearly_counts
from .places import area_counts, location_counts, share_by_label
from .registry import SQL, query
from .tables import crimes, holidays, read, stack

M = sp.MARTS
_TYPED = (f"{sp.CRIMES.replace('crimes AS', 'clean_rows AS', 1)}, crimes AS (SELECT id, date,"
          " TRY_CAST(year AS INTEGER) AS year, primary_type, location_description,"
          " TRY_CAST(community_area AS INTEGER) AS community_area FROM clean_rows)")


def _ad_hoc(spark, sf_dir, sql):
    cl.typed_view(crimes(spark, sf_dir), "crimes")
    return answers.ad_hoc(spark, sql)


def _shape(name, sql, added=""):
    """The text as it is for Spark; ``added`` is the limit that Spark's side adds by itself."""
    @query(f"WITH {_TYPED} {sql.replace('WITH ', ', ', 1) if sql.startswith('WITH ') else sql}{added}", name=name)
    def run(spark, sf_dir):
        return _ad_hoc(spark, sf_dir, sql)

    return run


_shape("ad_hoc_top_types",
       "SELECT primary_type, COUNT(*) AS n, COUNT(DISTINCT community_area) AS areas FROM crimes"
       " WHERE primary_type IS NOT NULL GROUP BY primary_type HAVING COUNT(*) > 20"
       " ORDER BY areas DESC, n DESC, primary_type LIMIT 7")
_shape("ad_hoc_day_count",
       "SELECT CAST(dayofmonth(date) AS INT) AS day_number, COUNT(*) AS n FROM crimes WHERE year BETWEEN 2005 AND 2008"
       " GROUP BY dayofmonth(date)")
_shape("ad_hoc_cte",
       "WITH yearly AS (SELECT year, primary_type, COUNT(*) AS n FROM crimes WHERE year IS NOT NULL"
       " GROUP BY year, primary_type) SELECT year, primary_type, n, n - LAG(n) OVER (PARTITION BY primary_type"
       " ORDER BY year) AS growth FROM yearly ORDER BY n DESC, year, primary_type LIMIT 60")
_shape("ad_hoc_top_labels",
       "SELECT location_description, COUNT(CASE WHEN month(date) IN (6, 7, 8) THEN 1 END) AS in_summer,"
       " COUNT(*) AS n FROM crimes WHERE location_description IS NOT NULL GROUP BY location_description"
       " ORDER BY in_summer DESC, location_description LIMIT 9")
_MANY = ("SELECT location_description, primary_type, year, CAST(month(date) AS INT) AS month_number, COUNT(*) AS n FROM crimes"
         " WHERE location_description IS NOT NULL AND primary_type IS NOT NULL AND year IS NOT NULL AND date IS NOT NULL"
         " GROUP BY location_description, primary_type, year, month(date)"
         " ORDER BY n DESC, location_description, primary_type, year, month_number")
_shape("ad_hoc_own_limit", _MANY + " LIMIT 500")
_shape("ad_hoc_without_limit", _MANY, " LIMIT 200")


_EXTREMES = """SELECT arg_max({label}, {measure}) AS highest_label, max({measure}) AS highest_value,
  arg_min({label}, {measure}) AS lowest_label, min({measure}) AS lowest_value FROM ({source})"""


@query(_EXTREMES.format(label="location_category", measure="total_crimes",
                        source=M["crimes_by_location"] + " ORDER BY location_category"))
def extremes(spark, sf_dir):
    return answers.extremes(location_counts(spark, sf_dir), "location_category", "total_crimes")


_SUMMARY = """SELECT count(*) AS rows_analyzed, CAST(sum({m}) AS BIGINT) AS total_count,
  round(avg({m}), 2) AS average_count,
  (SELECT CAST({l} AS VARCHAR) FROM src ORDER BY coalesce(nullif({m}, 0), '-inf'::DOUBLE) DESC, {l} NULLS FIRST LIMIT 1) AS highest_label,
  (SELECT CAST(trunc(coalesce({m}, 0)) AS BIGINT) FROM src ORDER BY coalesce(nullif({m}, 0), '-inf'::DOUBLE) DESC, {l} NULLS FIRST LIMIT 1) AS highest_count,
  (SELECT CAST({l} AS VARCHAR) FROM src ORDER BY coalesce(nullif({m}, 0), 'inf'::DOUBLE), {l} NULLS FIRST LIMIT 1) AS lowest_label,
  (SELECT CAST(trunc(coalesce({m}, 0)) AS BIGINT) FROM src ORDER BY coalesce(nullif({m}, 0), 'inf'::DOUBLE), {l} NULLS FIRST LIMIT 1) AS lowest_count,
  CASE WHEN avg({m}) > 0 THEN max({m}) / avg({m}) >= 1.2 ELSE false END AS stands_out FROM src"""


@query(f"WITH src AS (SELECT community_area, CAST(total_crimes AS DOUBLE) AS v FROM ({M['community_area_crimes']})) "
       + _SUMMARY.format(m="v", l="community_area"))
def summarize(spark, sf_dir):
    return answers.summarize(area_counts(spark, sf_dir), "community_area", "total_crimes")


@query(f"WITH src AS (SELECT month, CAST(total_crimes AS DOUBLE) AS v FROM ({M['monthly_crimes']})) "
       + _SUMMARY.format(m="v", l="month"))
def summarize_months(spark, sf_dir):
    return answers.summarize(monthly_counts(spark, sf_dir), "month", "total_crimes")


@query(f"SELECT CAST(sum(total_thefts) AS BIGINT) AS total, round(avg(total_thefts), 2) AS average"
       f" FROM ({M['theft_by_location']})")
def count_stats(spark, sf_dir):
    return answers.count_stats(share_by_label(spark, sf_dir), "total_thefts")


@query(f"WITH src AS ({M['yearly_crimes']}) SELECT min(year) AS first_year, max(year) AS last_year,"
       " arg_min(total_crimes, year) AS first_value, arg_max(total_crimes, year) AS last_value,"
       " round((arg_max(total_crimes, year) / CAST(arg_min(total_crimes, year) AS DOUBLE) - 1) * 100, 6)"
       " AS change_pct FROM src")
def first_last_change(spark, sf_dir):
    change = answers.first_last_change(yearly_counts(spark, sf_dir), "year", "total_crimes")
    return change.withColumn("change_pct", F.round("change_pct", 6))


# Word beginnings that occur in the test conversations, routed like the shipped questions.
_TEXT_ROUTES = (
    ("german", ("und", "der", "die", "ist"), None),
    ("french", ("les", "des", "est", "que"), None),
    ("thing", ("thing", "that"), "THE"),
    ("english", ("the", "and", "of"), None),
    ("spanish", ("los", "el", "es"), None),
)
_TEXT_TYPES = ("the", "and")


def _route_sql(routes, types):
    found = "CASE " + " ".join(
        f"WHEN contains(lower(text), '{t}') THEN '{t.upper()}'" for t in types) + " END"
    tests = " ".join(
        "WHEN regexp_matches(lower(text), '{}'){} THEN '{}'".format(
            r"(^|[^\p{L}\p{N}_])(" + "|".join(words) + ")",
            f" AND {found} = '{needed}'" if needed else "", target)
        for target, words, needed in routes)
    return (f"SELECT conv_id, turn, CASE {tests} END AS answer_table, {found} AS first_type"
            " FROM conversations WHERE role = 'user'")


def _routed(spark, sf_dir, routes, types):
    asked = read(spark, sf_dir, "conversations").filter("role = 'user'")
    return asked.select("conv_id", "turn", text.route("text", routes, types).alias("answer_table"),
                        text.first_contained("text", types).alias("first_type"))


@query(_route_sql(fv.QUESTION_ROUTES, fv.QUESTION_TYPES))
def route_texts(spark, sf_dir):
    return _routed(spark, sf_dir, fv.QUESTION_ROUTES, fv.QUESTION_TYPES)


@query(_route_sql(_TEXT_ROUTES, _TEXT_TYPES))
def route_texts_by_words(spark, sf_dir):
    return _routed(spark, sf_dir, _TEXT_ROUTES, _TEXT_TYPES)


_CENTRES = """numbered AS (SELECT label, generate_subscripts(embedding, 1) AS i,
  unnest(embedding)::DOUBLE AS x FROM embeddings),
means AS (SELECT label, i, round(avg(x), 6) AS x FROM numbered GROUP BY ALL),
centres AS (SELECT label, list(x ORDER BY i) AS centre FROM means GROUP BY label),
pairs AS (SELECT c.label AS query_id, e.vec_id, list_sum(list_transform(
  list_zip(e.embedding::DOUBLE[], c.centre), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance
  FROM embeddings e CROSS JOIN centres c),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM pairs)"""


def _label_centres(spark, sf_dir):
    """Mean vector of every label: one row per label, whatever the number of vectors."""
    rows = read(spark, sf_dir, "embeddings")
    numbered = rows.select("label", F.posexplode(F.col("embedding").cast("array<double>")).alias("i", "x"))
    means = numbered.groupBy("label", "i").agg(F.round(F.avg("x"), 6).alias("x"))
    ordered = F.sort_array(F.collect_list(F.struct("i", "x")))
    centres = means.groupBy("label").agg(ordered.alias("e"))
    return centres.select(F.col("label").alias("query_id"),
                          F.transform("e", lambda s: s["x"]).alias("embedding"))


@query(f"WITH {_CENTRES} SELECT CAST(query_id AS BIGINT) AS query_id, CAST(rank AS INTEGER) AS rank, vec_id,"
       " round(distance, 6) AS distance FROM ranked WHERE rank <= 4")
def vector_topk(spark, sf_dir):
    """The 4 vectors nearest to the mean vector of every label."""
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = vectors.nearest_rows(rows, _label_centres(spark, sf_dir), k=4)
    return found.withColumn("distance", F.round("distance", 6))


@query("""WITH pairs AS (SELECT q.vec_id AS query_id, e.vec_id, list_sum(list_transform(
  list_zip(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance
  FROM embeddings e CROSS JOIN embeddings q), ranked AS (SELECT *, row_number() OVER (
  PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM pairs)
  SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, round(distance, 6) AS distance FROM ranked WHERE rank <= 4""")
def vector_topk_all(spark, sf_dir):
    """The 4 vectors nearest to every vector, itself included."""
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = vectors.nearest_rows(rows, rows.withColumnRenamed("vec_id", "query_id"), k=4)
    return found.withColumn("distance", F.round("distance", 6))


# Mart: label, measure, rows of its fixed answer, for answers that need no rate.
_BUILT_IN = {
    "great_recession_by_type": ("primary_type", "total", "LIMIT 10"),
    "community_area_crimes": ("community_area", "total_crimes", "LIMIT 10"),
    "theft_by_location": ("location_description", "total_thefts", "LIMIT 10"),
    "time_period_crimes": ("time_period", "total_crimes", ""),
    "crimes_by_location": ("location_category", "total_crimes", ""),
    "sport_location_crimes": ("crime_category", "total_crimes", ""),
    "airport_theft_count_comparison": ("location_type", "theft_rate", ""),
    "downtown_vs_residential_theft_robbery": ("area_type", "rate", ""),
    "transit_vs_commercial_robbery_count": ("location_type", "robbery_count", ""),
    "hourly_crimes": ("CAST(hour AS VARCHAR)", "crime_count", ""),
    "monthly_crimes": ("CAST(month AS VARCHAR)", "total_crimes", ""),
    "yearly_crimes": ("CAST(year AS VARCHAR)", "total_crimes", ""),
}
# Event comparisons, by the registered query whose SQL has the same rows.
_EVENTS = {
    "christmas_vs_nonchristmas_by_type": "per_day_rate",
    "halloween_vs_nonhalloween_by_type": "per_day_rate_halloween",
    "thanksgiving_vs_nonthanksgiving_by_type": "per_day_rate_thanksgiving",
}
_BUILT_IN_SQL = " UNION ALL ".join([
    *(f"(SELECT '{table}' AS answer_table, {label} AS label, round(CAST({measure} AS DOUBLE), 6) AS value"
      f" FROM ({M[table]}) ORDER BY {measure} DESC, label {limit})"
      for table, (label, measure, limit) in _BUILT_IN.items()),
    *(f"SELECT '{table}', concat_ws('|', day_type, primary_type), daily_avg FROM ({SQL[name]})"
      for table, name in _EVENTS.items()),
    f"SELECT 'holiday_vs_nonholiday', day_type, daily_avg FROM ({SQL['per_day_rate_holiday']})",
    "SELECT 'season_crimes', season, round(total_crimes / CASE season WHEN 'Summer' THEN 3.0::DOUBLE"
    f" WHEN 'Late Winter' THEN 2 ELSE 7 END) FROM ({M['season_crimes']})",
])


@query(_BUILT_IN_SQL)
def built_in_answers(spark, sf_dir):
    """The fixed answers to all routed questions, stacked as (answer_table, label, value)."""
    dates = holidays(spark)
    built = derive_marts(stored_cubes(spark, sf_dir), dates)
    columns = {table: ([label.removeprefix("CAST(").split(" ")[0]], measure)
               for table, (label, measure, _) in _BUILT_IN.items()}
    columns |= {table: (["day_type", "primary_type"], "daily_avg") for table in _EVENTS}
    columns |= {"holiday_vs_nonholiday": (["day_type"], "daily_avg"), "season_crimes": (["season"], "per_month")}
    frames = []
    for table, (label, measure) in columns.items():
        named = F.col(label[0]).cast("string") if len(label) == 1 else F.concat_ws("|", *label)
        frames.append(built_in.answer(table, built.__getitem__, holidays=dates).select(
            F.lit(table).alias("answer_table"), named.alias("label"),
            F.round(F.col(measure).cast("double"), 6).alias("value")))
    return stack(frames)
