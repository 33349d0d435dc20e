"""Cleaning, typing and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from civitally import schema
from civitally.functions import fixed_values as fv
from civitally.functions import text
from civitally.operators import cleaning as cl, quality
from civitally.functions import calendars as cal

from . import sql_parts as sp
from .registry import query
from .tables import RAW_CRIMES, crimes, raw_crimes, read

_FORMAT = "'%m/%d/%Y %I:%M:%S %p'"


@query(f'WITH {RAW_CRIMES} SELECT "ID" AS id, "Date" AS text, try_strptime("Date", {_FORMAT}) AS date'
       " FROM raw_crimes")
def parse_ts(spark, sf_dir):
    raw = raw_crimes(spark, sf_dir)
    parsed = text.parse_ts("Date", schema.TIMESTAMP_FORMAT).cast("timestamp_ntz")
    return raw.select(F.col("ID").alias("id"), F.col("Date").alias("text"), parsed.alias("date"))


def _bool_sql(column):
    return (f"CASE lower(trim({column})) WHEN 'true' THEN true WHEN 'false' THEN false END")


@query(f'WITH {RAW_CRIMES} SELECT "Arrest" AS text, {_bool_sql(chr(34) + "Arrest" + chr(34))} AS arrest,'
       " count(*) AS total FROM raw_crimes GROUP BY ALL")
def parse_bool(spark, sf_dir):
    raw = raw_crimes(spark, sf_dir).select(F.col("Arrest").alias("text"))
    return raw.groupBy("text", text.parse_bool("text").alias("arrest")).agg(
        F.count("*").alias("total"))


_SNAKE = ", ".join(
    f'"{name}" AS {name.lower().replace(" ", "_")}'
    for name in ("ID", "Date", "Primary Type", "Description", "Location Description", "Arrest",
                 "Domestic", "Community Area", "Year", "X", "Y"))
_PARSED = (
    f"{RAW_CRIMES}, snake AS (SELECT {_SNAKE} FROM raw_crimes), parsed AS (SELECT * REPLACE ("
    f"try_strptime(date, {_FORMAT}) AS date, {_bool_sql('arrest')} AS arrest,"
    f" {_bool_sql('domestic')} AS domestic) FROM snake"
    " WHERE date IS NOT NULL AND primary_type IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL)"
)
_REST = ("primary_type", "description", "location_description", "arrest", "domestic",
         "community_area", "year", "x", "y")
_UNIQUE = (
    f"{_PARSED}, picked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY date DESC NULLS LAST, "
    + ", ".join(f"{c} ASC NULLS LAST" for c in _REST)
    + ") AS rn FROM parsed), uniq AS (SELECT * EXCLUDE (rn) FROM picked WHERE rn = 1)"
)
_CLEAN = (f"{_UNIQUE}, clean AS (SELECT * FROM uniq WHERE NOT regexp_matches(location_description,"
          f" '(?i).*({'|'.join(fv.CLEANING_EXCLUSIONS)}).*'))")


@query(f"WITH {_UNIQUE} SELECT * FROM uniq")
def dedup_by_key(spark, sf_dir):
    table = cl.snake_case_columns(raw_crimes(spark, sf_dir)).drop("case_number", "updated_on")
    parsed = cl.require(table, schema.REQUIRED_COLUMNS).withColumns({
        "date": text.parse_ts("date", schema.TIMESTAMP_FORMAT).cast("timestamp_ntz"),
        "arrest": text.parse_bool("arrest"),
        "domestic": text.parse_bool("domestic"),
    })
    return cl.dedup_by_key(parsed, ["id"], [F.col("date").desc_nulls_last()], ["date"])


@query(f"WITH {_CLEAN} SELECT * FROM clean")
def clean_incidents(spark, sf_dir):
    clean = cl.clean_incidents(raw_crimes(spark, sf_dir))
    return clean.withColumn("date", F.col("date").cast("timestamp_ntz"))


@query(f"WITH {_CLEAN} SELECT 'before' AS stage, count(*) AS n_rows, 13 AS n_columns FROM raw_crimes"
       " UNION ALL SELECT 'after', count(*), 11 FROM clean")
def clean_report(spark, sf_dir):
    raw = raw_crimes(spark, sf_dir)
    return cl.clean_report(raw, cl.clean_incidents(raw))


@query(f"{sp.WITH} SELECT id, date, TRY_CAST(year AS INTEGER) AS year, primary_type, description,"
       " location_description, arrest, domestic, TRY_CAST(community_area AS INTEGER) AS community_area,"
       " TRY_CAST(x AS DOUBLE) AS longitude, TRY_CAST(y AS DOUBLE) AS latitude FROM crimes")
def typed_view(spark, sf_dir):
    return cl.typed_view(crimes(spark, sf_dir))


@query(f"{sp.WITH} SELECT id, count(*) AS n_rows FROM crimes GROUP BY 1 HAVING count(*) > 1 OR id IS NULL")
def key_violations(spark, sf_dir):
    return quality.key_violations(crimes(spark, sf_dir), ["id"])


@query("WITH m AS (SELECT DISTINCT l_suppkey, year(l_shipdate) * 12 + month(l_shipdate) - 1 AS m FROM lineitem),"
       " spans AS (SELECT l_suppkey, unnest(range(min(m), max(m) + 1))::INTEGER AS month_idx FROM m GROUP BY 1)"
       " SELECT l_suppkey, month_idx FROM spans WHERE NOT EXISTS (SELECT 1 FROM m"
       " WHERE m.l_suppkey = spans.l_suppkey AND m.m = month_idx)")
def missing_months(spark, sf_dir):
    """Months without a shipment of a supplier, between its first and its last one."""
    rows = read(spark, sf_dir, "lineitem")
    index = cal.month_index(F.year("l_shipdate"), F.month("l_shipdate"))
    return quality.missing_months(rows.select("l_suppkey", index.alias("month_idx")), by=["l_suppkey"])
