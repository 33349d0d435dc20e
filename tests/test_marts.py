"""Marts from the cubes against marts counted from the rows, on rows full of traps."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from civitally.functions import calendars as cal
from civitally.functions import fixed_values as fv
from civitally.functions import text
from civitally.operators import counting as ct, quality, series as ts
from civitally.operators.cubes import build_cubes
from civitally.plans.jobs import run_marts
from civitally.plans.marts import catalogue, derive_marts, marts
from civitally.sources import readers

from .conftest import plan, rows
from .incident_fixture import TRAPS, clean_rows


@pytest.fixture(scope="module")
def incidents(spark):
    return clean_rows(spark, TRAPS).cache()


@pytest.fixture(scope="module")
def holidays(spark):
    # One date twice: the split must not count its rows twice.
    rows_ = [("2019-12-25", "Christmas Day"), ("2019-12-25", "Again"), ("2008-07-04", "July 4")]
    return spark.createDataFrame(rows_, "holiday_date string, holiday_name string").withColumn(
        "holiday_date", F.to_date("holiday_date"))


@pytest.fixture(scope="module")
def built(incidents, holidays):
    cubes = build_cubes(incidents).cache()
    return derive_marts(cubes, holidays)


def as_dict(df):
    return {tuple(r)[:-1]: tuple(r)[-1] for r in df.collect()}


def test_null_date_counts_as_other(built):
    assert as_dict(built["time_period_crimes"]) == {
        ("Overnight",): 3, ("Daytime",): 9, ("Evening",): 2}
    assert as_dict(built["season_crimes"])[("Other",)] == 8
    assert as_dict(built["hourly_crimes"])[(None,)] == 1


def test_period_without_null_bucket(incidents):
    period = cal.time_period(F.hour("date"), null_bucket=False)
    assert as_dict(ct.count_by(incidents, {"p": period}))[(None,)] == 1


def test_holiday_split_keeps_the_row_count(built):
    assert as_dict(built["holiday_vs_nonholiday"]) == {("Holiday",): 2, ("Non-Holiday",): 12}


def test_flags_put_null_dates_off_the_event(built):
    split = as_dict(built["christmas_vs_nonchristmas_by_type"])
    assert split[("Christmas", "THEFT")] == 1
    assert split[("Non-Christmas", "THEFT")] == 3
    assert as_dict(built["thanksgiving_vs_nonthanksgiving_by_type"])[("Thanksgiving", "BATTERY")] == 1


def test_event_definitions_differ(incidents):
    december = ct.count_by(incidents, ["primary_type"], where=cal.in_month("date", 12))
    days = ct.count_by(incidents, ["primary_type"], where=cal.in_days("date", 12, 25, 26))
    assert rows(december) != rows(days)


def test_substring_rules(built, incidents):
    named = incidents.select(
        "location_description",
        text.classify("location_description", fv.LOCATION_CATEGORIES, "Other").alias("c"))
    found = {r[0]: r[1] for r in named.collect()}
    assert found["WAREHOUSE"] == "Residential"
    assert found["RIVERBANK"] == "Financial"
    assert found["BARBERSHOP"] == "Restraunt Area"
    assert found[None] == "Other"
    kinds = {r[0]: r[1] for r in incidents.select(
        "location_description",
        text.classify("location_description", fv.TRANSIT_CATEGORIES, "Other")).collect()}
    assert kinds["GAS STATION"] == "Public Transit"


def test_alias_rules_run_one_after_the_other(spark):
    df = spark.createDataFrame(
        [("AIRPORT TERMINAL LOWER LEVEL - NON-SECURE AREA",), ("  bank ",), ("RIVERBANK",)], "t string")
    assert [r[0] for r in df.select(text.normalize_label("t")).collect()] == [
        "AIRPORT TERMINAL-SECURE", "BANK/CREDIT UNION", "RIVERBANK"]


def test_labels_are_tidied(built):
    totals = {r.location_description for r in built["theft_by_location"].collect()}
    assert totals == {"STREET", "WAREHOUSE", "AIRPORT TERMINAL-SECURE", "ALLEY"}
    venues = as_dict(built["sport_location_crimes_by_type"])
    assert venues == {("SPORTS ARENA/STADIUM", "BATTERY"): 1}


def test_labels_without_a_match_are_left_out(built):
    names = {r.location_type for r in built["transit_vs_commercial_robbery_count"].collect()}
    assert names == {"Other"}


def test_area_share_reads_numbers_only(built):
    shares = {r.area_type: (r.tr_crimes, r.total_crimes) for r in
              built["downtown_vs_residential_theft_robbery"].collect()}
    # 32, 032, 8, 28, 28 are downtown; 32.0 and abc are not.
    assert shares == {"Downtown": (3, 5), "Residential": (2, 7)}


def test_ties_go_to_the_first_type(built):
    top = {r.location_category: r.primary_type for r in
           built["crimes_by_location_and_type"].collect()}
    assert top["Street/Outdoors"] == "THEFT"


def test_partial_last_month_is_dropped(built, spark):
    assert (2020, 2) not in as_dict(built["monthly_trend"])
    whole = clean_rows(spark, [*TRAPS, ("2020-02-28 00:00:00", "THEFT", "ALLEY", "28")])
    assert (2020, 2) in as_dict(ts.monthly_trend(whole))


def test_null_types_have_no_series(built):
    assert (2008, 7) in as_dict(built["monthly_trend"])
    assert all(k[:2] != (2008, 7) for k in as_dict(built["monthly_trend_by_type"]))


def test_direct_counts_equal_cube_counts(incidents, built):
    tidy = incidents.withColumn("location_description", text.tidy_text("location_description"))
    direct = {
        "hourly_crimes": ct.count_by(incidents, {"hour": F.hour("date")}),
        "yearly_crimes": ct.count_by(incidents, {"year": F.year("date")}),
        "monthly_crimes": ct.count_by(incidents, {"month": F.month("date")}),
        "halloween_by_type": ct.count_by(
            incidents, ["primary_type"], where=cal.on_day("date", 10, 31)),
        "thanksgiving_by_type": ct.count_by(
            incidents, ["primary_type"], where=cal.in_dates("date", fv.THANKSGIVING_DATES)),
        "great_recession_by_type": ct.count_by(
            incidents, ["primary_type"], where=cal.in_years("date", fv.RECESSION_YEARS)),
        "monthly_trend": ts.monthly_trend(incidents),
        "monthly_trend_by_type": ts.monthly_trend_by_type(incidents),
        "community_area_crimes": ct.count_by(
            incidents, ["community_area"], where=text.has_text("community_area")),
        "theft_by_location": ct.share_by(
            tidy.filter(text.has_text("location_description")),
            {"location_description": text.normalize_label("location_description")},
            F.col("primary_type") == "THEFT", "t", "n"),
    }
    for name, expected in direct.items():
        assert rows(built[name]) == rows(expected), name


def test_catalogue_and_keys(built):
    assert len(marts()) == 24 and len(catalogue()) == 4
    for name, df in built.items():
        keys = marts()[name].keys
        assert set(keys) <= set(df.columns), name
        dense = df.dropna(subset=list(keys))
        assert quality.key_violations(dense, list(keys)).isEmpty(), name


def test_one_scan_for_all_cubes(spark, incidents, tmp_path):
    incidents.write.parquet(str(tmp_path / "clean"))
    cubes = build_cubes(spark.read.parquet(str(tmp_path / "clean")))
    text_plan = plan(cubes)
    assert text_plan.count("FileScan") == 1
    assert "description" not in text_plan.split("ReadSchema")[1].replace("location_description", "")


def test_job_writes_every_mart(spark, incidents, holidays, built, tmp_path, monkeypatch):
    from civitally.sources import writers

    sent = []
    monkeypatch.setattr(writers, "write_jdbc", lambda df, table, options: sent.append(table))
    run_marts(incidents, holidays, str(tmp_path), {"url": "jdbc:none"})
    assert sent == list(marts())
    for name in marts():
        assert rows(readers.read_mart(spark, str(tmp_path), name)) == rows(built[name]), name
    with pytest.raises(KeyError):
        readers.read_mart(spark, str(tmp_path), "no_such_mart")
    with pytest.raises(KeyError):
        readers.read_mart(spark, str(tmp_path), "christmas_by_type", listed_only=True)


def test_date_filters_reach_the_files(spark, incidents, tmp_path):
    incidents.write.parquet(str(tmp_path / "clean"))
    clean = spark.read.parquet(str(tmp_path / "clean"))
    for test in (cal.in_dates("date", ["2019-11-28"], prune=True), cal.in_years("date", [2008, 2009])):
        pushed = plan(ct.count_by(clean, ["primary_type"], where=test))
        assert "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date" in pushed
        assert "ReadSchema: struct<date:timestamp_ntz,primary_type:string>" in pushed


def test_dimension_joins_are_broadcast_by_size(spark, incidents, holidays):
    from civitally.plans.marts import holiday_split

    dated = incidents.withColumn("date_only", F.to_date("date"))
    df = holiday_split(dated, holidays)
    df.collect()
    assert "BroadcastHashJoin" in plan(df)


def test_hours_follow_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    instant = spark.range(1).select(F.timestamp_seconds(F.lit(1577836800)).alias("date"))
    try:
        found = {}
        for name in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", name)
            found[name] = tuple(cal.add_calendar_parts(instant).select("hour", "year").first())
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == {"UTC": (0, 2020), "America/Los_Angeles": (16, 2019)}


def test_every_route_has_an_answer(built, holidays):
    from civitally.plans import built_in

    for table, _, _ in fv.QUESTION_ROUTES:
        found = built_in.answer(table, built.__getitem__, holidays=holidays)
        assert found.count() > 0, table
    theft = built_in.answer("christmas_vs_nonchristmas_by_type", built.__getitem__, "THEFT")
    # Four years are covered and one row has no date: 5 groups of year, 31 December days each.
    assert {(r.day_type, r.total, r.daily_avg) for r in theft.collect()} == {
        ("Christmas", 1, 0.0), ("Non-Christmas", 3, 0.0)}
    with pytest.raises(KeyError):
        built_in.answer("nothing", built.__getitem__)
    with pytest.raises(ValueError):
        built_in.answer("holiday_vs_nonholiday", built.__getitem__)


def test_marts_after_increments_are_those_of_all_rows(spark, incidents, holidays, tmp_path):
    from civitally.plans.increments import table_files
    from civitally.plans.jobs import refresh_marts

    clean, out = str(tmp_path / "clean"), str(tmp_path / "out")
    parts = incidents.withColumn("incident_year", F.year("date")).withColumn("_p", F.pmod(F.xxhash64("id"), F.lit(3)))
    read = []
    for part in range(3):
        parts.filter(F.col("_p") == part).drop("_p").coalesce(2).write.mode("append").partitionBy(
            "incident_year").parquet(clean)
        read.append(refresh_marts(spark, clean, holidays, out))
    assert sum(read) == table_files(spark, clean).count() and all(read)
    assert refresh_marts(spark, clean, holidays, out) == 0
    for name, mart in derive_marts(build_cubes(incidents), holidays).items():
        assert rows(readers.read_mart(spark, out, name).select(mart.columns)) == rows(mart), name


def test_a_rewritten_file_starts_over(spark, incidents, tmp_path):
    from civitally.plans.increments import refresh_cubes
    from civitally.sources import writers

    clean, out = str(tmp_path / "clean"), str(tmp_path / "out")
    incidents.limit(9).coalesce(1).write.parquet(clean)
    assert refresh_cubes(spark, clean, out) == 1
    incidents.coalesce(1).write.mode("overwrite").parquet(clean)
    assert refresh_cubes(spark, clean, out) == 1
    total = writers.read_published(spark, out, "cubes").filter("cube = 'by_hour'").agg(F.sum("n")).first()[0]
    assert total == incidents.count()


def test_sketches_merge_like_rows(spark):
    from civitally.operators import distinct
    from civitally.operators.cubes import data_range, merge_cubes

    df = spark.range(60_000).selectExpr("id % 7 AS k", "id % 5 AS part", "id % 20000 AS v")
    whole = distinct.sketch_by(df, ["k"], "v")
    merged = distinct.merge_by(distinct.sketch_by(df, ["k", "part"], "v"), ["k"])
    one, two = (sorted(map(tuple, distinct.estimate(s).select("k", "n", "n_distinct").collect())) for s in (whole, merged))
    exact = dict(df.groupBy("k").agg(F.count_distinct("v")).collect())
    for found in (one, two):
        assert all(abs(n - exact[k]) <= 4 * distinct.STANDARD_ERROR * exact[k] for k, _, n in found)
    incidents = spark.range(5000).selectExpr(
        "CAST(id AS string) AS id", "timestamp'2019-01-01' + make_interval(0, 0, 0, 0, CAST(id AS int)) AS date",
        "'T' AS primary_type", "CAST(id % 3 AS string) AS location_description", "'1' AS community_area")
    parts = [build_cubes(incidents.filter(f"CAST(id AS int) % 2 = {p}"), distinct="id") for p in (0, 1)]
    cubes = merge_cubes(*parts)
    by_area = cubes.filter("cube = 'by_area_type'").select(F.hll_sketch_estimate("sketch").alias("ids"), "n").first()
    assert by_area.n == 5000 and abs(by_area.ids - 5000) <= 4 * distinct.STANDARD_ERROR * 5000
    assert data_range(cubes).first() == incidents.agg(F.min("date"), F.max("date")).first()
