from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from civitally.operators import cleaning as cl, pruning, quality
from civitally.functions import text
from civitally.plans.jobs import run_clean
from civitally.sources import readers, writers

from .conftest import plan, rows
from .incident_fixture import HEADER, RAW, clean_rows, write_raw


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    return readers.read_raw(spark, write_raw(tmp_path_factory.mktemp("raw")), partitions=4)


@pytest.fixture(scope="module")
def clean(raw):
    return cl.clean_incidents(raw).cache()


def by_id(clean):
    return {r.id: r for r in clean.collect()}


def test_raw_is_all_text(raw):
    assert {f.dataType.simpleString() for f in raw.schema} == {"string"}
    assert raw.count() == 14


def test_kept_ids(clean):
    assert set(by_id(clean)) == {"1", "2", "7", "10", None}


def test_unreadable_date_stays_as_null(clean):
    assert by_id(clean)["2"].date is None


def test_later_copy_is_kept_and_null_ids_are_one_key(clean):
    kept = by_id(clean)
    assert kept["10"].location_description == "ALLEY"
    assert kept[None].location_description == "ALLEY"


def test_exclusion_runs_after_dedup(clean):
    assert "9" not in by_id(clean)


def test_booleans_have_three_states(clean):
    row = by_id(clean)["7"]
    assert row.arrest is False and row.domestic is None


def test_clean_columns(clean):
    assert clean.columns == ["id", "date", "primary_type", "description", "location_description",
                             "arrest", "domestic", "community_area", "year", "x", "y"]


def test_dedup_is_the_same_for_any_partitioning(raw):
    once = rows(cl.clean_incidents(raw.repartition(1)))
    again = rows(cl.clean_incidents(raw.repartition(7)))
    assert once == again


def test_dedup_limits_keys_before_the_shuffle(raw):
    table = cl.snake_case_columns(raw)
    for frame in (cl.dedup_by_key(table, ["id"], stored=True), cl.dedup_by_key(table, ["id"])):
        assert plan(frame).count("WindowGroupLimit") == 2


def test_rows_of_unique_keys_are_not_moved(spark):
    df = spark.range(1000).selectExpr("id", "id * 2 AS v").unionByName(spark.sql("SELECT 7 AS id, 0 AS v"))
    text_plan = plan(cl.dedup_by_key(df, ["id"], [F.col("v").desc()], ["v"], stored=True))
    alone = text_plan.split("Union")[1].split("Window")[0]
    assert "LeftAnti" in alone and "hashpartitioning" not in alone


@pytest.mark.parametrize("most", [0, 5, 10 ** 6])
def test_dedup_by_hash_and_by_window_agree(spark, most):
    df = spark.range(400).selectExpr(
        "CASE WHEN id % 9 = 0 THEN NULL WHEN id < 300 THEN id % 250 ELSE id END AS k", "id % 3 AS a", "id % 7 AS b",
        "CASE WHEN id % 5 > 0 THEN CAST(id % 2 AS string) END AS c").repartition(5)
    order = [F.col("a").desc_nulls_last()]
    wanted = rows(cl.first_by_key(df, ["k", "c"], order, ["a"]))
    assert rows(cl.dedup_by_key(df, ["k", "c"], order, ["a"], True, most)) == wanted
    assert rows(quality.key_violations(df, ["k", "c"], most)) == rows(
        df.groupBy("k", "c").agg(F.count("*").alias("n_rows")).filter("n_rows > 1 OR k IS NULL OR c IS NULL"))


def test_job_writes_and_reports(spark, tmp_path):
    report = run_clean(spark, write_raw(tmp_path), str(tmp_path / "clean"), partitions=3)
    assert {(r.stage, r.n_rows, r.n_columns) for r in report.collect()} == {
        ("before", 14, 22), ("malformed", 0, 22), ("after", 5, 11)}


def test_malformed_lines_are_counted_and_left_out(spark, tmp_path):
    file = tmp_path / "raw.csv"
    line = ",".join(f'"{v}"' for v in RAW[0][1:])
    sound = [f'"{i}",{line}' for i in range(5)]
    long = f'"90",{line},"one more"'
    short = '"91","HX1","07/04/2019 11:30:00 PM","B"'
    open_quote = f'"92",{line}'.replace('"text"', '"text')
    file.write_text("\n".join([",".join(HEADER), *sound, long, short, open_quote]) + "\n")
    report = run_clean(spark, str(file), str(tmp_path / "clean"))
    assert {(r.stage, r.n_rows) for r in report.collect()} == {("before", 8), ("malformed", 3), ("after", 5)}
    assert {r.id for r in readers.read_clean(spark, str(tmp_path / "clean")).collect()} == set("01234")
    lines = readers.read_raw(spark, str(file), malformed="bad").filter("bad IS NOT NULL").select("ID", "bad").collect()
    assert {r.bad for r in lines} == {long, short, open_quote}


def test_quoted_line_ends(spark, tmp_path):
    file = tmp_path / "raw.csv"
    lines = [",".join(f'"{v}"' for v in row).replace('"text"', '"two\nlines"') for row in RAW[:1]]
    file.write_text("\n".join([",".join(HEADER), *lines]) + "\n")
    assert run_clean(spark, str(file), str(tmp_path / "a")).filter("stage = 'malformed'").first().n_rows == 2
    report = run_clean(spark, str(file), str(tmp_path / "b"), multi_line=True)
    assert {(r.stage, r.n_rows) for r in report.collect()} == {("before", 1), ("malformed", 0), ("after", 1)}
    assert readers.read_clean(spark, str(tmp_path / "b")).first().description == "two\nlines"


def test_written_clean_table_prunes_years(spark, clean, tmp_path):
    writers.write_clean(clean, str(tmp_path / "c"))
    back = readers.read_clean(spark, str(tmp_path / "c"))
    assert back.count() == 5
    one = back.filter("incident_year = 2019").select("id")
    assert "PartitionFilters: [isnotnull(incident_year" in plan(one)


def _read_files(df) -> int:
    df.collect()
    scans = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(scans.apply(i).metrics().apply("numFiles").value() for i in range(scans.size()))


def test_date_filters_name_the_year_folders(spark, tmp_path):
    items = [(f"{y}-{m:02d}-15 12:00:00", "THEFT", "STREET", "1") for y in range(2005, 2021) for m in (1, 6, 11)]
    items += [("2019-12-31 23:30:00", "THEFT", "STREET", "1"), ("2020-01-01 00:30:00", "THEFT", "STREET", "1"),
              (None, "THEFT", "STREET", "1")]
    zoned = clean_rows(spark, items).withColumn("date", F.col("date").cast("timestamp"))
    writers.write_clean(zoned, str(tmp_path / "c"))
    back = readers.read_clean(spark, str(tmp_path / "c"))
    every = _read_files(back.select("id"))
    for found, plainly, most in (
        (pruning.of_years(back, [2008, 2009]), back.filter("year(date) IN (2008, 2009)"), 4),
        (pruning.on_dates(back, ["2019-11-15", "2007-06-15"]),
         back.filter("to_date(date) IN ('2019-11-15', '2007-06-15')"), 2),
        (pruning.between(back, "2019-12-31", "2020-01-01"), back.filter("to_date(date) = '2019-12-31'"), 2),
        (pruning.of_years(cl.typed_view(back), [2012]), cl.typed_view(back).filter("year(date) = 2012"), 3),
    ):
        assert "incident_year" in plan(found).split("PartitionFilters: [")[1].split("]")[0]
        assert rows(found.select("id", "date")) == rows(plainly.select("id", "date")) != []
        assert _read_files(found.select("id")) <= most < every
    # Folders written in one time zone and dates asked for in another one.
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")
    try:
        assert rows(pruning.of_years(back, [2020]).select("id")) == rows(back.filter("year(date) = 2020").select("id"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert pruning.of_years(back.drop("incident_year"), [2008]).count() == 3


def test_parse_int_reads_fractions(spark):
    df = spark.createDataFrame(
        [("032",), ("32.0",), ("32.5",), ("-2.5",), ("abc",), ("",), (None,), (" 7 ",)], "t string")
    assert [r[0] for r in df.select(text.parse_int("t")).collect()] == [
        32, 32, 33, -3, None, None, None, 7]


def test_null_label_is_excluded(spark):
    df = spark.createDataFrame([(None,), ("ok",), ("New Stand",)], "t string")
    assert rows(df.filter(text.not_containing("t", ["NEW STAND"]))) == [("ok",)]


def test_key_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "k int, v string")
    assert rows(quality.key_violations(df, ["k"])) == [(None, 1), (1, 2)]


def test_missing_months(spark):
    df = spark.createDataFrame([(10,), (12,), (15,), (12,)], "month_idx int")
    assert rows(quality.missing_months(df)) == [(11,), (13,), (14,)]
    quality.fail_on_gaps(df.filter("month_idx = 12"))
    with pytest.raises(ValueError):
        quality.fail_on_gaps(df)


def test_typed_view_casts_without_errors(clean):
    typed = cl.typed_view(clean)
    assert dict(typed.dtypes)["year"] == "int"
    assert dict(typed.dtypes)["longitude"] == "double"
    assert typed.filter(F.col("community_area") == 32).count() == 5
