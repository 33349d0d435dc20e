from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civitally.functions import calendars as cal
from civitally.functions import text
from civitally.operators import answers, counting as ct, vectors
from civitally.sources.readers import area_centroids

from .conftest import plan, rows


def test_zero_is_never_the_lowest(spark):
    df = spark.createDataFrame([("a", 0), ("b", 5), ("c", 9), ("d", None)], "k string, v int")
    row = answers.summarize(df, "k", "v").first()
    assert (row.highest_label, row.highest_count) == ("c", 9)
    assert (row.lowest_label, row.lowest_count) == ("b", 5)
    assert row.rows_analyzed == 4 and row.total_count == 14
    assert row.average_count == pytest.approx(4.67) and row.stands_out


def test_all_zero_falls_back_to_the_first(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0)], "k string, v int")
    row = answers.summarize(df, "k", "v").first()
    assert (row.highest_label, row.lowest_label, row.stands_out) == ("a", "a", False)


def test_even_values_do_not_stand_out(spark):
    df = spark.createDataFrame([("a", 10), ("b", 11)], "k string, v int")
    assert not answers.summarize(df, "k", "v").first().stands_out


def test_extremes_take_null_as_zero(spark):
    df = spark.createDataFrame([("a", 3), ("b", None), ("c", 3)], "k string, v int")
    assert tuple(answers.extremes(df, "k", "v").first()) == ("a", 3, "b", 0)


def test_pick_columns():
    schema = T.StructType.fromDDL("hour int, crime_count long, place string")
    assert answers.pick_measure(schema) == "crime_count"
    assert answers.pick_label(schema) == "place"
    assert answers.pick_measure(T.StructType.fromDDL("a string")) is None
    assert answers.pick_label(T.StructType.fromDDL("id string, n int")) is None


def test_ad_hoc_is_bounded(spark):
    spark.range(1000).createOrReplaceTempView("many")
    assert answers.ad_hoc(spark, "SELECT * FROM many").count() == 200


def test_percent_difference_with_nothing_to_compare(spark):
    df = spark.createDataFrame([("a", 5, 0), ("b", 3, 4)], "k string, x int, y int")
    found = {r.k: (r.pct_diff, r.direction) for r in answers.compare_flags(df, "k", "x", "y").collect()}
    assert found == {"a": (None, None), "b": (-25.0, "lower")}


def test_pivot_fills_missing_cells(spark):
    df = spark.createDataFrame([("on", "a", 3)], "f string, k string, total int")
    assert rows(ct.pivot_flags(df, "k", "f", ["on", "off"])) == [("a", 3, 0)]


def test_labels(spark):
    hours = spark.createDataFrame([(0,), (11,), (12,), (23,)], "h int")
    assert [r[0] for r in hours.select(cal.hour_label(F.col("h"))).collect()] == [
        "12 AM", "11 AM", "12 PM", "11 PM"]
    index = cal.index_of("2019-12")
    one = spark.range(1).select(cal.label_of(F.lit(index)), cal.label_of(F.lit(index + 1)))
    assert tuple(one.first()) == ("2019-12", "2020-01")


def test_routes(spark):
    questions = [
        ("Is crime higher at CHRISTMAS?", "christmas_vs_nonchristmas_by_type", None),
        ("holiday theft", "holiday_vs_nonholiday", "THEFT"),
        ("which hours are worst", "hourly_crimes", None),
        ("Where does theft happen", "theft_by_location", "THEFT"),
        ("where does motor vehicle theft happen", "crimes_by_location", "MOTOR VEHICLE THEFT"),
        ("where", "crimes_by_location", None),
        ("rainfall in winter", "season_crimes", None),
        ("rainfall", None, None),
        ("assault in buses", "transit_vs_commercial_robbery_count", "ASSAULT"),
        (None, None, None),
    ]
    df = spark.createDataFrame([(q,) for q, _, _ in questions], "q string")
    found = df.select(text.route("q"), text.first_contained("q", text.fv.QUESTION_TYPES)).collect()
    assert [tuple(r) for r in found] == [(t, c) for _, t, c in questions]


def test_hash_sample_does_not_depend_on_partitions(spark):
    ids = spark.range(20_000)
    a = rows(ct.hash_sample(ids.repartition(3), "id", 0.1))
    b = rows(ct.hash_sample(ids.coalesce(1), "id", 0.1))
    assert a == b and 1800 < len(a) < 2200
    assert len(rows(ct.hash_sample(ids, "id", 1.0))) == 20_000


def test_77_areas(spark):
    assert area_centroids(spark).count() == 77


def brute_force(points, asked, k):
    found = []
    for q, v in asked:
        gaps = sorted((float(((np.array(p) - np.array(v)) ** 2).sum()), i) for i, p in points)
        found += [(q, r + 1, i, g) for r, (g, i) in enumerate(gaps[:k])]
    return found


def test_nearest_rows_both_ways(spark):
    rng = np.random.default_rng(3)
    points = [(i, [float(x) for x in rng.normal(size=5)]) for i in range(60)]
    # A third of the rows are copies of one vector.
    points += [(100 + i, points[0][1]) for i in range(30)]
    asked = [(i, [float(x) for x in rng.normal(size=5)]) for i in range(9)] + [(9, points[0][1])]
    rows_ = spark.createDataFrame(points, "vec_id long, embedding array<double>").repartition(4)
    queries = spark.createDataFrame(asked, "query_id long, embedding array<double>")
    expected = sorted(brute_force(points, asked, 4))
    for limit in (512, 4):  # queries in one block and in several
        found = vectors.nearest_rows(rows_, queries, 4, queries_per_block=limit, rows_per_block=20)
        got = sorted(tuple(r) for r in found.collect())
        assert [g[:3] for g in got] == [e[:3] for e in expected]
        assert np.allclose([g[3] for g in got], [e[3] for e in expected])


def _clusters(rng, centres, each, dims):
    return [[float(x) for x in centre + rng.normal(size=dims) * 0.01]
            for centre in rng.normal(size=(centres, dims)) for _ in range(each)]


def test_rings_out_of_reach_are_not_read(spark):
    rng = np.random.default_rng(7)
    points = list(enumerate(_clusters(rng, 40, 60, 8)))
    asked = [(i, v) for i, v in points if i % 50 == 0]
    rows_ = spark.createDataFrame(points, "vec_id long, embedding array<double>").repartition(4)
    queries = spark.createDataFrame(asked, "query_id long, embedding array<double>")
    found = vectors.search(rows_, queries, 4, rows_per_block=50, queries_per_block=8)
    got = sorted(tuple(r) for r in found.nearest().collect())
    assert [g[:3] for g in got] == [e[:3] for e in sorted(brute_force(points, asked, 4))]
    assert found.share_read() < 0.5
    text = plan(found.nearest())
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("k", [1, 3, 500])
def test_repeated_ids_and_too_few_rows(spark, k):
    rng = np.random.default_rng(8)
    points = [(i % 30, [float(x) for x in rng.normal(size=3)]) for i in range(70)] + [(5, [0.0, 0.0, 0.0])] * 10
    asked = [(i, [float(x) for x in rng.normal(size=3)]) for i in range(5)] + [(9, [0.0, 0.0, 0.0])]
    rows_ = spark.createDataFrame(points, "vec_id long, embedding array<double>").repartition(3)
    queries = spark.createDataFrame(asked, "query_id long, embedding array<double>")
    got = sorted(tuple(r) for r in vectors.nearest_rows(rows_, queries, k, rows_per_block=7, queries_per_block=2).collect())
    assert [g[:3] for g in got] == [e[:3] for e in sorted(brute_force(points, asked, k))]


def test_tasks_get_no_pairs_of_blocks(spark):
    # Executors ran out of memory when each pair of blocks went to the tasks as one row with the bytes of both.
    rng = np.random.default_rng(9)
    points = [(i, [float(x) for x in rng.normal(size=64)]) for i in range(5000)]
    rows_ = spark.createDataFrame(points, "vec_id long, embedding array<double>").repartition(1)
    found = vectors.search(rows_, rows_.withColumnRenamed("vec_id", "query_id").filter("query_id % 50 = 0"), 4)
    assert found.blocks.selectExpr("max(length(row_points))").first()[0] <= 2 ** 20
    assert found.pairs.count() > 1
    assert not [line for line in plan(found.nearest()).splitlines() if "row_points" in line and "query_points" in line]
    got = sorted(tuple(r) for r in found.nearest().collect())
    matrix = np.array([p for _, p in points])
    expected = [(q, r + 1, int(i)) for q in range(0, 5000, 50)
                for r, i in enumerate(np.argsort(((matrix - matrix[q]) ** 2).sum(axis=1), kind="stable")[:4])]
    assert [g[:3] for g in got] == expected


def test_many_copies_far_and_huge_vectors_in_small_lots(spark, monkeypatch):
    rng = np.random.default_rng(10)
    monkeypatch.setattr(vectors, "LOT", 150)
    monkeypatch.setattr(vectors, "_AT_ONCE", 50)
    # Copies, near copies far from the origin, entries whose squares overflow, and floats.
    points = [(i, [1.0, 2.0, 3.0]) for i in range(40)] + [(40 + i, [1e7 + i % 7 * 2.0 ** -10, 1e7, -1e7]) for i in range(30)]
    points += [(70 + i, [1e19 * (i % 3 + 1), 0.0, float(i)]) for i in range(9)]
    points += [(80 + i, [float(np.float32(x)) for x in rng.normal(size=3)]) for i in range(30)]
    for kind in ("double", "float"):
        single = [(i, [float(np.float32(x)) for x in v]) if kind == "float" else (i, v) for i, v in points]
        single = [(i, [x * 1e160 if x >= 1e18 and kind == "double" else x for x in v]) for i, v in single]
        rows_ = spark.createDataFrame(single, f"vec_id long, embedding array<{kind}>").repartition(3)
        with np.errstate(over="ignore"):
            expected = sorted(brute_force(single, single, 3))
        found = vectors.nearest_rows(rows_, rows_.withColumnRenamed("vec_id", "query_id"), 3, rows_per_block=8, queries_per_block=5)
        assert sorted(tuple(r) for r in found.collect()) == expected


def test_vectors_that_are_not_finite_hide_no_row(spark):
    points = [(0, [float("nan"), 0.0]), (1, [float("inf"), 0.0]), *((i, [float(i), 1.0]) for i in range(2, 40))]
    rows_ = spark.createDataFrame(points, "vec_id long, embedding array<double>").repartition(2)
    queries = spark.createDataFrame([(7, [20.2, 1.0])], "query_id long, embedding array<double>")
    assert [r.vec_id for r in vectors.nearest_rows(rows_, queries, 3, rows_per_block=4).orderBy("rank").collect()] == [20, 21, 19]
