"""Whitening against plain numpy and exact arithmetic, and spectrum slicing on hard matrices."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from civitally.llm import spectrum, whitening

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, components=16):
    """vec_id -> (n, deviation, whitened) and shares, by whole vectors in memory."""
    sound = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows
             if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in sound})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    exact = [[Fraction(n * a - s, n) for a, s in zip(x, sums)] for x in fit]
    centred = np.array(exact, dtype=float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors.T[::-1][:components]
    out = []
    for i, x in sound:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        row = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)])
        out.append((i, n, deviation, vectors @ row / np.sqrt(np.maximum(values, 1e-300))))
    return out, values / values.sum() if components >= len(sums) else values / np.trace(centred.T @ centred / n)


def by_row(df):
    found = {}
    for r in df.collect():
        found.setdefault((r.vec_id, r.n, int(r.deviation)), {}).setdefault(r.component, []).append(r)
    return found


def test_table_as_plain_numpy(spark):
    source = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in source.collect()]
    expected, shares = plain(rows)
    found = by_row(whitening.op11_embedding_whitening(spark, "/root/testdata/sf0.001"))
    assert len(found) == len(expected)
    table = np.array([[found[i, n, d][k][0].whitened for k in range(1, 17)] for i, n, d, _ in expected])
    wanted = np.array([w for *_, w in expected])
    signs = np.sign((table * wanted).sum(axis=0))
    assert np.abs(table * signs - wanted).max() < 1e-6
    first = next(iter(found.values()))
    assert np.allclose([first[k][0].explained for k in range(1, 17)], shares, rtol=1e-9)
    assert first[1][0].identity_error < 1e-9


def test_odd_rows(spark):
    good = [[0.5, -1.25, 3.0], [0.0, 0.0, 1.0], [2.0, 1.0, -1.0], [1.5, 0.25, 0.125], [1.0, 1.0, 1.0]]
    rows = [(i, v) for i, v in enumerate(good)] + [
        (0, good[0]), (None, good[0]), (7, None), (8, []), (9, [1.0, None, 2.0]), (10, [1.0, float("nan"), 2.0]),
        (11, [float("inf"), 0.0, 0.0]), (12, [1.0, 2.0]), (13, [0.505, -1.25, 3.0])]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(4))
    expected, shares = plain([r for r in rows if r[0] != 12])
    groups = by_row(found)
    # The copies of vector 0 and the one that is equal to it on the lattice count once.
    assert {k[1] for k in groups} == {5} and sum(len(r) for g in groups.values() for r in g.values()) == 3 * len(expected)
    for i, n, deviation, wanted in expected:
        got = groups[i, n, deviation]
        assert np.allclose(np.abs([got[k][0].whitened for k in (1, 2, 3)]), np.abs(wanted), atol=1e-9)


@pytest.mark.parametrize("rows, null", [
    ([(1, [1.0, 2.0])], 2), ([(1, [0.0, 1.0, 5.0]), (2, [1.0, 0.0, 5.0])], 2 * 2), ([(1, [3.0])] * 5, 5)])
def test_too_few_vectors(spark, rows, null):
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == sum(len(v) for _, v in rows) and sum(r.whitened is None for r in found) == null
    assert all(r.identity_error < 1e-9 for r in found)


def test_empty_and_no_sound_vector(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], SCHEMA)).collect() == []


def test_huge_entries_stay_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.integers(-2 ** 50, 2 ** 50, 4)]) for i in range(40)] + [(99, [1e300, 0.0, 0.0, 0.0])]
    docs = spark.createDataFrame(rows[:-1], "vec_id long, embedding array<double>")
    exact = {i: d for i, _, d, _ in plain_double(rows[:-1])}
    assert {r.vec_id: int(r.deviation) for r in whitening.whiten(docs).collect()} == exact
    assert whitening.whiten(spark.createDataFrame(rows, docs.schema)).where("vec_id = 99").count() == 4


def plain_double(rows):
    sound = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows]
    n, sums = len(sound), [sum(c) for c in zip(*(x for _, x in sound))]
    return [(i, n, sum((n * a - s) ** 2 for a, s in zip(x, sums)), None) for i, x in sound]


def test_clashing_columns(spark):
    row = (1, [1.0, 2.0], 5, 6.0, 7, {"k": 1}, "t")
    docs = spark.createDataFrame([row, (2, [2.0, 1.0], *row[2:])],
                                 SCHEMA + ", n int, whitened double, x int, m map<string,int>, `a.b` string")
    found = whitening.whiten(docs).collect()
    assert len(found) == 4 and all((r.n, r.x, r.m, r["a.b"]) == (2, 7, {"k": 1}, "t") for r in found)


def test_products_are_exact():
    rng = np.random.default_rng(1)
    for top in (10, 2 ** 21, 2 ** 45, 2 ** 61):
        rows = rng.integers(-top, top, (5000, 3))
        exact = rows.astype(object).T @ rows.astype(object)
        assert (whitening._add_products(np.zeros((3, 3), dtype=object), rows) == exact).all()


def _matrices():
    rng = np.random.default_rng(5)
    basis, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    yield "random", np.cov(rng.standard_normal((200, 30)).T)
    yield "identity", 3 * np.eye(20)
    yield "zero", np.zeros((6, 6))
    yield "ones", np.ones((25, 25))
    yield "groups", basis @ np.diag([5.0] * 3 + [4.0] * 2 + [1.0] * 35) @ basis.T
    yield "close", basis @ np.diag(np.concatenate([1 + 1e-9 * np.arange(20), 1e-6 * np.arange(20)])) @ basis.T
    yield "graded", basis @ np.diag(10.0 ** -np.arange(40)) @ basis.T
    yield "one", np.array([[2.0]])


@pytest.mark.parametrize("name, matrix", list(_matrices()), ids=lambda v: v if isinstance(v, str) else "")
def test_leading_pairs(name, matrix):
    matrix = (matrix + matrix.T) / 2
    values, vectors = spectrum.leading(matrix, 16)
    wanted = np.linalg.eigvalsh(matrix)[::-1][:16]
    scale = max(np.abs(wanted).max(), 1e-300)
    assert np.abs(values - wanted).max() < 1e-12 * scale
    assert np.abs(vectors @ vectors.T - np.eye(len(vectors))).max() < 1e-12
    assert np.abs(matrix @ vectors.T - vectors.T * values).max() < 1e-12 * scale


def test_counts_by_inertia():
    rng = np.random.default_rng(2)
    for _ in range(300):
        matrix = rng.integers(-3, 4, (9, 9)).astype(float)
        matrix = matrix + matrix.T
        shift = rng.normal() * 5
        assert spectrum.count_above(matrix, shift) == (np.linalg.eigvalsh(matrix) > shift).sum()


def test_copies_do_not_move_the_fit(spark):
    base = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").limit(60)
    copies = base.where("vec_id = 0").crossJoin(spark.range(2000)).select("vec_id", "embedding")
    one = base.unionByName(copies)
    values = [{(r.vec_id, r.component): r.whitened for r in whitening.whiten(d).where(F.col("vec_id") > 0).collect()}
              for d in (base, one)]
    assert values[0] == pytest.approx(values[1], abs=1e-9)
