"""Whitening of embeddings on the leading components of their covariance, found by spectrum slicing."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civitally.session import cut_lineage

from . import spectrum
from .registry import query, table

COMPONENTS = 16
#: Entries become whole numbers floor(STEP * c) + OFFSET, so that all sums are exact.
STEP, OFFSET = 64, 1_000_000
#: STEP * c is held within this, so that whole numbers and their differences stay longs.
REACH = 2.0 ** 61
#: Sums of products are shipped in two decimals, as a multiple of this and a rest.
_UNIT = 10 ** 30
_LIMB, _ROWS = 20, 2 ** 12
NAMES = ("component", "n", "deviation", "whitened", "explained", "identity_error")


def lattice(vector: str) -> Column:
    """The vector as whole numbers; null where it is null, empty, or has a null or non-finite entry."""
    sound = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    step = F.transform(vector, lambda c: F.floor(F.least(F.greatest(
        c.cast("double") * STEP, F.lit(-REACH)), F.lit(REACH))).cast("long") + OFFSET)
    return F.when(sound & (F.size(vector) > 0), step)


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    lists = batch.column(name)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _add_products(total: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """``total`` plus the exact sum over rows of their outer products; whole numbers of any size.

    Entries are split into limbs of 20 bits, so that the sums over 4,096 rows are exact in doubles.
    """
    for at in range(0, len(rows), _ROWS):
        sign, left = np.sign(rows[at:at + _ROWS]), np.abs(rows[at:at + _ROWS])
        limbs = []
        while not limbs or left.any():
            limbs.append((sign * (left & (2 ** _LIMB - 1))).astype(np.float64))
            left = left >> _LIMB
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total = total + (a.T @ b).astype(np.int64).astype(object) * 2 ** (_LIMB * (i + j))
    return total


class Whitener:
    """Mean, components and eigenvalues of a fit list; all of it is bounded by the vectors' length squared."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray, components: int):
        self.n, self.sums = n, sums
        self.middle = [(2 * s + n) // (2 * n) for s in sums]
        self.trace = float(np.trace(covariance))
        values, self.vectors = spectrum.leading(covariance, components)
        self.values = np.maximum(values, 0.0)
        self.usable = self.values > len(sums) * np.finfo(float).eps * max(self.trace, 0.0)
        self.identity_error = 0.0

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n * x - S of every row, exact: as whole numbers (Python's where longs are too short) and as doubles over n."""
        near = x - np.array(self.middle, dtype=np.int64)
        rest = [self.n * m - s for m, s in zip(self.middle, self.sums)]
        most = (int(np.abs(near).max(initial=0)) + 1) * self.n
        if most * most * x.shape[1] < 2 ** 63:
            exact = near * self.n + np.array(rest, dtype=np.int64)
        else:
            exact = near.astype(object) * self.n + np.array(rest, dtype=object)
        return exact, near + np.array([float(Fraction(r, self.n)) for r in rest])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Usable components of every row, in standard deviations."""
        return self.centred(x)[1] @ self.vectors[self.usable].T / np.sqrt(self.values[self.usable])


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Whitener of the distinct vectors of column ``x`` of the commonest length; None without any.

    Copies are dropped map-side before the shuffle. Sums and products are whole numbers, added up
    exactly in any order; per dimension and pair of dimensions one number a task is shuffled. Products
    are those of x minus the whole number next to the mean, and what the rounding leaves is taken off exactly.
    """
    distinct = cut_lineage(vectors.select("x").distinct())
    lengths = distinct.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if lengths is None:
        return None
    size = lengths["size"]
    listed = distinct.where(F.size("x") == size)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(size, dtype=object)
        for batch in batches:
            x = _matrix(batch, "x")
            n, sums = n + len(x), sums + x.astype(object).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_pydict({
                "i": pa.array(range(size), pa.int32()), "n": pa.array([n] * size, pa.int64()),
                "s": pa.array([Decimal(int(s)) for s in sums], pa.decimal128(38, 0))})

    added = {r.i: r for r in listed.mapInArrow(add_up, "i int, n long, s decimal(38,0)").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s")).collect()}
    n, sums = added[0].n, [int(added[i].s) for i in range(size)]
    middle = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
    upper = np.triu_indices(size)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((size, size), dtype=object), False
        for batch in batches:
            total, seen = _add_products(total, _matrix(batch, "x") - middle), seen or batch.num_rows > 0
        if seen:
            parts = [divmod(int(v), _UNIT) for v in total[upper]]
            yield pa.RecordBatch.from_pydict({
                "i": pa.array(upper[0], pa.int32()), "j": pa.array(upper[1], pa.int32()),
                "high": pa.array([Decimal(h) for h, _ in parts], pa.decimal128(38, 0)),
                "low": pa.array([Decimal(v) for _, v in parts], pa.decimal128(38, 0))})

    products = listed.mapInArrow(multiply, "i int, j int, high decimal(38,0), low decimal(38,0)").groupBy("i", "j").agg(
        F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    covariance, rest = np.zeros((size, size)), [s - n * int(m) for s, m in zip(sums, middle)]
    for r in products:
        exact = Fraction(n * (int(r.high) * _UNIT + int(r.low)) - rest[r.i] * rest[r.j], n * n)
        covariance[r.i, r.j] = covariance[r.j, r.i] = float(exact)
    whitener = Whitener(n, sums, covariance, components)
    whitener.identity_error = _identity_error(listed, whitener)
    return whitener


def _identity_error(listed: DataFrame, whitener: Whitener) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, from the rows themselves."""
    k = int(whitener.usable.sum())
    if not k:
        return 0.0

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second, seen = np.zeros(k), np.zeros((k, k)), False
        for batch in batches:
            z = whitener.whitened(_matrix(batch, "x"))
            first, second, seen = first + z.sum(axis=0), second + z.T @ z, seen or len(z) > 0
        if seen:
            both = np.vstack([first, second])
            yield pa.RecordBatch.from_pydict({
                "i": pa.array(np.repeat(np.arange(k + 1), k), pa.int32()),
                "j": pa.array(np.tile(np.arange(k), k + 1), pa.int32()), "v": pa.array(both.ravel())})

    both = np.zeros((k + 1, k))
    for r in listed.mapInArrow(multiply, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        both[r.i, r.j] = r.v / whitener.n
    return float(np.abs(both[1:] - np.outer(both[0], both[0]) - np.eye(k)).max())


def whiten(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per row of ``df`` and component: its columns but the vector, and NAMES.

    Rows whose vector is null, empty, or holds a null or non-finite entry are dropped, and so are vectors
    of another length than most distinct ones have (ties: the longest). STEP * c beyond 2^61 is held at
    that. Repeated rows and null ids stay, and copies weigh once in the fit. Components are numbered from 1
    by falling eigenvalue, up to the vectors' length; one whose eigenvalue is zero to rounding (fewer
    vectors than dimensions, one vector) has a null ``whitened``. ``deviation`` is exact and null beyond 38
    digits. An empty table gives none. Columns of ``df`` with these names are replaced; ``__`` names are reserved.
    """
    kept = [c for c in df.columns if c not in NAMES and c != vector]
    # By place, because functions over Arrow batches refuse names with dots.
    held = [f"__{k}" for k in range(len(kept))]
    given = df.select(*(F.col(f"`{c}`").alias(h) for c, h in zip(kept, held)), lattice(f"`{vector}`").alias("__x")).where(F.col("__x").isNotNull())
    whitener = fit(given.select(F.col("__x").alias("x")), components)
    schema = T.StructType([*given.select(*held).schema.fields, T.StructField("__deviation", T.DecimalType(38, 0)),
                           T.StructField("__whitened", T.ArrayType(T.DoubleType()))])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, count = _matrix(batch, "__x"), len(whitener.values)
            deviation = (whitener.centred(x)[0] ** 2).sum(axis=1)
            z = np.full((len(x), count), np.nan)
            z[:, whitener.usable] = whitener.whitened(x)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(x) + 1) * count, pa.int32()), pa.array(z.ravel(), from_pandas=True))
            exact = [Decimal(int(d)) if d < 10 ** 38 else None for d in deviation]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(kept))), pa.array(exact, pa.decimal128(38, 0)), lists],
                names=[f.name for f in schema.fields])

    if whitener is None:
        rows = df.sparkSession.createDataFrame([], schema)
        n, share, error = 0, [0.0], 0.0
    else:
        rows = given.where(F.size("__x") == len(whitener.sums)).mapInArrow(project, schema)
        n, error = whitener.n, whitener.identity_error
        share = [float(v / whitener.trace) if whitener.trace > 0 else 0.0 for v in whitener.values]
    return rows.select(*held, F.col("__deviation").alias("deviation"), F.posexplode("__whitened").alias("__at", "whitened")).select(
        *(F.col(h).alias(c) for c, h in zip(kept, held)), (F.col("__at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(F.lit(share), F.col("__at")).alias("explained"), F.lit(error).alias("identity_error"))


@query()
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every embedding."""
    rows = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))
