"""Exact nearest rows by Euclidean distance, passing over rows that cannot be among them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, shared_table

#: Pivots at most; a cell holds the rows nearest to one of them.
PIVOTS = 64
#: Rows up to which the small sides of the joins are sent to every task.
SMALL = 100_000
#: Numbers in a block and in a lot at most, beyond the first vector and the first block; a task compares two lots.
BLOCK, LOT = 2 ** 17, 2 ** 20
_RESULT = "query_block long, query_id long, vec_id long, distance double"
#: Bounds are widened by this share, for they are rounded.
_SLACK = 1e-9
#: Differences of two vectors that are held at once, and tasks at most for which lots are dealt out.
_AT_ONCE, _TASKS = 2 ** 20, 4096
#: Distances by products worked out at once.
_NEAR = 2 ** 18


def nearest_rows(
    vectors: DataFrame, queries: DataFrame, k: int = 4, *,
    vec_id: str = "vec_id", query_id: str = "query_id", embedding: str = "embedding",
    rows_per_block: int = 20_000, queries_per_block: int = 512,
) -> DataFrame:
    """The k rows nearest to each query: query_id, rank, vec_id, distance (squared L2).

    See ``search``. NULL vectors, vectors with a NULL or an entry that is not finite, and NULL ids are left
    out; vectors of unequal length have no distance.
    """
    return search(vectors, queries, k, vec_id=vec_id, query_id=query_id, embedding=embedding,
                  rows_per_block=rows_per_block, queries_per_block=queries_per_block).nearest()


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 4, *,
    vec_id: str = "vec_id", query_id: str = "query_id", embedding: str = "embedding",
    rows_per_block: int = 20_000, queries_per_block: int = 512,
) -> Search:
    """Rows in cells around pivots, queries in blocks, and the pairs of them that have to be compared.

    The rows of a task are packed by cell, in rings of rising distance from the pivot; a block knows its
    ring. A block of queries first meets one block of rows of its own cell, which gives each query a bound on
    its k-th distance. By the triangle inequality a query at distance d from a pivot has nothing nearer than
    the bound in a ring outside d - bound to d + bound, so only the other blocks of rows are read for it.
    Where rows are spread evenly in many dimensions few rings are passed over and the search compares all.
    Of rows with the same vector only the k with the smallest ids can be among the nearest; the others go first.
    """
    rows, asked = _usable(vectors, vec_id, embedding), _usable(queries, query_id, embedding)
    pivots = _pivots(rows)
    copy = F.row_number().over(Window.partitionBy("embedding").orderBy("id"))
    rows = rows.withColumn("copy", copy).filter(F.col("copy") <= k).drop("copy")
    blocks = shared_table(_packed(rows, pivots, "row", rows_per_block).withColumn(
        "row_block", F.monotonically_increasing_id()), "vectors")
    asked_blocks = shared_table(_packed(asked, pivots, "query", queries_per_block).withColumn(
        "query_block", F.monotonically_increasing_id()), "queries")
    rings = cut_lineage(_lots(blocks, "row"))
    lots = cut_lineage(_lots(asked_blocks, "query"))
    own = lots.select("query_block", "cell", "query_low", "query_high").join(rings, "cell")
    gap = F.abs(F.col("row_low") + F.col("row_high") - F.col("query_low") - F.col("query_high"))
    first = own.groupBy("query_block").agg(
        F.min(F.struct(F.col("row_n") < k, gap, "row_block")).alias("b")).select("query_block", "b.row_block")
    tried = _meet(blocks, asked_blocks, cut_lineage(_dealt(first, rings, lots)), k)
    # A block knows a bound where each of its queries has met k rows.
    last = tried.groupBy("query_block", "query_id").agg(F.count("*").alias("n"), F.max("distance").alias("most"))
    bounds = cut_lineage(last.groupBy("query_block").agg(
        F.max(F.when(F.col("n") >= k, F.col("most")).otherwise(float("inf"))).alias("most")))
    reach = cut_lineage(_reach(asked_blocks, bounds, pivots))
    wide = (F.col("row_low") <= F.col("high")) & (F.col("row_high") >= F.col("low"))
    pairs = reach.join(rings, "cell").where(wide).select("query_block", "row_block")
    return Search(blocks, asked_blocks, rings, cut_lineage(_dealt(pairs, rings, lots)), k)


@dataclass(frozen=True)
class Search:
    """What is to be compared: ``pairs`` of blocks, and the lots they are dealt out in."""

    blocks: DataFrame
    queries: DataFrame
    rings: DataFrame
    pairs: DataFrame
    k: int

    def nearest(self) -> DataFrame:
        met = _meet(self.blocks, self.queries, self.pairs, self.k)
        order = Window.partitionBy("query_id").orderBy("distance", "vec_id")
        ranked = met.withColumn("rank", F.row_number().over(order))
        return ranked.filter(F.col("rank") <= self.k).select("query_id", "rank", "vec_id", "distance")

    def share_read(self) -> float:
        """Share of all pairs of query blocks and rows that is compared."""
        sizes = self.rings.select("row_block", "row_n")
        read = self.pairs.join(sizes, "row_block").agg(F.sum("row_n")).first()[0] or 0
        every = (sizes.agg(F.sum("row_n")).first()[0] or 0) * self.queries.count()
        return read / every if every else 0.0


def _usable(df: DataFrame, key: str, embedding: str) -> DataFrame:
    # NaN is above infinity for Spark. Floats stay floats, which are half as wide on the way to the tasks.
    kept = "array<float>" if df.schema[embedding].dataType == T.ArrayType(T.FloatType()) else "array<double>"
    finite: Column = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return df.select(
        F.col(key).cast("long").alias("id"), F.col(embedding).cast(kept).alias("embedding")
    ).filter(F.col("id").isNotNull() & F.col("embedding").isNotNull() & finite)


def _pivots(rows: DataFrame) -> dict[int, np.ndarray]:
    """Pivots by length of vector: the origin, and the vectors of the ids with the smallest hashes.

    They decide what is passed over, not what is found.
    """
    picked = rows.select("embedding", F.xxhash64("id", "embedding").alias("h")).orderBy("h").limit(PIVOTS).collect()
    found: dict[int, list] = {}
    for row in picked:
        found.setdefault(len(row.embedding), []).append(row.embedding)
    return {width: np.unique(np.array([np.zeros(width), *points]), axis=0) for width, points in found.items()}


def _distances(points: np.ndarray, pivots: dict[int, np.ndarray]) -> np.ndarray:
    """Distance of every point to every pivot of its length."""
    own = pivots.get(points.shape[1], np.zeros((1, points.shape[1])))
    with np.errstate(all="ignore"):
        return np.sqrt(np.stack([((points - p) ** 2).sum(axis=1) for p in own], axis=1))


def _cell(width: int, pivot: int) -> int:
    return width * (PIVOTS + 1) + pivot


def _packed(df: DataFrame, pivots: dict[int, np.ndarray], side: str, most: int) -> DataFrame:
    """Blocks of at most ``most`` vectors (and BLOCK numbers) of one cell, in rising distance from its pivot, from the rows of one task.

    Vectors so long that their distance overflows go to the origin's cell, in a ring that no bound excludes.
    """
    schema = (f"cell long, {side}_ids binary, {side}_width int, {side}_points binary, {side}_n long, "
              f"{side}_low double, {side}_high double")

    kind = "float32" if df.schema["embedding"].dataType.elementType == T.FloatType() else "float64"

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for width, same in batch.groupby(batch["embedding"].map(len)):
                points = np.stack(same["embedding"].to_numpy()).astype(kind).reshape(len(same), width)
                ids, far = same["id"].to_numpy("int64"), _distances(points.astype("float64"), pivots)
                held = max(1, min(most, BLOCK // max(width, 1)))
                sound = np.isfinite(far).all(axis=1)
                near = np.where(sound, np.argmin(np.where(np.isfinite(far), far, np.inf), axis=1), 0)
                away = np.where(sound, far[np.arange(len(far)), near], np.inf)
                order = np.lexsort((away, near, ~sound))
                groups = np.flatnonzero(np.diff(near[order]) | np.diff(sound[order])) + 1
                for start, stop in pairwise([0, *groups.tolist(), len(order)]):
                    for at in range(start, stop, held):
                        part = order[at:min(at + held, stop)]
                        whole = sound[part[0]]
                        yield pd.DataFrame({
                            "cell": [_cell(width, near[part[0]])], f"{side}_ids": [ids[part].tobytes()],
                            f"{side}_width": [width], f"{side}_points": [points[part].tobytes()], f"{side}_n": [len(part)],
                            f"{side}_low": [away[part].min() if whole else -np.inf],
                            f"{side}_high": [away[part].max() if whole else np.inf]})

    return df.mapInPandas(pack, schema)


def _points(ids: bytes, width: int, points: bytes) -> tuple[np.ndarray, np.ndarray]:
    keys = np.frombuffer(ids, "int64")
    kind = "float32" if len(points) == 4 * len(keys) * width else "float64"
    return keys, np.frombuffer(points, kind).reshape(len(keys), width).astype("float64")


def _reach(asked: DataFrame, bounds: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Per block of queries and cell of their length: the least and largest distance from the pivot to look at."""

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block in batch.itertuples(index=False):
                far = _distances(_points(block.query_ids, block.query_width, block.query_points)[1], pivots)
                reach = np.sqrt(block.most) * (1 + _SLACK)
                low, high = far.min(axis=0) * (1 - _SLACK) - reach, far.max(axis=0) * (1 + _SLACK) + reach
                yield pd.DataFrame({
                    "query_block": block.query_block,
                    "cell": [_cell(block.query_width, i) for i in range(far.shape[1])],
                    "low": np.where(np.isnan(low), -np.inf, low), "high": np.where(np.isnan(high), np.inf, high)})

    # A block that has not met k rows may find them anywhere.
    joined = asked.join(_few(bounds), "query_block", "left").select(
        "query_block", "query_ids", "query_width", "query_points", F.coalesce("most", F.lit(float("inf"))).alias("most"))
    return joined.mapInPandas(spread, "query_block long, cell long, low double, high double")


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def _lots(blocks: DataFrame, side: str) -> DataFrame:
    """What is known of the blocks beside their vectors, and their ``lot``: neighbours by cell and ring, LOT numbers or so.

    Sums run within a cell and go on from the totals of the cells before it.
    """
    facts = blocks.select(f"{side}_block", "cell", f"{side}_low", f"{side}_high", f"{side}_n",
                          (F.col(f"{side}_n") * (F.col(f"{side}_width") + 1)).alias("size"))
    cells = facts.groupBy("cell").agg(F.sum("size").alias("total"))
    cells = cells.withColumn("before", F.sum("total").over(Window.orderBy("cell")) - F.col("total")).drop("total")
    inside = F.sum("size").over(Window.partitionBy("cell").orderBy(f"{side}_low", f"{side}_block")) - F.col("size")
    lot = F.floor((F.col("inside") + F.col("before")) / LOT).alias(f"{side}_lot")
    return facts.withColumn("inside", inside).join(F.broadcast(cells), "cell").drop("size").select(
        f"{side}_block", "cell", f"{side}_low", f"{side}_high", f"{side}_n", lot)


def _dealt(pairs: DataFrame, rings: DataFrame, lots: DataFrame) -> DataFrame:
    return pairs.join(_few(rings.select("row_block", "row_lot")), "row_block").join(
        _few(lots.select("query_block", "query_lot")), "query_block")


def _meet(blocks: DataFrame, asked: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """The k nearest of the rows in each pair of lots, per query: _RESULT.

    A block goes once to each lot of the other side it meets there, whatever the number of blocks in that lot. A task reads
    the blocks of queries of a lot, then one block of rows after the other, and keeps the k best of each query.
    """
    lots = ["query_lot", "row_lot"]
    wanted = pairs.groupBy("row_block", *lots).agg(F.collect_list("query_block").alias("wanted"))
    few = F.broadcast if pairs.limit(SMALL + 1).count() <= SMALL else lambda df: df
    rows = blocks.join(few(wanted), "row_block").select(
        *lots, F.lit(1).alias("side"), F.col("row_block").alias("block"), F.col("row_width").alias("width"),
        F.col("row_ids").alias("ids"), F.col("row_points").alias("points"), "wanted")
    queries = asked.join(few(pairs.select("query_block", *lots).distinct()), "query_block").select(
        *lots, F.lit(0).alias("side"), F.col("query_block").alias("block"), F.col("query_width").alias("width"),
        F.col("query_ids").alias("ids"), F.col("query_points").alias("points"), F.lit(None).cast("array<long>").alias("wanted"))
    # Several partitions for each pair of lots, so that few meet in one by chance.
    n = min(4 * max(pairs.select(*lots).distinct().count(), 1), _TASKS)
    records = queries.unionByName(rows).repartition(n, *lots).sortWithinPartitions(*lots, "side")
    return records.mapInPandas(_searcher(k), _RESULT)


def _searcher(k: int):
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lots, asked = None, {}
        for batch in batches:
            for record in batch.itertuples(index=False):
                if (record.query_lot, record.row_lot) != lots:
                    yield from (nearest.found() for nearest in asked.values())
                    lots, asked = (record.query_lot, record.row_lot), {}
                keys, points = _points(record.ids, record.width, record.points)
                if record.side == 0:
                    asked[record.block] = _Nearest(record.block, keys, points, k)
                else:
                    lengths = _lengths(points)
                    for block in record.wanted:
                        asked[block].meet(keys, points, lengths)
        yield from (nearest.found() for nearest in asked.values())

    return find


def _lengths(points: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        return (points * points).sum(axis=1)


class _Nearest:
    """The k nearest rows met so far, for each query of a block."""

    def __init__(self, block: int, ids: np.ndarray, points: np.ndarray, k: int):
        self.block, self.ids, self.points, self.k = block, ids, points, k
        self.lengths = _lengths(points)
        with np.errstate(all="ignore"):
            # Beside -2 x stand |x|^2 and 1, so that one product with y, 1 and |y|^2 is a distance.
            self.left = np.column_stack([-2 * points, self.lengths, np.ones(len(ids))])
        self.query, self.keys = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.gaps, self.bound = np.zeros(0), np.full(len(ids), np.inf)

    def meet(self, keys: np.ndarray, rows: np.ndarray, lengths: np.ndarray) -> None:
        """All rows of a block, so many at a time that their distances stay near the processor."""
        step = max(1, _NEAR // len(self.ids))
        for at in range(0, len(keys), step):
            self._meet(keys[at:at + step], rows[at:at + step], lengths[at:at + step])

    def _meet(self, keys: np.ndarray, rows: np.ndarray, lengths: np.ndarray) -> None:
        """Rows whose distance by products cannot be under the bound, whatever was rounded, are not measured.

        A query for which many are left is held to the k-th of the distances by products. What overflows is measured.
        """
        with np.errstate(all="ignore"):
            rough = self.left @ np.column_stack([rows, np.ones(len(keys)), lengths]).T
            wrong = 8 * (rows.shape[1] + 8) * np.finfo(float).eps * (self.lengths + lengths.max()) + 1e-290
            near = ~(rough > (self.bound + wrong)[:, None])
            query, row = np.divmod(np.flatnonzero(near), len(keys))
            many = np.flatnonzero(np.bincount(query, minlength=len(self.ids)) > 4 * self.k + 16)
            if len(many) and len(keys) > self.k:
                least = np.partition(rough[many], self.k - 1, axis=1)[:, self.k - 1]
                near[many] &= ~(rough[many] > (least + 2 * wrong[many])[:, None])
                query, row = np.divmod(np.flatnonzero(near), len(keys))
        step = max(1, _AT_ONCE // max(rows.shape[1], 1))
        for at in range(0, len(query), step):
            q, r = query[at:at + step], row[at:at + step]
            self._keep(q, keys[r], _gaps(self.points[q], rows[r]))

    def _keep(self, query: np.ndarray, keys: np.ndarray, gaps: np.ndarray) -> None:
        """The rows under the bound go among those of their queries, of which the k best stay."""
        under = gaps <= self.bound[query]
        touched = np.zeros(len(self.ids), bool)
        touched[query[under]] = True
        own = touched[self.query]
        held = self.query, self.keys, self.gaps
        query, keys, gaps = (np.concatenate((old[own], new[under])) for old, new in zip(held, (query, keys, gaps)))
        order = np.lexsort((keys, gaps, query))
        query, keys, gaps = query[order], keys[order], gaps[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        best, full = rank < self.k, rank == self.k - 1
        self.query, self.keys, self.gaps = (
            np.concatenate((old[~own], new[best])) for old, new in zip(held, (query, keys, gaps)))
        self.bound[query[full]] = gaps[full]

    def found(self) -> pd.DataFrame:
        return pd.DataFrame({"query_block": self.block, "query_id": self.ids[self.query], "vec_id": self.keys,
                             "distance": self.gaps})


def _gaps(points: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Squared distances, added up dimension by dimension as SQL does."""
    with np.errstate(all="ignore"):
        apart = points - rows
        return np.add.accumulate(apart * apart, axis=1)[:, -1] if apart.shape[1] else np.zeros(len(apart))
