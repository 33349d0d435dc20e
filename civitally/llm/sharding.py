"""Contiguous shards of equal bytes, cut from global prefix sums of row sizes."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civitally.session import cut_lineage

from .registry import query, table

SHARDS = 8
_FAR = 2 ** 62


def text_size(text: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus one for its end."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 1


def text_key(text: str = "text") -> Column:
    """Key of equal texts, 16 bytes of no order of its own; null texts share the empty key."""
    return F.coalesce(F.unhex(F.md5(F.col(text).cast("binary"))), F.lit(b""))


def _with_places(sized: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows in global order with ``__part`` and, counted from the start of the part, ``__bytes`` and ``__rows`` before.

    Every part is a range of the order, sorted and numbered as a stream. Rows equal in all of
    ``order`` are told apart by where they were read, so that any number of copies is split.
    """
    ordered = sized.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(
        *order, "__tie").sortWithinPartitions(*order, "__tie").drop("__tie")
    ordered = ordered.withColumn("__part", F.spark_partition_id())
    schema = T.StructType([*ordered.schema.fields, T.StructField("__bytes", T.LongType()), T.StructField("__rows", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = rows = 0
        for batch in batches:
            ends = np.cumsum(batch.column("__size").to_numpy(zero_copy_only=False), dtype=np.int64) + size
            before = np.concatenate(([size], ends))[:-1] if len(ends) else ends
            yield batch.append_column("__bytes", pa.array(before, pa.int64())).append_column(
                "__rows", pa.array(np.arange(rows, rows + len(ends), dtype=np.int64)))
            size, rows = int(ends[-1]) if len(ends) else size, rows + len(ends)

    return cut_lineage(ordered.mapInArrow(number, schema))


class _Parts:
    """Totals of the parts, one each per shuffle partition, and columns that look them up by ``__part``."""

    def __init__(self, placed: DataFrame):
        found = placed.groupBy("__part").agg(
            F.sum("__size").alias("size"), F.count("*").alias("n"), F.max("__size").alias("most")).collect()
        by_part = {p["__part"]: p for p in found}
        self.largest = max((p["most"] for p in found), default=0)
        self.bytes, self.rows = [0], [0]
        for k in range(max(by_part, default=-1) + 1):
            self.bytes.append(self.bytes[-1] + (by_part[k]["size"] if k in by_part else 0))
            self.rows.append(self.rows[-1] + (by_part[k]["n"] if k in by_part else 0))
        self.total = self.bytes[-1]

    def start(self) -> Column:
        return F.get(F.lit(self.bytes), F.col("__part")) + F.col("__bytes")

    def row(self) -> Column:
        return F.get(F.lit(self.rows), F.col("__part")) + F.col("__rows")

    def inside(self, positions: Sequence[int]) -> Column:
        """The doubled byte positions that lie in the part of the row; the last entry is out of reach."""
        lists = [[] for _ in self.bytes]
        for position in positions:
            lists[max(bisect_right(self.bytes, position // 2) - 1, 0)].append(position)
        return F.get(F.lit([[*held, _FAR] for held in lists]), F.col("__part"))

    def passed(self, positions: Sequence[int]) -> Column:
        """How many of the ascending doubled positions lie before the part."""
        return F.get(F.lit([bisect_left(positions, 2 * b) for b in self.bytes]), F.col("__part"))


def _cuts(placed: DataFrame, parts: _Parts, shards: int) -> list[int]:
    """Doubled byte positions between shards, ascending.

    A cut lies at an equal target. One that falls inside a group of no more bytes than the largest
    row moves to the group's nearer edge. Only the groups met by a target are looked at, one a shard at most.
    """
    targets = [2 * parts.total * k // shards for k in range(1, shards)]
    rows = placed.select("__group", "__size", "__part", parts.start().alias("start"))
    met = F.exists(parts.inside(targets), lambda t: (t > 2 * F.col("start")) & (t < 2 * (F.col("start") + F.col("__size"))))
    # Between two rows of a group a target is in neither; so the row that begins there counts too.
    at_start = F.exists(parts.inside(targets), lambda t: t == 2 * F.col("start"))
    hit = rows.where(met | at_start).select("__group").distinct()
    spans = rows.join(F.broadcast(hit), "__group").groupBy("__group").agg(
        F.min("start").alias("low"), F.max(F.col("start") + F.col("__size")).alias("high")).collect()
    small = sorted((2 * s.low, 2 * s.high) for s in spans if s.high - s.low <= parts.largest)
    out = []
    for target in targets:
        low, high = small[max(bisect_right(small, (target, _FAR)) - 1, 0)] if small else (target, target)
        out.append((low if target - low < high - target else high) if low < target < high else target)
    return out


def with_shards(df: DataFrame, size: Column, group: Column, order: Sequence[str] = ("doc_id",),
                shards: int = SHARDS) -> DataFrame:
    """``df`` with ``size``, ``shard`` (from 0) and ``slot`` (place in the shard, from 0 without gaps).

    Rows are ordered by ``group``, then by ``order``, and cut where the running sum of ``size`` (1 at
    least, null: 1) passes equal shares; a row on a cut goes where its middle lies. So no cut is off its
    target by more than the largest row, and rows of one group stand side by side: in one shard, unless
    the group is larger than the largest row and a share ends in it. One total per shuffle partition and one
    span and count per shard come to the driver, nothing else. Null and repeated ids keep all their rows;
    equal rows share out the slots among them. More shards than rows leave some empty; an empty table
    stays empty. Columns of ``df`` named size, shard or slot are replaced; ``__`` names are reserved.
    """
    kept = [c for c in df.columns if c not in ("size", "shard", "slot")]
    sized = df.withColumns({"__size": F.greatest(F.coalesce(size, F.lit(1)), F.lit(1)).cast("long"), "__group": group})
    # By place, because functions over Arrow batches refuse names with dots.
    held = [f"__{k}" for k in range(len(kept))]
    placed = _with_places(sized.select(*(F.col(f"`{c}`").alias(h) for c, h in zip(kept, held)), "__size", "__group", *(
        F.col(f"`{c}`").alias(f"__by_{k}") for k, c in enumerate(order))), [
            "__group", *(f"__by_{k}" for k in range(len(order)))])
    parts = _Parts(placed)
    cuts = _cuts(placed, parts, shards)
    middle = 2 * parts.start() + F.col("__size")
    shard = parts.passed(cuts) + F.size(F.filter(parts.inside(cuts), lambda c: c <= middle))
    dealt = placed.withColumns({"__shard": shard.cast("int"), "__row": parts.row()})
    # A shard is a range of the order, so what stands before it is the number of rows in smaller shards.
    counts = {r["__shard"]: r.n for r in dealt.groupBy("__shard").agg(F.count("*").alias("n")).collect()}
    firsts = list(accumulate((counts.get(k, 0) for k in range(shards)), initial=0))
    return dealt.select(*(F.col(h).alias(c) for c, h in zip(kept, held)), F.col("__size").alias("size"), F.col("__shard").alias("shard"),
                        (F.col("__row") - F.get(F.lit(firsts), F.col("__shard"))).cast("long").alias("slot"))


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, text: str = "text") -> None:
    """Whole documents as Parquet under ``folder``, one subfolder a shard, in slot order inside each file."""
    dealt = with_shards(docs, text_size(text), text_key(text), ("doc_id",), shards)
    dealt.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)


#: The checksum goes over the bytes as hexadecimal pairs, with the polynomial's table built from its rule.
_SQL = """
WITH RECURSIVE bits AS (SELECT i, 0 AS k, i::UBIGINT AS c FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
d AS (SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 1 AS size, coalesce(md5(text), '') AS key,
  hex(encode(coalesce(text, ''))) AS h FROM documents),
o AS (SELECT *, sum(size) OVER (ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS low,
  row_number() OVER (ORDER BY key, doc_id) AS place FROM d),
spans AS (SELECT 2 * min(low) AS low, 2 * max(low + size) AS high FROM o GROUP BY key
  HAVING max(low + size) - min(low) <= (SELECT max(size) FROM d)),
targets AS (SELECT (2 * (SELECT sum(size) FROM d) * k) // 8 AS t FROM range(1, 8) r(k)),
cuts AS (SELECT coalesce(CASE WHEN t - low < high - t THEN low ELSE high END, t) AS c
  FROM targets LEFT JOIN spans ON low < t AND t < high),
s AS (SELECT *, (SELECT count(*) FROM cuts WHERE c <= 2 * low + size) AS shard FROM o)
SELECT doc_id, size::BIGINT AS size, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, size), lambda i:
    ('0x' || substr(h, 2 * i - 1, 2))::UBIGINT)), lambda c, b: xor(c >> 8, t[((xor(c, b) & 255) + 1)::INT])),
    4294967295::UBIGINT)::BIGINT AS text_crc32,
  'bytes' AS law, shard::INT AS shard, row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot, NULL::INT AS grown_shard
FROM s, crc
"""


@query(_SQL)
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, by bytes."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", text_size().alias("size"), text_key().alias("key"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    dealt = with_shards(docs.withColumnRenamed("size", "bytes"), F.col("bytes"), F.col("key"))
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))
