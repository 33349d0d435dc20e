"""Shards against plain Python, on odd tables and with a hot group."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from civitally.llm import sharding

DOCS = "doc_id long, text string"


def plain(rows, shards):
    """(doc_id, size, shard, slot) by one pass over the sorted rows."""
    def key(text):
        return b"" if text is None else hashlib.md5(text.encode()).digest()

    sized = sorted(((key(t), i is not None, i or 0, i, len((t or "").encode()) + 1) for i, t in rows), key=lambda r: r[:3])
    total, largest, starts, at = sum(r[-1] for r in sized), max((r[-1] for r in sized), default=0), [], 0
    for row in sized:
        starts.append(at)
        at += row[-1]
    spans = {}
    for row, start in zip(sized, starts):
        low, _ = spans.get(row[0], (start, 0))
        spans[row[0]] = (low, start + row[-1])
    cuts = []
    for k in range(1, shards):
        cut = 2 * total * k // shards
        for low, high in spans.values():
            if high - low <= largest and 2 * low < cut < 2 * high:
                cut = 2 * low if cut - 2 * low < 2 * high - cut else 2 * high
                break
        cuts.append(cut)
    out, slots = [], {}
    for row, start in zip(sized, starts):
        shard = sum(c <= 2 * start + row[-1] for c in cuts)
        out.append((row[3], row[-1], shard, slots.get(shard, 0)))
        slots[shard] = slots.get(shard, 0) + 1
    return out


def found(docs, shards):
    dealt = sharding.with_shards(docs, sharding.text_size(), sharding.text_key(), shards=shards)
    return [(r.doc_id, r["size"], r.shard, r.slot) for r in dealt.collect()]


CASES = {
    "copies": [(i, "copy" * (1 + i % 7)) for i in range(300)],
    "hot": [(i, "the same text" if i % 3 else f"text {i} " * (i % 40)) for i in range(600)],
    "equal rows": [(1, "x" * 50)] * 400 + [(None, None), (None, None), (2, ""), (None, "y")],
    "one long": [(i, "z" * (10_000 if i == 5 else 3)) for i in range(20)],
    "few": [(1, "a"), (2, "é\U0001f600"), (3, None)],
    "none": [],
}


@pytest.mark.parametrize("shards", [1, 3, 8])
@pytest.mark.parametrize("name", sorted(CASES))
def test_as_plain_python(spark, name, shards):
    docs = spark.createDataFrame(CASES[name], DOCS).repartition(5)
    assert sorted(found(docs, shards), key=str) == sorted(plain(CASES[name], shards), key=str)


def test_hot_group_is_spread_over_tasks(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("one text for all").alias("text"))
    sized = docs.select("doc_id", F.lit(1).alias("__size"), sharding.text_key().alias("__group"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = [r["count"] for r in sharding._with_places(sized, ["__group", "doc_id"]).groupBy("__part").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) > 4 and max(parts) < 10_000


def test_more_shards_than_parts_and_rows(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    rows = found(docs, 2000)
    assert sorted(rows) == sorted(plain([(i, str(i)) for i in range(100)], 2000))


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a", 7, 8, 9, "g", {"k": 1})],
                                 f"{DOCS}, size int, shard int, slot int, `a.b` string, m map<string,int>")
    row = sharding.with_shards(docs, sharding.text_size(), sharding.text_key()).first()
    assert (row["size"], row.slot, row["a.b"], row.m) == (2, 0, "g", {"k": 1})


def test_written_shards_hold_all_texts(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sharding.write_shards(docs, f"{tmp_path}/shards", 8)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert sorted(docs.collect(), key=str) == sorted(back.select(docs.columns).collect(), key=str)
    sums = [r.s for r in back.groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    largest = back.agg(F.max("size")).first()[0]
    assert len(sums) == 8 and max(sums) - min(sums) <= 2 * largest


def test_checksum(spark):
    found = {r.doc_id: r.text_crc32 for r in sharding.op13_sharding(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert found == {r.doc_id: zlib.crc32((r.text or "").encode()) for r in docs}
