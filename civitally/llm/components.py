"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civitally.session import cut_lineage


def _large_star(links: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def roots(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Smallest reachable node ``root`` of every ``node`` that has a link (a, b), itself left out.

    Only minima and links move: no neighbourhood is gathered, and a node with very many
    links is an ordinary skewed join. Every round is written to the shared folder, so a
    lost executor costs at most one round.
    """
    links = links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = cut_lineage(links)
    before = _state(links)
    for _ in range(most_rounds):
        links = cut_lineage(_small_star(_large_star(links)))
        now = _state(links)
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
