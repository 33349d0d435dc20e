"""Toxicity scores of whole texts by a recurrent network trained on labelled rows."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import gru
from .registry import query, table
from .rows import small_batches

#: Rows of each label the network is fitted to, at most. Which ones is decided by a hash of
#: the id, so the same labels give the same network.
SAMPLE_TOXIC, SAMPLE_CLEAN = 500, 1500
THRESHOLD = 0.3


def held_out(doc_id: str = "doc_id"):
    """True for the quarter of ids kept out of training; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> gru.Network:
    """Network fitted to a bounded sample of the labelled documents outside the held-out quarter.

    Labels other than 0 and 1, null ids and ids without a document are passed over. The level
    comes from the share of label 1 among all training rows. The sample's ids pass the driver;
    its texts go to the one task that fits the network, which is retried like any other.
    """
    used = labels.where("toxic IN (0, 1)").where(~held_out()).select("doc_id", "toxic").join(
        docs.select("doc_id").where("doc_id IS NOT NULL").distinct(), "doc_id")
    counts = {r.toxic: r.n for r in used.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rows = sum(counts.values())
    if not rows:
        return gru.fit([], 0.0)
    picked = [
        used.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        for label, most in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))]
    sample = [(r.doc_id, r.toxic) for r in picked[0].unionByName(picked[1]).collect()]
    ids = docs.sparkSession.createDataFrame(sample, "doc_id long, toxic long")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text")).join(
        F.broadcast(ids), "doc_id").orderBy(F.xxhash64("doc_id"), "text").limit(len(sample))
    share = counts.get(1, 0) / rows

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        given = [(bytes(text), int(toxic)) for b in batches for text, toxic in zip(b["text"], b["toxic"])]
        yield pd.DataFrame({"state": [pickle.dumps(gru.fit(given, share).__getstate__())]})

    network = gru.Network.__new__(gru.Network)
    network.__setstate__(pickle.loads(texts.select("text", "toxic").mapInPandas(fit, "state binary").first().state))
    return network


def with_score(docs: DataFrame, network: gru.Network, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score (0 to 1) of the whole text; null counts as empty."""

    @F.pandas_udf("double")
    def toxicity(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(network.scores(texts.tolist()), dtype="float64")

    return small_batches(docs).withColumn(out, toxicity(F.col(text).cast("binary")))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents with a score under the threshold; null and empty texts are scored like others.

    Repeated rows have equal scores. The columns of ``docs`` come back, whatever their names.
    """
    network = train(docs, labels)
    return with_score(docs, network, out="__score").where(F.col("__score") < threshold).select(*docs.columns)


@query()
def op9_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = with_score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
