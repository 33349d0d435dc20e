"""Corpus pipeline: toxic, copied and contaminated documents go, personal data is sanitised, sources are mixed.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read
again as the next one's docs. All stages but the last return the columns of ``documents``.
Nulls, repeated rows, empty tables and extra columns are treated as the operators say.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from civitally.llm import decontaminate, mixing, pii, simhash, toxicity
from civitally.llm.registry import QUERIES, table
from civitally.session import delete_at_end, shared_dir


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, trained on the labels of this table, does not reject."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies."""
    return simhash.near_dedup(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked and terms that give it away generalised or removed."""
    return pii.sanitise(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's share of the target says, with domain, tokens and epoch."""
    return mixing.mix(mixing.with_domain(docs), weight=mixing.target_weight())


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("source_mixing", mixing_stage),
]

#: The network and XXH64 fingerprints cannot be expressed in SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what they write is removed when the session ends."""
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    delete_at_end(spark, folder)
    return docs


QUERIES["pipeline"] = run
