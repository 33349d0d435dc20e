"""Host verdicts by an empirical beta prior."""

from __future__ import annotations

import random
import statistics

import pytest

from civitally.llm import hosts

GOOD = "these are enough words for a document of this host to be kept whole"
BAD = "short one"


def _docs(spark, counts):
    """One host per (documents, failing ones)."""
    rows = [(len(counts) * k + h, BAD if k < bad else GOOD, f"h{h}") for h, (n, bad) in enumerate(counts) for k in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def plain_rates(counts):
    mean = sum(b for _, b in counts) / sum(n for n, _ in counts)
    raw = statistics.variance([b / n for n, b in counts])
    spread = raw - statistics.mean([mean * (1 - mean) / n for n, _ in counts])
    strength = mean * (1 - mean) / spread - 1 if 0 < spread < mean * (1 - mean) else 20.0
    return [(b + strength * mean) / (n + strength) for n, b in counts]


def test_a_bad_host_is_refused_and_a_small_one_spared(spark):
    counts = [(200, 10 + h % 12) for h in range(60)] + [(200, 190), (2, 2)]
    found = {r.host: r for r in hosts.judge(_docs(spark, counts)).groupBy("host", "host_rate").agg({"kept": "count"}).collect()}
    for h, rate in enumerate(plain_rates(counts)):
        assert found[f"h{h}"].host_rate == pytest.approx(rate, abs=2e-6)
    judged = hosts.judge(_docs(spark, counts))
    refused = {r.host for r in judged.where("NOT kept AND NOT base_failed").select("host").distinct().collect()}
    assert refused == {"h60"}
    # Both documents of the small host fail themselves, but a good third one would be kept.
    more = _docs(spark, [*counts[:-1], (3, 2)])
    kept = {r.host for r in hosts.judge(more).where("kept").select("host").distinct().collect()}
    assert "h61" in kept and "h60" not in kept


def test_chance_alone_is_no_difference(spark):
    rnd = random.Random(1)
    counts = [(8, sum(rnd.random() < 0.3 for _ in range(8))) for _ in range(300)]
    rates = {r.host_rate for r in hosts.judge(_docs(spark, counts)).select("host_rate").distinct().collect()}
    # Raw rates go from 0 to 0.75 or more; what counting explains is no spread of the hosts.
    assert max(b / n for n, b in counts) >= 0.75 and max(rates) - min(rates) < 0.35
    assert sorted(rates) == pytest.approx(sorted({round(r, 6) for r in plain_rates(counts)}), abs=2e-6)


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, GOOD, "a", 5, 6, True, 0.5)], "doc_id long, text string, source string, n_words int, host int, kept boolean, host_rate double")
    row = hosts.judge(docs).first()
    assert (row.n_words, row.host, row.kept) == (14, "a", True)
