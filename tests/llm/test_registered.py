"""Queries of the subpackage that have SQL, and what every operator makes of odd tables."""

from __future__ import annotations

import random

import pytest

from civitally.llm import chat, decontaminate, hosts, licenses, mixing, pii, simhash, toxicity, urls, warc
from civitally.llm.queries import QUERIES, SQL

from ..compare import connect, differences, duckdb_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    found = spark_rows(QUERIES[name](spark, SF_DIR))
    assert differences(found, duckdb_rows(connect(SF_DIR), SQL[name])) is None


def _odd_docs(spark, extra=""):
    rnd = random.Random(1)
    long = " ".join(rnd.choice("ab cd ef gh ij kl".split()) for _ in range(60_000))
    rows = [(1, None, None, None, None), (None, "a b", "en", "s1", 3), (None, None, None, None, None),
            (2, "", "en", "s1", 0), (2, "", "en", "s1", 0), (3, long, "en", "s2", len(long)),
            (3, "other text of the same id", "de", "s2", 1), (-4, " \t\n\x0b\x0c\r", "", "", 6), (5, "é\u00a0ü\U0001f600 x", "fr", "s", 5)]
    return spark.createDataFrame(rows, DOCS)


LABELS = "doc_id long, quality int, toxic int"
OPERATORS = {
    "pii": lambda s, d: pii.sanitise(d),
    "spans": lambda s, d: pii.with_spans(d),
    "decontaminate": lambda s, d: decontaminate.decontaminate(
        d, s.createDataFrame([(1, None), (None, "x y"), (2, "one two three four five six")], "item_id long, text string")),
    "no benchmark": lambda s, d: decontaminate.decontaminate(d, s.createDataFrame([], "item_id long, text string")),
    "near_dedup": lambda s, d: simhash.near_dedup(d),
    "components": lambda s, d: simhash.components(simhash.with_fingerprint(d, 3)),
    "licenses": lambda s, d: licenses.with_licenses(d),
    "mix": lambda s, d: mixing.mix(d, ("lang", "source")),
    "judge": lambda s, d: hosts.judge(d),
    "toxicity": lambda s, d: toxicity.drop_toxic(d, s.createDataFrame([], LABELS)),
    "one class": lambda s, d: toxicity.drop_toxic(d, s.createDataFrame([(3, 1, 0), (None, 1, 1), (5, None, None)], LABELS)),
}
ROWS = {"pii": 9, "spans": 9, "decontaminate": 9, "no benchmark": 9, "components": 9, "licenses": 9, "judge": 9,
        "toxicity": 9, "one class": 9}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_documents(spark, name):
    rows = OPERATORS[name](spark, _odd_docs(spark)).collect()
    assert len(rows) == ROWS.get(name, len(rows))


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, spark.createDataFrame([], DOCS)).collect() == []


CLASHING = ("score", "marks", "fp", "start", "end", "kind", "words", "grams", "host", "label", "tokens", "epoch", "root",
            "spaced", "row_key_a", "prints", "id", "part", "budget", "term", "item_id", "m", "places", "p", "h", "n_words")


@pytest.mark.parametrize("name", sorted(set(OPERATORS) - {"no benchmark", "one class", "judge", "components"}))
def test_clashing_columns(spark, name):
    docs = spark.createDataFrame([(1, "one two three four five six", "en", "s1", 27, *range(len(CLASHING)))],
                                 DOCS + "".join(f", {c} int" for c in CLASHING))
    found = OPERATORS[name](spark, docs)
    assert set(docs.columns) <= set(found.columns)
    kept = {c: i for i, c in enumerate(CLASHING)} if name in ("pii", "near_dedup", "toxicity") else {}
    for row in found.collect():
        assert all(row[c] == i for c, i in kept.items())


def test_odd_turns(spark):
    rows = [(1, 0, None, None), (1, None, "user", "x"), (None, 0, "user", "y"), (None, 0, "user", "y"),
            (2 ** 60 + 1, 1, "assistant", "z" * 100_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat.read_back(chat.format_turns(turns)).collect()}
    assert {k: r.n_turns for k, r in found.items()} == {1: 2, None: 2, 2 ** 60 + 1: 1}
    assert found[2 ** 60 + 1].loss_chars == 100_000 and not any(r.valid for r in found.values())
    assert chat.read_back(chat.format_turns(turns.limit(0))).collect() == []


def test_odd_pages(spark, tmp_path):
    rows = [(1, None, None), (2, "", ""), (2, "", ""), (None, "http://a b/ c", "é\r\n\r\nWARC/1.1"),
            (2 ** 60 + 1, "x://é?q", "é\r\n\r\nWARC/1.1"), (7, "http://h/", "q" * 500_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.archive_pages(pages, f"{tmp_path}/w")
    found = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.read_warc(
        spark, f"{tmp_path}/w").collect()), key=str)
    assert found == sorted([
        (1, 0, "revisit", 2), (2, 0, "response", None), (2, 0, "response", None), (None, 14, "revisit", 2 ** 60 + 1),
        (2 ** 60 + 1, 14, "response", None), (7, 500_000, "response", None)], key=str)
    warc.archive_pages(pages.limit(0), f"{tmp_path}/none")
    assert warc.read_warc(spark, f"{tmp_path}/none").collect() == []


def test_odd_urls(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (None, "http://A.Com/x"), (4, "http://com"), (4, "http://com"),
            (5, "://WWW.example.com/en/?q"), (6, "x://y.example.com/en/a#b"), (7, "http://x.net/fr/" + "é" * 20_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    found = {(r.page_id, r.host, r.rule) for r in urls.judge_urls(pages).collect()}
    assert {(None, "a.com", "com/"), (4, "com", None), (5, "www.example.com", "www.example.com/en/"),
            (6, "y.example.com", "example.com/en/"), (7, "x.net", "net/fr/"), (1, "", None)} <= found
    assert urls.judge_urls(pages.limit(0)).collect() == []
