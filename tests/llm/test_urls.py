"""The character models of the URL filter against plain Python, and what they tell apart."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import pytest

from civitally.llm import urls


def plain_model(texts):
    """p(sign | up to five before it) by Witten-Bell, from a list of URLs of one class."""
    grams = Counter()
    for text in texts:
        t = "\x02" + text + "\x03"
        for i in range(1, len(t)):
            grams.update(t[i - k:i + 1] for k in range(min(i, 5) + 1))
    seen, kinds = Counter(), Counter()
    for gram, n in grams.items():
        seen[gram[:-1]] += n
        kinds[gram[:-1]] += 1

    def probability(gram, signs):
        p = 1 / signs
        for k in range(1, len(gram) + 1):
            part = gram[-k:]
            context = part[:-1]
            if seen[context]:
                p = (grams[part] + kinds[context] * p) / (seen[context] + kinds[context])
        return p

    return grams, probability


def test_ratios_as_plain_python(spark):
    accepted, rejected = ["http://a.com/x", "http://b.com/yé", "http://a.com/x"], ["ftp://c.net/fr/q?z=1"]
    rows = [("http://a.com/x", 2, "allow"), ("http://b.com/yé", 1, "allow"), ("ftp://c.net/fr/q?z=1", 1, "block"),
            ("new \U0001f600 one", 1, None), ("", 5, None)]
    found = {r.window: r.ratio for r in urls.log_ratios(spark.createDataFrame(rows, "url string, n long, label string")).collect()}
    (one, p), (other, q) = plain_model(accepted), plain_model(rejected)
    signs = len({g for g in [*one, *other] if len(g) == 1}) + 1
    wanted = {}
    for text, _, _ in rows:
        t = "\x02" + text + "\x03"
        for i in range(1, len(t)):
            gram = t[max(i - 5, 0):i + 1]
            wanted[gram] = math.log(p(gram, signs)) - math.log(q(gram, signs))
    assert set(found) == set(wanted)
    assert all(abs(found[g] - wanted[g] * urls.UNITS) <= 0.51 for g in wanted)


def _scores(spark, texts):
    known = [f"http://h{i}.com/{w}" for i in range(40) for w in ("news", "a?id=1")]
    known += [f"http://h{i}.net/fr/{w}" for i in range(40) for w in ("spam", "b?spam=2")]
    pages = spark.createDataFrame(list(enumerate([*known, *texts])), "page_id long, url string")
    return {r.url: r for r in urls.judge_urls(pages).collect()}


def test_what_the_whole_url_tells_apart(spark):
    asked = ["http://h.org/a?spam=1", "http://h.org/a?id=2", "bad.example/x", "good.example/y", "http://h.org/x#one",
             "http://h.org/x#two", "http://ü.org/", "http://ö.org/", "http://h.org/é"]
    found = _scores(spark, asked)
    assert len({found[u].score for u in asked[:6]}) == 6
    assert found["http://h.org/a?spam=1"].score < found["http://h.org/a?id=2"].score


def test_longer_contexts_are_used(spark):
    # "xabcdy" and "zabcdw" differ in what follows four equal characters.
    rows = [(f"http://q{i}.com/xabcdy", 1, "allow") for i in range(20)] + [(f"http://q{i}.net/fr/zabcdw", 1, "block") for i in range(20)]
    found = {r.window: r.ratio for r in urls.log_ratios(spark.createDataFrame(rows, "url string, n long, label string")).collect()}
    assert found["xabcdy"] > urls.UNITS and found["zabcdw"] < -urls.UNITS


def test_held_out_urls_are_ranked(spark):
    """Rule-labelled URLs kept out of the counts: how often an accepted one scores above a rejected one."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    ruled = urls.with_rule(urls.with_parts(pages)).where("__label IS NOT NULL")
    labels = {r.url: r["__label"] for r in ruled.collect()}
    found = {r.url: r.score for r in urls.judge_urls(pages).collect()}
    aside = [u for u in labels if hashlib.md5(u.encode()).hexdigest()[0] in "0123"]
    allow, block = ([found[u] for u in aside if labels[u] == v] for v in ("allow", "block"))
    above = sum((a > b) + (a == b) / 2 for a in allow for b in block) / (len(allow) * len(block))
    print("share of pairs in order", above, len(allow), len(block))
    assert above > 0.9


def test_clashing_columns_and_repeated_rows(spark):
    row = (1, "http://a.com/x", "l", "g", 2, {"k": 1}, "h", 5)
    pages = spark.createDataFrame([row, row, (2, None, *row[2:])],
                                  "page_id long, url string, label string, grams string, n int, m map<string,int>, host string, window int")
    found = urls.judge_urls(pages).collect()
    assert len(found) == 3
    assert all((r.label, r.grams, r.n, r.m, r.window) == ("l", "g", 2, {"k": 1}, 5) for r in found)
    assert sorted(r.host for r in found) == ["", "a.com", "a.com"]


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "http://x.org/only")]])
def test_nothing_labelled(spark, rows):
    found = urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert [(r.score, r.verdict) for r in found] == [(0.0, "allow")] * len(rows)
