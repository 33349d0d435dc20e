from __future__ import annotations

import re

from civitally.llm import licenses
from civitally.llm.queries import QUERIES
from civitally.llm.registry import table

SF_DIR = "/root/testdata/sf0.01"
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))
    places = {label: [i for i in range(len(words)) if tuple(words[i:i + len(p)]) == p] for p, label in licenses.PHRASES}
    every = sum(places.values(), [])
    base = sorted(k for k, v in places.items() if v)
    spaced, found = " " + " ".join(words) + " ", []
    for p, label, key, rule in licenses.rules():
        if key in spaced and any(g in text.lower() for g in licenses.GATE):
            for m in re.finditer(f"(?<= )(?:{rule})(?= )", spaced):
                start = spaced.count(" ", 0, m.start()) - 1
                found.append((start, -(start + m[0].count(" ") + 1), p, label))
    found = sorted(set(found))
    stays = [d for k, d in enumerate(found) if not any(
        e[1] <= d[1] and e[2] <= d[2] for e in found[:k])]
    labels = sorted({*base, *(d[3] for d in stays)})
    score = max([licenses.CONFIDENCE[d[2]] for d in stays] + [licenses.BASE if every else 0.0])
    return (len(words), len(every), min(every, default=None), max(every, default=None), ",".join(base), ",".join(labels), score)


def fields(r):
    return (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score)


def test_query_matches_plain_rules(spark):
    want = {r.doc_id: plain(r.text or "") for r in table(spark, SF_DIR, "documents").collect()}
    assert {r.doc_id: fields(r) for r in QUERIES["op6_license_labels"](spark, SF_DIR).collect()} == want


def test_written_texts(spark):
    texts = [
        "Licensed under the Apache License, Version 2.0 (the \"License\")", "SPDX-License-Identifier: GPL-3.0-or-later",
        "MIT License. Copyright (c) 2020 X. The MIT\nLICENSE", "GNU Lesser General Public License version 2.1",
        "This is no license", "a general public", "Licensed under CC BY-NC-SA 4.0 or CC-BY 4.0", "mit license " * 3000,
        "All rights reserved, copyright 1999", "MİT License", "dedicated to the public domain", "",
        "See the LICENSE file. Released under the terms of the new BSD license", "licensed under our own terms"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: fields(r) for r in licenses.with_licenses(docs).collect()}
    assert found == {i: plain(t) for i, t in enumerate(texts)}
    assert found[0][5] == "apache,apache-2.0" and found[1][5] == "gpl-3.0" and found[7][1] == 3000
    assert "lgpl-2.1" in found[3][5] and "gpl" in found[3][4]


def test_hundreds_of_rules_compile():
    assert len(licenses.rules()) > 300 and all(re.compile(r[3]) for r in licenses.rules())


def test_no_gate_stands_before_the_rules(spark, monkeypatch):
    texts = [
        "Distributed under the MIT.", "Released under CC BY-SA 4.0", "Published under the BSD 3-clause", "subject to ISC",
        "Governed by the terms of the WTFPL", "(c) 2020 ACME. All rights reserved.", "dedicated to the public-domain",
        "public\ndomain dedication", "available\tunder (Zlib)", "provided under zero-clause BSD", "SPDX short identifier: MIT"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: fields(r) for r in licenses.with_licenses(docs).collect()}
    held = {r.doc_id: fields(r) for r in QUERIES["op6_license_labels"](spark, "/root/testdata/sf0.001").collect()}
    monkeypatch.setattr(licenses, "GATE", ("",))
    assert found == {i: plain(t) for i, t in enumerate(texts)} and all(f[5] and f[6] for f in found.values())
    assert held == {r.doc_id: plain(r.text or "") for r in table(spark, "/root/testdata/sf0.001", "documents").collect()}


def test_every_match_of_a_form_holds_a_cue():
    leads = ("spdx license identifier mit", "spdx short identifier mit", "license expression mit", "licenced under mit",
             "published under mit", "governed by mit", "mit licence", "license mit")
    for k, lead in enumerate(leads):
        rule = licenses.rules()[k * len(licenses.NAMES)][3]
        assert re.fullmatch(rule, lead) and any(c in lead for c in licenses.CUES[k])
    assert len(licenses.rule_cues()) == len(licenses.rules())
    # A title holds license by its name or by the word after it.
    titles = licenses.rules()[6 * len(licenses.NAMES):7 * len(licenses.NAMES)]
    assert all("licen" in re.sub(r"\(\?:[^()]*\)\?", "", t[3]) for t in titles)
