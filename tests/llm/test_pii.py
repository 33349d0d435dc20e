from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from civitally.llm import pii
from civitally.llm.queries import QUERIES
from civitally.llm.registry import table

SF_DIR = "/root/testdata/sf0.001"


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain(text):
    """Spans by the patterns as they are stated."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15]
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab@.-+0123459 ()%é\n", max_size=60))
def test_base_spans(text):
    assert pii.base_spans(text) == plain(text)
    assert not plain(text) or re.search(pii.MAY_HOLD, text)


def test_base_spans_of_the_tables_and_long_runs(spark):
    for r in table(spark, SF_DIR, "documents").collect():
        assert pii.base_spans(r.text) == plain(r.text)
    assert pii.base_spans("a" * 300_000 + "@" + "1" * 300_000 + "." * 300_000) == []


def test_query_matches_plain_patterns(spark):
    want = {r.doc_id: plain(r.text or "") for r in table(spark, SF_DIR, "documents").collect()}
    for r in QUERIES["op1_pii_spans"](spark, SF_DIR).collect():
        listed = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in want[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in want[r.doc_id]) for i in range(4)]
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))


def test_terms_that_give_entities_away(spark):
    rnd = random.Random(2)
    filler = "the of and is to in that was for with".split()
    rows = [(i, f"{' '.join(rnd.choices(filler, k=30))} Mailbox x{i}@a.org {' '.join(rnd.choices(filler, k=30))}") for i in range(9)]
    rows += [(100 + i, " ".join(rnd.choices(filler, k=60))) for i in range(30)] + [(200, "a Mailbox without one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert all("<EMAIL>" in found[i] and "Mailbox" not in found[i] and "@" not in found[i] for i in range(9))
    assert all(found[i] == t for i, t in rows if 100 <= i < 200) and found[200] == "a  without one"
    spans = {r.doc_id: r.pii_spans for r in pii.with_spans(docs).collect()}
    assert {s.kind for s in spans[0]} == {"email", "term"} and [s.kind for s in spans[200]] == ["term"]


def test_disclosing_terms_go_far_from_the_entity_too(spark):
    rnd = random.Random(6)
    filler = "the of and is to in that was for with".split()
    some = lambda n: " ".join(rnd.choices(filler, k=n))
    rows = [(i, f"{some(30)} Mailbox x{i}@a.org {some(40)}{' Mailbox, mailbox ' + some(9) if i < 3 else ''}") for i in range(12)]
    rows += [(100 + i, some(200)) for i in range(30)]
    rows += [(50, f"Mailbox {some(40)} call +1 212 555 0100")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert all("mailbox" not in found[i].lower() for i, _ in rows)
    spans = {r.doc_id: r.pii_spans for r in pii.with_spans(docs).collect()}
    assert [s.kind for s in spans[0]] == ["term", "email", "term", "term"]


WORD = re.compile(r"[^\W\d_][\w'-]*")


def plain_terms(rows):
    """{doc_id: {(start, end, action)}} of disclosing terms, by counting everything in memory."""
    together, values, near, totals, cut = Counter(), {}, Counter(), Counter(), {}
    for i, text in rows:
        totals.update(w.lower() for w in WORD.findall(text))
        entities = plain(text)
        inside = lambda s, e: any(a < e and s < b for a, _, b in entities)
        for start, kind, end in entities:
            left, right = max(0, start - 64), min(len(text), end + 64)
            before = [(left + m.start(), left + m.end()) for m in WORD.finditer(text[left:start])]
            if before and before[0][0] == left > 0 and text[left - 1].isalnum():
                before = before[1:]
            after = [(end + m.start(), end + m.end()) for m in WORD.finditer(text[end:right])]
            if after and after[-1][1] == right < len(text) and text[right].isalnum():
                after = after[:-1]
            for s, e in before[-3:] + after[:3]:
                if not inside(s, e):
                    term = text[s:e].lower()
                    together[term, kind] += 1
                    near[kind] += 1
                    values.setdefault((term, kind), set()).add(text[start:end])
                    cut.setdefault(i, {})[s, e] = term
    words, telling = sum(totals.values()), {}
    for (term, kind), n in together.items():
        ic = math.log(words / near[kind])
        if len(values[term, kind]) >= 3 and ic > 0:
            d = round(1 - math.log(max(totals.get(term, n), n) / n) / ic, 9)
            if d >= 0.6:
                telling[term] = max(d, telling.get(term, 0))
    out = {}
    for i, text in rows:
        entities = plain(text)
        found = {(m.start(), m.end()): m[0].lower() for m in WORD.finditer(text)
                 if not any(a < m.end() and m.start() < b for a, _, b in entities)} | cut.get(i, {})
        out.setdefault(i, set()).update((s, e, "remove" if telling[t] >= 0.9 else "generalise") for (s, e), t in found.items() if t in telling)
    return out


def _term_corpus():
    rnd = random.Random(11)
    filler = [f"w{i}" for i in range(60)]
    some = lambda n: " ".join(rnd.choices(filler, k=n))
    rows = []
    for i in range(12):
        rows.append((len(rows), f"{some(20)} İstanbul u{i}@a.org {some(9)} Istanbul"))
        rows.append((len(rows), f"{some(20)} node-10.0.0.{i} {some(20)}"))
        rows.append((len(rows), f"{some(8)} Straße, call +1 212 555 01{i:02d} now {some(8)} {'STRASSE straße' if i % 3 else ''}"))
        rows.append((len(rows), f"{some(8)} often x{i}@b.com {some(4)} often often often" if i < 4 else f"{some(9)} often İSTANBUL {some(3)}"))
    return rows + [(len(rows), ""), (len(rows) + 1, some(300) + " node- alone")]


def test_terms_as_plain_python(spark):
    rows = _term_corpus()
    want = plain_terms(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: {(s.start, s.end, s.action) for s in r.pii_spans if s.kind == "term"} for r in pii.with_spans(docs).collect()}
    assert found == want
    texts = dict(rows)
    treated = {texts[i][s:e].lower() for i, spans in want.items() for s, e, _ in spans}
    assert {"i\u0307stanbul", "node-", "straße"} <= treated


def test_terms_of_the_given_table_as_plain_python(spark):
    rows = [(r.doc_id, r.text or "") for r in table(spark, "/root/testdata/sf0.01", "documents").collect()]
    found = {r.doc_id: {(s.start, s.end, s.action) for s in r.pii_spans if s.kind == "term"}
             for r in pii.with_spans(table(spark, "/root/testdata/sf0.01", "documents")).collect()}
    assert found == plain_terms(rows)


def test_map_columns(spark):
    docs = spark.createDataFrame([(1, "x a@b.org", {"k": 1, "j": 2}, [{"z": 1}]), (1, "x a@b.org", {"j": 2, "k": 1}, [{"z": 1}])],
                                 "doc_id long, text string, m map<string,int>, n array<map<string,int>>")
    found = pii.sanitise(docs).collect()
    assert [(r.text, r.m, r.n) for r in found] == [("x <EMAIL>", {"k": 1, "j": 2}, [{"z": 1}])] * 2
