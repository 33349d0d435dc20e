"""Token alignment against a brute force over bytes, on odd tables, and by both ways of joining counts."""

from __future__ import annotations

import hashlib
import time
from collections import Counter
from functools import lru_cache
from pathlib import Path
from sys import getsizeof
from urllib.parse import urlparse

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from civitally.llm import alignment
from civitally.session import shared_dir

SF_DIR = "/root/testdata/sf0.001"
NEW = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def aligner():
    a, b = (Path(alignment.TOKENIZERS, n).read_bytes() for n in (alignment.BYTE_LEVEL, alignment.PIECES))
    return alignment.Aligner(alignment.byte_level(a), alignment.pieces_with_space(b))


def owners(ids, pieces):
    """Token number of every byte."""
    return [k for k, i in enumerate(ids) for _ in pieces[i]]


def plain(text, aligner):
    """Ids, groups and links, from the tokens that own each byte."""
    if not text:
        return (), (), [], []
    a, b, whole = aligner.encode_a(text), aligner.encode_b(text), b" " + text.encode()
    if b"".join(aligner.bytes_a[i] for i in a) != whole or b"".join(aligner.bytes_b[i] for i in b) != whole:
        return (), (), [], []
    by_a, by_b = owners(a, aligner.bytes_a), owners(b, aligner.bytes_b)
    links = [(a[x], b[y]) for x, y in sorted(set(zip(by_a, by_b)))]
    groups, held_a, held_b = [], [], []
    for at, (x, y) in enumerate(zip(by_a, by_b)):
        held_a += [x] if x not in held_a[-1:] else []
        held_b += [y] if y not in held_b[-1:] else []
        last = at + 1 == len(by_a)
        if last or (by_a[at + 1] != x and by_b[at + 1] != y):
            groups.append(f"{','.join(str(a[k]) for k in held_a)}|{','.join(str(b[k]) for k in held_b)}")
            held_a, held_b = [], []
    return tuple(a), tuple(b), groups, links


def corpus(rows, aligner):
    """The query's columns for (doc_id, text) rows, by brute force."""
    found = [(i, *plain(t, aligner)) for i, t in rows]
    counts = Counter(pair for *_, links in found for pair in set(links))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    return [(i, len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[0]] for p in links),
             sum(counts[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "")
            for i, a, b, groups, links in found]


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=80) | st.lists(st.sampled_from(
    ["the", " ", "  ", "\n", "é", "\U0001f600", "▁", "</s>", "<|endoftext|>", "1234", "naïve", "東京", "́", "x" * 30]),
    max_size=12).map("".join))
def test_any_text(aligner, text):
    a, b = aligner.tokens(text)
    groups, links = aligner.align(a, b)
    wanted = plain(text, aligner)
    assert (tuple(a), tuple(b), groups) == (tuple(wanted[0]), tuple(wanted[1]), wanted[2])
    assert Counter(divmod(p, alignment.SHIFT) for p in links.tolist()) == Counter(wanted[3])


def test_forgotten_groups_are_made_again(aligner, monkeypatch):
    text = "Donaudampfschifffahrt und naïve Straßenköter, 東京 and so on. " * 5
    whole = aligner.align(*aligner.tokens(text))
    monkeypatch.setattr(alignment, "_KNOWN_GROUPS", 3)
    aligner.known.clear()
    again = aligner.align(*aligner.tokens(text))
    assert whole[0] == again[0] and sorted(whole[1]) == sorted(again[1])


@pytest.mark.parametrize("most", [0, 40, 10 ** 6])
def test_results_kept_for_copies(aligner, monkeypatch, most):
    monkeypatch.setattr(alignment, "_KNOWN_GROUPS", most)
    texts = ["one two", "Straßenköter, naïve", None, "one two", "", "\u6771\u4eac 12345", "x" * 9000, "one two"]
    own = alignment.Aligner((aligner.encode_a, aligner.bytes_a), (aligner.encode_b, aligner.bytes_b))
    for text in texts * 2:
        a, b, groups, links = plain(text, aligner)
        counts = sorted(Counter(x * alignment.SHIFT + y for x, y in links).items())
        n_a, n_b, n_groups, n_links, joined, pairs, times = own.measures(text)
        assert (n_a, n_b, n_groups, n_links, joined) == (len(a), len(b), len(groups), len(links), ";".join(groups))
        assert list(zip(pairs.tolist(), times.tolist())) == counts
        assert own.known_groups == sum(kept[2] + 1 for kept in own.known.values()) <= most


def test_kept_results_take_bounded_room():
    # Texts that are not given back have no groups; all of them were kept, 96 MB here.
    own = alignment.Aligner((lambda text: [], [b"a"]), (lambda text: [], [b"b"]))
    for k in range(3_000):
        text = chr(0x1F600 + k) * 8_000
        assert own.measures(text)[:5] == own.measures(text)[:5] == (0, 0, 0, 0, "")
    assert 0 < sum(map(getsizeof, own.known)) <= 64_000_000
    assert own.known_bytes == sum(kept[-1] for kept in own.known.values()) <= 64_000_000


def test_aligning_takes_less_than_half_of_encoding(aligner):
    # It took 0.8 of it when groups were looked up one by one.
    spent = {"tokens": [], "align": []}
    texts = [f"The {k}th of many words, naïve Straßenköter and {k * 7919} others: it's {k} " * 60 for k in range(60)]
    for _ in range(5):
        start = time.process_time()
        found = [aligner.tokens(text) for text in texts]
        spent["tokens"].append(time.process_time() - start)
        start = time.process_time()
        for a, b in found:
            aligner.align(a, b)
        spent["align"].append(time.process_time() - start)
    assert min(spent["align"]) < 0.5 * min(spent["tokens"]), spent


@settings(max_examples=500, deadline=None)
@given(text=st.text(max_size=60) | st.text("a '\u0085\u00a0\u180e\u200b\u3000\t\n\r1é²ⅷ་\u0301_s", max_size=40))
def test_ids_are_those_of_the_vocabulary_file(aligner, text):
    assert aligner.encode_a(text) == _own().encode(" " + text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [" " * 1_000_000, "\n" * 50_000 + "x", "a" * 100_000, "^" * 100_000, "<|endoftext|> x"])
def test_ids_of_long_runs(aligner, text):
    assert aligner.encode_a(text) == _own().encode(" " + text, add_special_tokens=False).ids


@lru_cache
def _own():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(str(Path(alignment.TOKENIZERS, alignment.BYTE_LEVEL)))
    tokenizer.encode_special_tokens = True
    return tokenizer


def test_whole_table(spark, aligner):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    found = [tuple(r) for r in alignment.op12_token_alignment(spark, SF_DIR).select("doc_id", *NEW).collect()]
    assert sorted(found) == sorted(corpus(rows, aligner)) and sum(r[4] for r in found) > 10_000


ODD = [(1, None), (2, ""), (3, "▁ not given back"), (None, "same text here"), (None, "same text here"),
       (4, "same text here"), (4, "other"), (2 ** 60 + 1, "one two " * 30_000), (5, " "), (6, "\x00\n\t")]


@pytest.mark.parametrize("most", [10 ** 6, 0])
def test_odd_rows_by_both_joins(spark, aligner, most):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").repartition(3)
    found = alignment.align_corpus(docs, most=most).collect()
    assert sorted(map(tuple, found), key=str) == sorted(corpus(ODD, aligner), key=str)


def test_long_texts_share_no_batch_of_results(spark, monkeypatch):
    # All twelve went into one batch of results, as up to 128 texts did whatever their length.
    docs = spark.createDataFrame([], "doc_id long, text string")
    sent, send = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, step, *rest: (sent.append(step), send(self, step, *rest))[1])
    alignment.with_alignment(docs)
    texts = [None, "", *(f"{k} " * 200_000 for k in range(12)), *["short one"] * 130, None]
    batch = pa.RecordBatch.from_pydict({"__0": list(range(len(texts))), "__1": texts, "__text": texts})
    found = list(sent[0](iter([batch.slice(0, 0), batch])))
    assert max(len("".join(t or "" for t in b.column("__1").to_pylist()[:-1])) for b in found) < 1_000_000
    assert [i for b in found for i in b.column("__0").to_pylist()] == list(range(len(texts)))
    assert [n > 0 for b in found for n in b.column("n_a").to_pylist()] == [bool(t) for t in texts]
    assert all(b.num_rows <= 128 for b in found) and len(found) <= 8


def test_counts_are_written_once(spark):
    # They were written before and after their marks, in as many files again.
    rows = [[1, 2 ** 32 + 1, 2 ** 32 + 2], [1, 2, 2 ** 32 + 1], [1, 2 ** 32 + 2], []]
    docs = spark.createDataFrame([(r,) for r in rows], "pairs array<long>").repartition(3)
    folder = Path(urlparse(shared_dir(spark)).path)
    before = set(folder.rglob("rdd-*"))
    found = alignment.pair_counts(docs)
    assert len(set(folder.rglob("rdd-*")) - before) == 1
    assert sorted(map(tuple, found.collect())) == [
        (1, 3, True), (2, 1, False), (2 ** 32 + 1, 2, True), (2 ** 32 + 2, 2, True)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_corpus(docs).collect() == []
    assert alignment.with_alignment(docs).collect() == []


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 5, 6, 7, {"k": 1}, 8)],
                                 "doc_id long, text string, n_a int, pair int, row int, m map<string,int>, `a.b` int")
    row = alignment.align_corpus(docs).first()
    assert (row.n_a, row.pair, row.row, row.m, row["a.b"]) == (2, 6, 7, {"k": 1}, 8)
    row = alignment.with_alignment(docs).first()
    assert (row.text, row.n_a, row.pair, row.groups.count(";"), sum(row.times)) == ("a b", 2, 6, row.n_groups - 1, row.n_links)
