from __future__ import annotations

import random
import re
from collections import Counter

from civitally.llm import decontaminate
from civitally.llm.queries import QUERIES
from civitally.llm.registry import table

SF_DIR = "/root/testdata/sf0.001"


def shingles(words):
    return [tuple(words[i:i + 5]) for i in range(len(words) - 4)]


def words_of(text):
    return re.findall(r"[^\W_]+", text.lower())


def best_windows(docs, items):
    """{(doc, item): best similarity >= 0.8 over all windows of the item's length}."""
    out = {}
    for i, text in items:
        want = Counter(shingles(words_of(text)))
        m = sum(want.values())
        for d, doc in docs:
            have = shingles(words_of(doc))
            if m and want.keys() & set(have):
                best = max(
                    (lambda c: sum((c & want).values()) / sum((c | want).values()))(Counter(have[s:s + m]))
                    for s in range(len(have)))
                if best >= 0.8:
                    out[d, i] = round(best, 6)
    return out


def test_query_matches_all_windows(spark):
    docs = [(r.doc_id, r.text or "") for r in table(spark, SF_DIR, "documents").collect()]
    items = [(r.item_id, r.text or "") for r in table(spark, SF_DIR, "benchmark").collect()]
    found = {(r.doc_id, r.item_id): r.similarity for r in QUERIES["op2_decontamination"](spark, SF_DIR).collect()}
    assert found == best_windows(docs, items)


def test_edited_passages(spark):
    """The pairs found are those that are similar."""
    rnd = random.Random(6)
    vocabulary = [f"w{i}" for i in range(500)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randint(20, 90)))) for i in range(40)]
    docs = []
    for i, text in items:
        for _ in range(5):
            words = text.split()
            for _ in range(rnd.randint(0, 3)):
                at = rnd.randrange(len(words))
                words[at:at + rnd.randint(0, 1)] = rnd.choices(vocabulary, k=rnd.randint(0, 1))
            docs.append((len(docs), " ".join(rnd.choices(vocabulary, k=30)) + " " + ", ".join(words) + ". "
                         + " ".join(rnd.choices(vocabulary, k=30))))
    want = best_windows(docs, items)
    found = decontaminate.contaminations(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    keyed = decontaminate.with_row_key(spark.createDataFrame(docs, "doc_id long, text string"))
    got = {(r.doc_id, r.item_id): r.similarity for r in keyed.join(found, decontaminate.ROW_KEY).collect()}
    assert got == want and len(want) > 50


def test_simhash_of_long_arrays(spark):
    rnd = random.Random(9)
    rows = [([rnd.getrandbits(64) - (1 << 63) for _ in range(n)],) for n in (1, 2, 7, 65_535, 65_540)]
    df = decontaminate._simhash(spark.createDataFrame(rows, "grams array<long>"), "grams", "fp")
    for grams, fp in df.collect():
        want = sum(1 << b for b in range(64) if 2 * sum(g >> b & 1 for g in grams) > len(grams))
        assert fp & (1 << 64) - 1 == want


def test_short_items_are_found_as_whole_sequences(spark):
    items = [(1, "Alpha beta"), (2, "one, two three four"), (3, "gamma"), (4, ""), (5, None), (6, "not there")]
    docs = [(1, "x alpha BETA y alpha beta"), (2, "zero one two three. four five"), (3, "alpha gamma beta"), (4, None), (5, "four three two one")]
    made = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.with_row_key(made).join(decontaminate.contaminations(made, bench), decontaminate.ROW_KEY).collect()
    assert sorted((r.doc_id, r.item_id, r.start_word, r.n_words, r.similarity) for r in found) == [
        (1, 1, 1, 2, 1.0), (2, 2, 1, 4, 1.0), (3, 3, 1, 1, 1.0)]
    assert sorted(r.doc_id for r in decontaminate.decontaminate(made, bench).collect()) == [4, 5]


def test_a_long_item_is_not_copied_for_each_window(spark):
    rnd = random.Random(3)
    words = [f"w{rnd.randrange(10 ** 6)}" for _ in range(1500)]
    docs = [(i, " ".join(words) + f" end {i}") for i in range(20)]
    made = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    assert decontaminate.contaminations(made, bench).count() == 20
    assert decontaminate.windows(decontaminate.touched(made, decontaminate.items_index(bench)),
                                 decontaminate.items_index(bench)).columns == [*decontaminate.ROW_KEY, "start", "m", "fp"]
