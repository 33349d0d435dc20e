from __future__ import annotations

import math
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

from civitally.llm import simhash
from civitally.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute_fingerprint(text, width=3):
    words = [w for w in text.translate({c: c + 32 for c in range(65, 91)}).translate(
        {c: 32 for c in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """{doc_id: fingerprint} to {doc_id: smallest reachable doc_id}, comparing all pairs."""
    left, out = sorted(prints), {}
    for seed in left:
        if seed in out:
            continue
        out[seed], queue = seed, [seed]
        while queue:
            x = prints[queue.pop()]
            for y in left:
                if y not in out and (x ^ prints[y]).bit_count() <= 2:
                    out[y] = seed
                    queue.append(y)
    return out


def test_query_matches_brute_force(spark):
    docs = pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()
    prints = {d["doc_id"]: brute_fingerprint(d["text"] or "") for d in docs}
    found = {r.doc_id: (r.fingerprint, r.component_id)
             for r in QUERIES["op4_simhash_components"](spark, SF_DIR).collect()}
    component = brute_components(prints)
    assert found == {i: (f"{p:016x}", component[i]) for i, p in prints.items()}


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_no_pair_within_two_bits_is_lost(spark):
    rnd = random.Random(4)
    prints = set()
    for _ in range(40):
        x = rnd.getrandbits(64)
        for _ in range(30):
            prints.add(x)
            for _ in range(rnd.randint(1, 4)):
                x ^= 1 << rnd.randrange(64)
    prints = dict(enumerate(sorted(prints)))
    df = spark.createDataFrame([(i, _signed(p)) for i, p in prints.items()], "doc_id long, fingerprint long")
    found = {r.doc_id: r.component_id for r in simhash.components(df).collect()}
    assert found == brute_components(prints)


def test_anchors_are_code_words_within_two_bits(spark):
    rnd = random.Random(5)
    words = [rnd.getrandbits(63) for _ in range(200)] + [0]
    rows = spark.createDataFrame([(w,) for w in words], "fp long").select("fp", simhash.anchors().alias("a"))
    for fp, found in rows.collect():
        assert len(set(found)) == len(found) in (1, 32)
        for a in found:
            syndrome = 0
            for i in range(63):
                if a >> i & 1:
                    syndrome ^= i + 1
            assert syndrome == 0 and (a ^ fp).bit_count() <= 2


def test_one_document_of_each_group_stays(spark):
    rows = [(5, "a b c d", "en", "s", 1), (3, "A  b\tc d", "en", "s", 1), (3, "A  b\tc d", "en", "s", 1),
            (3, "x y z w v", None, None, None), (None, "q r s t u", "en", "s", 0), (7, None, "en", "s", 0),
            (8, "", "en", "s", 0), (None, None, None, None, None)]
    kept = simhash.near_dedup(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [rows[1], rows[3], rows[4], rows[5]]))


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], DOCS)
    assert simhash.near_dedup(empty).count() == 0
    odd = spark.createDataFrame([(1, "a b c", 9, 8, "k")], "doc_id long, text string, fp long, anchor long, row_key_a string")
    assert simhash.near_dedup(odd).columns == odd.columns


@pytest.mark.parametrize("text", ["", " \t\n", "one", "one two", "É é İ K", "w " * 70000])
def test_fingerprint_of_odd_texts(text):
    assert simhash.fingerprint(text.encode(), 3) & (1 << 64) - 1 == brute_fingerprint(text)


def test_near_copies_go_and_others_stay(spark):
    rnd = random.Random(12)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, groups = [], 150
    for g in range(groups):
        words = rnd.choices(vocabulary, k=rnd.randint(60, 300))
        for _ in range(4):
            copy = list(words)
            for _ in range(max(1, len(words) // 120)):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            rows.append((len(rows), " ".join(copy), "en", f"g{g}", 0))
        rows.append((len(rows), ", ".join(words).upper(), "en", f"g{g}", 0))
    kept = simhash.near_dedup(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.source for r in kept} == {f"g{g}" for g in range(groups)}
    # 4 of 5 texts of a group should go; those whose links are all missed stay.
    assert len(kept) - groups <= 0.05 * 4 * groups


def test_sketch_is_exact_for_short_texts():
    a, b = (simhash.profile(t)[2] for t in ("a b c d e f g h", "A, b c d e f g x"))
    assert simhash.similarity(a, b) == 3 / 5 and simhash.similarity(a, a) == 1.0


def brute_roots(texts, least=0.8):
    """Component of each text by the exact similarity of all pairs."""
    sets = []
    for t in texts:
        words = "".join(c if c.isalnum() else " " for c in t.lower()).split()
        sets.append({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))})
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if (both := len(x & sets[j])) and both / (len(x) + len(sets[j]) - both) >= least:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))]


def near_variants(rnd, count, words, edits, vocabulary=30000):
    base = [f"v{rnd.randrange(vocabulary)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(count):
        copy = list(base)
        for place in rnd.sample(range(words), edits):
            copy[place] = f"x{rnd.randrange(vocabulary)}"
        out.append(" ".join(copy))
    return out


def kept_ids(spark, texts):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    return sorted(r.doc_id for r in simhash.near_dedup(spark.createDataFrame(rows, DOCS)).collect())


def test_a_group_of_variants_of_one_original(spark):
    # Each variant is near the original; few variants are near one another.
    texts = near_variants(random.Random(3), 1000, 120, 2)
    texts = texts[1:] + texts[:1]
    assert kept_ids(spark, texts) == sorted(set(brute_roots(texts)))


def test_long_pairs_on_both_sides_of_the_threshold(spark):
    rnd = random.Random(8)
    texts = [t for k in range(240) for t in near_variants(rnd, 1, 400, 6 + k % 8)]
    assert kept_ids(spark, texts) == sorted(set(brute_roots(texts)))


def test_blocks_of_a_large_group_meet(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TEXTS", 16)
    texts = near_variants(random.Random(5), 150, 120, 2)
    assert kept_ids(spark, texts) == sorted(set(brute_roots(texts)))


def test_similarity_is_exact_for_long_texts():
    a = [f"w{i}" for i in range(2004)]
    b = a[:1800] + [f"z{i}" for i in range(204)]
    x, y = (simhash.profile(" ".join(t))[2] for t in (a, b))
    assert simhash.similarity(x, y) == 1796 / (2 * 2000 - 1796)


def test_sketches_of_similar_texts_share_enough():
    rnd = np.random.default_rng(1)
    for n in [*range(1, 60), 100, 300, 320, 400, 1000, 4000]:
        for _ in range(20):
            drawn = np.unique(rnd.integers(0, 1 << 63, 2 * n, dtype=np.uint64))
            rnd.shuffle(drawn)
            both = -(-8 * n // 10)  # the fewest common ones of n at 0.8 where the other text has no more
            x, y = (np.sort(drawn[:k])[:simhash.sketch_size(k)] for k in (n, both))
            assert np.isin(x, y).sum() >= simhash.shared_at_least(min(len(x), len(y)), 0.8)


def test_bound_on_missed_pairs():
    for k in range(1, simhash.SKETCH + 1):
        t = simhash.shared_at_least(k, 0.8)
        below = sum(math.comb(k, i) * 0.8 ** i * 0.2 ** (k - i) for i in range(t))
        assert below <= simhash.MISS and t <= math.ceil(0.8 * k)
    assert simhash.shared_at_least(simhash.SKETCH, 0.8) > 15


def test_texts_with_a_common_passage_do_not_meet(spark):
    rnd = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [" ".join(f"w{rnd.randrange(10 ** 6)}" for _ in range(300)) + f" {passage}" for _ in range(400)]
    rows = [(i, len(s), s[:simhash.sketch_size(len(s))].view(np.int64).tolist())
            for i, s in ((i, simhash._shingles(simhash._words(t))) for i, t in enumerate(texts))]
    made = spark.createDataFrame(rows, "id long, size int, sketch array<long>")
    assert simhash.shared_entries(made, 0.8).count() == 0


def test_copies_of_one_original_make_few_pairs(spark):
    texts = near_variants(random.Random(9), 3000, 150, 2)
    rows = [(i, len(s), s[:simhash.sketch_size(len(s))].view(np.int64).tolist())
            for i, s in ((i, simhash._shingles(simhash._words(t))) for i, t in enumerate(texts))]
    made = spark.createDataFrame(rows, "id long, size int, sketch array<long>")
    assert simhash.hub_pairs(simhash.shared_entries(made, 0.8), 0.8).count() < 4 * len(texts)


def test_pairs_across_components_are_all_tried(spark, monkeypatch):
    # Chains, in which no text is near all others, by pairs and by blocks.
    rnd = random.Random(10)
    texts = []
    for _ in range(20):
        words = [f"v{rnd.randrange(30000)}" for _ in range(150)]
        for _ in range(12):
            texts.append(" ".join(words))
            for _ in range(3):
                words[rnd.randrange(150)] = f"y{rnd.randrange(30000)}"
    rnd.shuffle(texts)
    wanted = sorted(set(brute_roots(texts)))
    assert kept_ids(spark, texts) == wanted
    monkeypatch.setattr(simhash, "FEW", 1)
    monkeypatch.setattr(simhash, "TEXTS", 5)
    assert kept_ids(spark, texts) == wanted


def test_given_table_as_brute_force(spark):
    docs = pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pylist()
    texts = {d["doc_id"]: d["text"] or "" for d in docs}
    ids = sorted(texts)
    root = dict(zip(ids, (ids[r] for r in brute_roots([texts[i] for i in ids]))))
    kept = simhash.near_dedup(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(set(root.values()))
