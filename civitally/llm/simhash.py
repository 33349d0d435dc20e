"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits are compared only where they meet at an anchor. The anchors are
the words of the perfect Hamming code over the low 63 bits: it covers the space with radius
1, and a word next to an anchor has 31 further anchors at distance 2. Two fingerprints at
most 2 bits apart have a point within 1 bit of both, and that point has an anchor within the
covering radius 1; so both are within 1 + 2 / 2 = 2 bits of a common anchor. Replicating to
all anchors within 2 bits (32 copies at most) therefore loses no pair, and an anchor meets
at most 4,034 different fingerprints (2,017 words within 2 bits, times the free 64th bit),
however many documents there are.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civitally.session import cut_lineage, shared_table

from .components import roots
from .registry import query, table
from .rows import ROW_KEY, join_small, small_batches, with_row_key

RADIUS = 2
SEED = 42
#: Of near_dedup: fingerprints a text, words in a shingle, and the least similarity.
PRINTS, SHINGLE, SIMILARITY = 4, 5, 0.8
#: Entries of a sketch at most, and the probability that the sketches of two similar texts share too few.
SKETCH, MISS = 64, 1e-13
#: Of no bearing on the result: texts that share an entry are paired up to FEW and compared in blocks beyond, with
#: at most TEXTS texts and about BLOCK_SHINGLES shingles.
FEW, TEXTS, BLOCK_SHINGLES = 64, 1024, 2_000_000
_BLOCK = 1 << 16
_WORD = re.compile(r"[^\W_]+")
_LOW63 = (1 << 63) - 1
# Parity masks of the code: bit i of a word belongs to column i + 1.
_PARITY = [sum(1 << i for i in range(63) if (i + 1) >> j & 1) for j in range(6)]


def fingerprint(text: bytes | None, width: int) -> int:
    """Signed 64-bit SimHash of the ``width``-word shingles of an UTF-8 text."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], stops[:-1] + 1))
    n = max(1, len(words) - width + 1)
    first, last = starts[:n].tolist(), stops[-n:].tolist()
    votes = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        pieces = [joined[s:e] for s, e in zip(first[at:at + _BLOCK], last[at:at + _BLOCK])]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.uint64, len(pieces))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.int64)[0])


def with_fingerprint(docs: DataFrame, width: int, text: str = "text", out: str = "fingerprint") -> DataFrame:
    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, width) for t in texts], dtype="int64")

    return docs.withColumn(out, simhash(F.col(text).cast("binary")))


def anchors(fingerprint: str = "fp"):
    """Array of all anchors within 2 bits of a fingerprint's low 63 bits."""
    y = f"({fingerprint} & {_LOW63}L)"
    s = "(" + " + ".join(f"shiftleft(bit_count({y} & {m}L) % 2, {j})" for j, m in enumerate(_PARITY)) + ")"
    flip = "shiftleft(1L, {} - 1)".format
    return F.expr(f"""transform(array({s}), s -> CASE WHEN s = 0 THEN array({y}) ELSE concat(
        array({y} ^ {flip('s')}),
        transform(filter(sequence(1, 63), a -> a < (a ^ s)), a -> {y} ^ {flip('a')} ^ {flip('(a ^ s)')})
    ) END)[0]""")


def _trees(words: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links within the radius that connect the words of one anchor as all such pairs would."""
    left = words.view(np.uint64)  # bits of negative numbers would be counted in their absolute value
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            word = queue.pop()
            near = np.bitwise_count(left ^ word) <= RADIUS
            if near.any():
                found, left = left[near], left[~near]
                queue.extend(found)
                yield from ((x, int(word.view(np.int64))) for x in found.view(np.int64).tolist())


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by anchor: compare the fingerprints of each anchor, carry the last one over."""
    rest = np.empty((0, 2), np.int64)
    for batch in chain(batches, [None]):
        rows = rest if batch is None else np.concatenate((rest, batch[["anchor", "fp"]].to_numpy(np.int64)))
        if not len(rows):
            continue
        cuts = np.flatnonzero(np.diff(rows[:, 0])) + 1
        starts, stops = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(rows)]))
        if batch is not None:
            rest, starts, stops = rows[starts[-1]:], starts[:-1], stops[:-1]
        several = stops - starts > 1
        found = [x for s, e in zip(starts[several], stops[several]) for x in _trees(rows[s:e, 1].copy())]
        if found:
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of ``fp`` within the radius."""
    dealt = prints.select("fp", F.explode(anchors("fp")).alias("anchor")).repartition("anchor")
    return dealt.sortWithinPartitions("anchor").mapInPandas(_compare, "a long, b long")


def components(prints: DataFrame) -> DataFrame:
    """``component_id`` for every row of ``prints``: the smallest doc_id reachable by links of ``fingerprint``.

    ``root`` is the component's smallest fingerprint: it tells components apart even
    where doc_ids repeat or are null. Equal fingerprints are one node, so copies are never paired. A null doc_id names a
    component only if it has no other. Repeated rows stay, each with its component.
    ``prints`` is read three times: give a stored frame.
    """
    least = cut_lineage(prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("least")))
    found = roots(links(least.select("fp"))).withColumnRenamed("node", "fp")
    rooted = least.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classed = rooted.select(F.col("fp").alias("fingerprint"), "root").join(named, "root")
    return prints.drop("component_id", "root").join(classed, "fingerprint")


def _hashes(pieces: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.uint64, len(pieces))


def _words(text: str | None) -> list[bytes]:
    return [w.encode() for w in _WORD.findall((text or "").lower())]


def _shingles(words: list[bytes]) -> np.ndarray:
    """Sorted hashes of all different five-word shingles."""
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], stops[:-1] + 1))
    m = max(1, len(words) - SHINGLE + 1)
    return np.unique(_hashes([joined[s:e] for s, e in zip(starts[:m].tolist(), stops[-m:].tolist())]))


def _identity(words: list[bytes]) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(words), SEED)).view(np.int64)) if words else 0


def _prints(words: list[bytes]) -> list[int]:
    """SimHashes of the set of words, each by a hash of its own."""
    if not words:
        return [0] * PRINTS
    votes = np.zeros((PRINTS, 64), np.int64)
    h = _hashes(sorted(set(words)))
    n = len(h)
    for k in range(PRINTS):
        for at in range(0, n, _BLOCK):
            bits = np.unpackbits(h[at:at + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            votes[k] += bits.sum(axis=0, dtype=np.int32)
        # The next hash of each word is a mix of the last one.
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB) + np.uint64(k + 1)
        h ^= h >> np.uint64(31)
    return np.packbits(votes * 2 > n, axis=1, bitorder="little").view(np.int64).reshape(-1).tolist()


def profile(text: str | None) -> tuple[int, list[int], bytes]:
    """Identity, fingerprints and all shingles of a text without regard to case and punctuation."""
    words = _words(text)
    return _identity(words), _prints(words), _shingles(words).tobytes()


def similarity(a: bytes, b: bytes) -> float:
    """Share of common five-word shingles of two texts, from all of them."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both) if len(x) + len(y) else 1.0


def sketch_size(m: int) -> int:
    """How many of m shingles, those with the smallest hashes, are a text's sketch; up to SKETCH it holds them all."""
    return min(m, SKETCH)


def shared_at_least(k: int, least: float) -> int:
    """How many entries the sketches of two similar texts share, where the smaller one has k.

    The first k hashes of both texts' union are a random draw from it, and each common shingle among them is in
    both sketches. So the number shared is hypergeometric with a mean of ``least * k`` at least, and by Chernoff's
    bound it is below the returned one with a probability of at most MISS.
    """
    def divergence(x: float) -> float:
        return sum(p * math.log(p / q) for p, q in ((x, least), (1 - x, 1 - least)) if p > 0)

    shared = 0
    while shared < least * k and k * divergence(shared / k) >= -math.log(MISS):
        shared += 1
    return shared


def _limits(least: float) -> list[int]:
    return [shared_at_least(k, least) for k in range(SKETCH + 1)]


def tree_links(ids: list[int], sets: list[np.ndarray], least: float) -> Iterator[tuple[int, int]]:
    """Links of at least the similarity that connect the texts as all such pairs would; each is verified."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    _, places = np.unique(np.concatenate(sets), return_inverse=True)
    offsets, has = np.cumsum(sizes) - sizes, np.zeros(len(places), bool)
    left = np.arange(len(ids))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            own = places[offsets[at]:offsets[at] + sizes[at]]
            has[own] = True
            # The texts left are looked at by their own shingles only.
            near = left[(np.minimum(sizes[left], sizes[at]) >= least * np.maximum(sizes[left], sizes[at]) - 1e-6)]
            both = np.fromiter((np.count_nonzero(has[places[offsets[i]:offsets[i] + sizes[i]]]) for i in near), np.int64, len(near))
            has[own] = False
            found = near[both / (sizes[near] + sizes[at] - both) >= least]
            left = left[~np.isin(left, found)]
            queue.extend(found.tolist())
            yield from ((ids[i], ids[at]) for i in found.tolist())


def fingerprint_pairs(texts: DataFrame) -> DataFrame:
    """Some candidate pairs (a, b) of texts (id, prints): those that meet by a fingerprint, cheap but not all.

    They share a fingerprint, or have fingerprints of one kind within the radius; of
    texts with equal fingerprints each meets the smallest id.
    """
    every = texts.select("id", F.posexplode("prints").alias("kind", "fp"))
    held = cut_lineage(every.groupBy("kind", "fp").agg(F.min("id").alias("first"), F.max("id").alias("last")))
    several = held.where("first <> last").drop("last")
    same = every.join(several, ["kind", "fp"]).where("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b"))
    # One comparison for all kinds: the kind takes part in the dealing.
    dealt = held.select("kind", "fp", F.explode(anchors("fp")).alias("anchor")).withColumn(
        "anchor", F.xxhash64("kind", "anchor")).repartition("anchor").sortWithinPartitions("anchor", "kind")
    met = dealt.select("anchor", "fp").mapInPandas(_compare, "a long, b long").distinct()
    ids = held.select("fp", "first").groupBy("fp").agg(F.min("first").alias("first"))
    near = met.join(ids.select(F.col("fp").alias("a"), F.col("first").alias("x")), "a").join(
        ids.select(F.col("fp").alias("b"), F.col("first").alias("y")), "b").select(
        F.col("x").alias("a"), F.col("y").alias("b"))
    return same.unionByName(near).where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _fit(x: str, y: str, least: float) -> Column:
    """Whether texts of these sizes can be similar."""
    return F.least(x, y) >= least * F.greatest(x, y) - 1e-6


def shared_entries(texts: DataFrame, least: float) -> DataFrame:
    """(token, id, size, rare): sketch entries by which texts (id, size, sketch) meet; all similar pairs share one.

    Entries of one text only can be shared with none. Of the others, rarest first, the last ones may be
    left out: as similar texts share ``shared_at_least`` entries, they also share one of the first. So a text with a
    passage that many others have, but with enough of its own, meets none of them. ``rare`` is the share
    of entries that no other text has.
    """
    tokens = texts.select("id", F.explode("sketch").alias("token"))
    often = cut_lineage(tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1"))
    seen = join_small(tokens, often, "token").groupBy("id").agg(F.collect_list(F.struct("n", "token")).alias("seen"))
    # Texts small enough that all similar ones are held whole share the shingles themselves; of others
    # the smallest similar one decides.
    smallest = F.least(F.ceil(F.lit(least) * F.col("size") - 1e-9), F.lit(SKETCH)).cast("int")
    needed = F.when(F.col("size") <= least * SKETCH, F.ceil(F.lit(least) * F.col("size") - 1e-9)).otherwise(
        F.get(F.lit(_limits(least)), smallest)).cast("int")
    kept = F.least(F.size("seen") - needed + 1, F.size("seen"))
    joined = texts.select("id", "size", F.size("sketch").alias("k")).join(seen, "id").where(kept > 0)
    return joined.select("id", "size", ((F.col("k") - F.size("seen")) / F.col("k")).alias("rare"), F.explode(
        F.slice(F.array_sort("seen"), F.lit(1), kept)).alias("e")).select("e.token", "id", "size", "rare")


def hub_pairs(shared: DataFrame, least: float) -> DataFrame:
    """Candidate pairs (a, b): each text with that text of its entries which has fewest entries of its own.

    The original of a group of edited copies has none, so its copies meet it, and n copies make n pairs.
    """
    hubs = cut_lineage(shared.groupBy("token").agg(F.min(F.struct("rare", "id", "size")).alias("h"), F.max("id").alias("last"),
                                                   F.min("id").alias("first")).where("first <> last").select(
        "token", F.col("h.id").alias("hub"), F.col("h.size").alias("of")))
    met = join_small(shared, hubs, "token").where(F.col("id") != F.col("hub")).where(_fit("size", "of", least))
    return met.select(F.greatest("id", "hub").alias("a"), F.least("id", "hub").alias("b")).distinct()


def likely(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs whose sizes fit and whose sketches share what similar texts share."""
    def side(name: str) -> DataFrame:
        return texts.select(F.col("id").alias(name), F.col("size").alias(f"n_{name}"), F.col("sketch").alias(f"of_{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b").where(_fit("n_a", "n_b", least))
    k, size = F.least(F.size("of_a"), F.size("of_b")), F.greatest("n_a", "n_b")
    needed = F.when(size <= SKETCH, F.ceil(F.lit(least) * size - 1e-9)).otherwise(F.get(F.lit(_limits(least)), k))
    return both.where(F.size(F.array_intersect("of_a", "of_b")) >= needed).select("a", "b")


def together(open_rows: DataFrame) -> DataFrame:
    """The rows (token, id, size) with tokens whose texts overlap put together where that makes fewer blocks.

    Many entries of one large group of copies ask nearly the same question. All texts that a chain of entries
    connects may be compared at once instead; whichever of both moves fewer texts is done, chain by chain.
    """
    low = cut_lineage(open_rows.groupBy("token").agg(F.min("id").alias("low"), F.count("*").alias("n")))
    chained = _roots(join_small(open_rows, low.select("token", "low"), "token").select(F.col("id").alias("a"), F.col("low").alias("b")))
    named = chained.withColumnRenamed("root", "chain")
    members = cut_lineage(open_rows.select("id", "size").distinct().join(named, "id", "left").withColumn(
        "chain", F.coalesce("chain", "id")))
    apart = low.join(members.select(F.col("id").alias("low"), "chain"), "low").select(
        "token", "chain", (F.col("n") * F.ceil(F.col("n") / TEXTS)).alias("moved"))
    sizes = members.groupBy("chain").agg(F.count("*").alias("n"))
    cost = apart.groupBy("chain").agg(F.sum("moved").alias("moved")).join(sizes, "chain")
    whole = cut_lineage(cost.where(F.col("n") * F.ceil(F.col("n") / TEXTS) <= F.col("moved")).select("chain"))
    tokens = apart.join(whole, "chain", "left_anti").select("token")
    return members.join(whole, "chain").select(F.col("chain").alias("token"), "id", "size").unionByName(
        open_rows.join(tokens, "token").select("token", "id", "size"))


def blocks(open_rows: DataFrame) -> DataFrame:
    """(token, x, y, id): the texts of each token in blocks that meet pairwise, bounded in texts and in shingles."""
    sums = open_rows.groupBy("token").agg(
        F.count("*").alias("n"), F.sum("size").alias("shingles"), F.max("size").alias("most"),
        F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("texts"))
    # Tokens of the same texts ask the same question.
    asked = sums.groupBy("n", "shingles", "most", "texts").agg(F.min("token").alias("token")).select("token", F.greatest(
        F.ceil(F.col("n") / TEXTS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int").alias("many"))
    own = F.pmod(F.xxhash64("id"), F.col("many")).cast("int")
    met = open_rows.join(asked, "token").select("token", "id", own.alias("own"), F.explode(
        F.sequence(F.lit(0), F.col("many") - 1)).alias("other"))
    return met.select("token", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "id")


def _groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of each key of rows sorted by ``keys``, groups of one row left out."""
    rest = []
    for batch in batches:
        if not len(batch):
            continue
        k = batch[keys].to_numpy()
        edges = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1).tolist(), len(k)]
        for start, stop in zip(edges, edges[1:]):
            if rest and (rest[-1][keys].to_numpy()[-1] != k[start]).any():
                if sum(map(len, rest)) > 1:
                    yield pd.concat(rest)
                rest = []
            rest.append(batch[start:stop])
    if sum(map(len, rest)) > 1:
        yield pd.concat(rest)


class _Stored:
    """The texts of a corpus: their shingles on demand, and verified links."""

    def __init__(self, keyed: DataFrame, texts: DataFrame, least: float):
        self.keyed, self.texts, self.least = keyed, texts, least

    def sets(self, ids: DataFrame) -> DataFrame:
        """(id, shingles) of the texts named; the table is read, and the texts themselves are not moved for a small list."""
        @F.pandas_udf("binary")
        def all_shingles(texts: pd.Series) -> pd.Series:
            return pd.Series([_shingles(_words(t)).tobytes() for t in texts], dtype=object)

        asked = cut_lineage(self.texts.select("id", *ROW_KEY).join(ids.distinct(), "id"))
        found = join_small(self.keyed.select(*ROW_KEY, "text"), asked, ROW_KEY)
        # Wholly equal rows have equal keys, so a text may be found more than once.
        return shared_table(found.select("id", all_shingles("text").alias("shingles")).dropDuplicates(["id"]), "shingles")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are similar, by all shingles of both."""
        least = self.least

        @F.pandas_udf("double")
        def alike(a: pd.Series, b: pd.Series) -> pd.Series:
            return pd.Series([similarity(x, y) for x, y in zip(a, b)], dtype="float64")

        pairs = cut_lineage(pairs)
        sets = self.sets(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))))
        both = pairs.join(sets.withColumnsRenamed({"id": "a", "shingles": "of_a"}), "a").join(
            sets.withColumnsRenamed({"id": "b", "shingles": "of_b"}), "b")
        return cut_lineage(both.where(alike("of_a", "of_b") >= least).select("a", "b"))

    def linked_in_blocks(self, rows: DataFrame) -> DataFrame:
        """Links that connect the texts of each token as all similar pairs of it would."""
        least = self.least

        def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for group in _groups(batches, ["token", "x", "y"]):
                sets = [np.frombuffer(s, np.uint64) for s in group["shingles"]]
                yield pd.DataFrame(list(tree_links(group["id"].tolist(), sets, least)), columns=["a", "b"], dtype="int64")

        dealt = blocks(rows).join(self.sets(rows.select("id")), "id").repartition("token", "x", "y")
        sorted_ = dealt.sortWithinPartitions("token", "x", "y").select("token", "x", "y", "id", "shingles")
        return cut_lineage(sorted_.mapInPandas(verify, "a long, b long"))


def _roots(links: DataFrame) -> DataFrame:
    return roots(links).withColumnRenamed("node", "id")


def text_roots(stored: _Stored) -> DataFrame:
    """(id, root) of all texts that have a link.

    Texts that meet by fingerprints at anchors and by hubs are linked first. Only where an entry is
    shared by texts of several components do the pairs across them come into question, and all of them do.
    """
    texts, least = stored.texts, stored.least
    shared = cut_lineage(shared_entries(texts, least))
    met = fingerprint_pairs(texts).unionByName(hub_pairs(shared, least)).distinct()
    first = stored.linked(likely(met, texts, least))
    known = _roots(first)
    rooted = cut_lineage(shared.join(known, "id", "left").withColumn("root", F.coalesce("root", "id")).drop("rare"))
    across = cut_lineage(rooted.groupBy("token").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n")).where("low <> high").select("token", "n"))
    rows = cut_lineage(join_small(rooted, across, "token"))
    few, many = rows.where(F.col("n") <= FEW).drop("n"), rows.where(F.col("n") > FEW).drop("n")
    other = few.select("token", F.col("id").alias("b"), F.col("root").alias("root_b"), F.col("size").alias("n_b"))
    cross = few.join(other, "token").where("id > b AND root <> root_b").where(_fit("size", "n_b", least)).select(
        F.col("id").alias("a"), "b").distinct()
    more = stored.linked(likely(cross, texts, least))
    if not many.isEmpty():
        more = more.unionByName(stored.linked_in_blocks(cut_lineage(together(many.select("token", "id", "size")))))
    if more.isEmpty():
        return known
    return _roots(known.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(more))


def near_dedup(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One document of each group of copies: that with the smallest doc_id (nulls last).

    Texts that differ in case and punctuation only are copies, and so are texts linked by
    a similarity of at least ``least`` on all their five-word shingles. Fingerprints of the word sets that
    meet at anchors, and sketches of the shingles, tell which pairs are verified; none at the similarity is
    passed over but with a probability of MISS. Null and wordless texts are one group. Of wholly
    equal rows one stays. The columns of ``docs`` come back, whatever their names.
    """

    @F.pandas_udf("struct<id: long, size: int, prints: array<long>, sketch: array<long>>")
    def profiles(texts: pd.Series) -> pd.DataFrame:
        out = []
        for words in map(_words, texts):
            held = _shingles(words)
            sketch = held[:sketch_size(len(held))].view(np.int64)
            out.append((_identity(words), len(held), _prints(words), sketch))
        return pd.DataFrame(out, columns=["id", "size", "prints", "sketch"])

    keyed = with_row_key(small_batches(docs))
    rows = shared_table(keyed.select("doc_id", *ROW_KEY, profiles("text").alias("p")).select(
        "doc_id", *ROW_KEY, "p.*"), "profiles")
    texts = rows.groupBy("id").agg(F.first("size").alias("size"), F.first("prints").alias("prints"),
                                   F.first("sketch").alias("sketch"), F.min(F.struct(*ROW_KEY)).alias("row"))
    texts = shared_table(texts.select("id", "size", "prints", "sketch", *(F.col(f"row.{c}") for c in ROW_KEY)), "texts")
    found = text_roots(_Stored(keyed, texts, least))
    grouped = rows.select("doc_id", *ROW_KEY, "id").join(found, "id", "left").withColumn("root", F.coalesce("root", "id"))
    first = grouped.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", *ROW_KEY)).alias("kept"))
    kept = first.select(*(F.col(f"kept.{c}") for c in ROW_KEY))
    # Only rows that occur more than once need to be moved to leave one.
    kept = cut_lineage(kept.join(rows.groupBy(*ROW_KEY).agg(F.count("*").alias("__n")), ROW_KEY))
    once = join_small(keyed, kept.where("__n = 1"), ROW_KEY).select(*docs.columns)
    again = join_small(keyed, kept.where("__n > 1"), ROW_KEY).dropDuplicates(ROW_KEY).select(*docs.columns)
    return once.unionByName(again)


@query()
def op4_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = with_fingerprint(table(spark, sf_dir, "documents"), 3).select("doc_id", "fingerprint")
    return components(cut_lineage(docs)).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
