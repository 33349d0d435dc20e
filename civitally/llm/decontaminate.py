"""Benchmark decontamination by SimHash over item-sized windows, with DataFrame functions only.

An item and a window of as many words each have a SimHash of their five-word shingles. Window
and item meet where they have the same length and one of six blocks of their fingerprints
differs in at most ``RADIUS // 6`` bits: of any two fingerprints within the radius one block does,
so none within it is lost. Those within the radius are verified by the exact similarity
of their shingle multisets: shared over all, every shingle weighted by how often it occurs.

Items of under five words have no shingle: they are found where their words stand, as a whole sequence.

Windows are laid wherever their first shingle is one of a benchmark item, as long as that item.
No better window exists: one that begins with a foreign shingle gains or stays equal when it
moves on by a word. A filter of fixed size finds these places inside the row of the document, so
only they leave it.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civitally.session import cut_lineage, shared_table

from .registry import query, table
from .rows import ROW_KEY, join_small, once, with_row_key

SHINGLE = 5
SIMILARITY = 0.8
#: Texts with similarity 0.8 differ in 9.6 of 64 bits on average, with a deviation of 2.8: of simulated pairs
#: at 0.80 to 0.84 about one in 100,000 is beyond this.
RADIUS = 23
#: First bit and number of bits of each block.
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
#: Longs of the filter of benchmark shingles: 2 ** 24 bits, whatever the benchmark.
FILTER_LONGS = 1 << 18

_WORDS = r"[^\p{L}\p{N}]+"
_LANES = "281479271743489L"  # the lowest bit of every 16: a long counts four bits at once


def _grams(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the hashes of all five-word shingles of a text, in order; none for shorter texts."""
    words = ", ".join(f"__words[i + {k}]" for k in range(SHINGLE))
    df = df.withColumn("__words", F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), _WORDS), ""))
    return df.withColumn(out, once(f"""CASE WHEN size(__words) >= {SHINGLE}
        THEN transform(sequence(0, size(__words) - {SHINGLE}), i -> xxhash64({words}))
        ELSE CAST(array() AS array<bigint>) END""")).drop("__words")


def _fingerprint(grams: str) -> str:
    """SimHash of an array of hashes as SQL: a bit is set if it is in over half of them.

    Sixteen sums hold four counters each, of 16 bits; arrays of over 32,767 are summed by parts, so
    that the highest counter keeps clear of the sign. The array and the sums are worked out once.
    """
    part = ", ".join(
        f"aggregate(part, 0L, (a, h) -> a + (shiftrightunsigned(h, {k}) & {_LANES}))" for k in range(16))
    parts = "transform(sequence(0, (size(gs) - 1) div 32767), i -> slice(gs, i * 32767 + 1, 32767))"
    bits = " | ".join(
        f"CASE WHEN 2 * aggregate(sums, 0L, (a, s) -> a + (shiftrightunsigned(s[{k}], {16 * lane}) & 65535)) "
        f"> size(gs) THEN {_one(16 * lane + k)} ELSE 0L END" for k in range(16) for lane in range(4))
    return (f"transform(array({grams}), gs -> transform(array(transform({parts}, part -> array({part}))),"
            f" sums -> {bits})[0])[0]")


def _simhash(df: DataFrame, grams: str, out: str) -> DataFrame:
    """Adds the SimHash of an array of hashes that is not empty."""
    return df.withColumn(out, F.expr(_fingerprint(grams)))


def _one(bit: int) -> str:
    return f"shiftleft(1L, {bit})"


def _block(fingerprint: str, first: int, bits: int) -> str:
    return f"(shiftrightunsigned({fingerprint}, {first}) & {(1 << bits) - 1}L)"


def _probes(fingerprint: str) -> str:
    """All (block, value) within the block radius of a fingerprint."""
    near = RADIUS // len(BLOCKS)
    out = []
    for number, (first, bits) in enumerate(BLOCKS):
        flips = [sum(1 << b for b in c) for r in range(near + 1) for c in combinations(range(bits), r)]
        out.append(f"transform(array({', '.join(f'{x}L' for x in flips)}), "
                   f"x -> named_struct('block', {number}, 'value', {_block(fingerprint, first, bits)} ^ x))")
    return f"concat({', '.join(out)})"


def items_index(benchmark: DataFrame) -> DataFrame:
    """(item_id, grams, m, fp) of the items of five words and more."""
    items = _grams(benchmark.select("item_id", "text"), "text", "grams").where(F.size("grams") > 0)
    items = items.select("item_id", "grams", F.size("grams").alias("m"))
    return cut_lineage(_simhash(items, "grams", "fp").dropDuplicates(["item_id", "grams"]))


def _filter_bits(items: DataFrame) -> DataFrame:
    """One row with FILTER_LONGS longs in which every shingle of the benchmark sets a bit."""
    spark = items.sparkSession
    bits = items.select(F.explode("grams").alias("g")).select(
        F.expr(f"g & {FILTER_LONGS - 1}L").alias("at"),
        F.expr("shiftleft(1L, CAST(shiftrightunsigned(g, 18) & 63 AS int))").alias("bit"))
    every = spark.range(FILTER_LONGS).select(F.col("id").alias("at"), F.lit(0).cast("long").alias("bit"))
    longs = every.unionByName(bits).groupBy("at").agg(F.bit_or("bit").alias("bits"))
    return cut_lineage(longs.agg(F.expr(
        "transform(array_sort(collect_list(struct(at, bits))), x -> x.bits)").alias("filter")))


def touched(docs: DataFrame, items: DataFrame) -> DataFrame:
    """ROW_KEY, grams and places (words, from 0) of the documents in which a shingle of an item may stand, stored."""
    keyed = _grams(with_row_key(docs).select(*ROW_KEY, "text"), "text", "grams").drop("text")
    tested = keyed.select(*ROW_KEY, "grams", _filter_bits(items).scalar().alias("filter"))
    places = tested.select(*ROW_KEY, "grams", once("""filter(sequence(0, size(grams) - 1), p -> size(grams) > 0 AND
        shiftrightunsigned(filter[CAST(grams[p] & 262143 AS int)], CAST(shiftrightunsigned(grams[p], 18) & 63 AS int)) & 1 = 1)
        """).alias("places")).where(F.size("places") > 0)
    return shared_table(places.dropDuplicates(ROW_KEY), "touched")


def windows(held: DataFrame, items: DataFrame) -> DataFrame:
    """ROW_KEY, start (word, from 0), m and fp of every window that begins with a shingle of an item of m shingles.

    Only places leave the row of a document, and come back with the lengths to lay there; fingerprints are
    worked out inside the row, so that no window is copied out of it.
    """
    firsts = held.select(*ROW_KEY, F.expr("inline(transform(places, p -> named_struct('start', p, 'first', grams[p])))"))
    sizes = items.select(F.explode("grams").alias("first"), "m").distinct()
    laid = firsts.join(sizes, "first").groupBy(*ROW_KEY).agg(F.collect_list(F.struct("start", "m")).alias("laid"))
    fp = _fingerprint("slice(grams, w.start + 1, w.m)")
    return held.select(*ROW_KEY, "grams").join(laid, ROW_KEY).select(*ROW_KEY, F.expr(
        f"inline(transform(laid, w -> named_struct('start', w.start, 'm', w.m, 'fp', {fp})))"))


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """ROW_KEY, item_id, start_word, n_words, similarity and distance: the best window of each document and item.

    Documents are told apart by their whole row; null texts hold nothing. A window
    cut off by the end of its document is compared with what it has.
    """
    items = items_index(benchmark)
    held = touched(docs, items)
    index = items.select("item_id", F.col("m"), F.col("fp").alias("item_fp"), F.expr(f"inline({_probes('fp')})"))
    blocks = F.expr("array(" + ", ".join(
        f"named_struct('block', {k}, 'value', {_block('fp', *b)})" for k, b in enumerate(BLOCKS)) + ")")
    met = windows(held, items).select(*ROW_KEY, "start", "m", "fp", F.inline(blocks)).join(index, ["m", "block", "value"])
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    # A pair that meets in several blocks is taken at the first of them.
    earlier = [f"NOT (block > {k} AND bit_count({_block('fp', *b)} ^ {_block('item_fp', *b)}) <= {RADIUS // len(BLOCKS)})"
               for k, b in enumerate(BLOCKS[:-1])]
    near = met.where(distance <= RADIUS).where(" AND ".join(earlier)).groupBy(*ROW_KEY, "item_id", "m").agg(
        F.collect_list(F.struct("start", distance.alias("distance"))).alias("at"))
    # Shingles are joined once for a document and an item, however many windows are to be verified.
    pairs = held.select(*ROW_KEY, "grams").join(near, ROW_KEY).join(
        items.select("item_id", "m", F.col("grams").alias("other")), ["item_id", "m"])
    shared = """CASE WHEN size(array_distinct(gs)) = size(gs) OR size(array_distinct(other)) = size(other)
        THEN size(array_intersect(gs, other))
        ELSE aggregate(array_intersect(gs, other), 0, (a, g) ->
            a + least(size(filter(gs, x -> x = g)), size(filter(other, x -> x = g)))) END"""
    judged = f"""transform(array(slice(grams, w.start + 1, m)), gs -> transform(array({shared}), both ->
        round(both / (size(gs) + size(other) - both), 6))[0])[0]"""
    best = F.expr(f"""array_max(transform(at, w -> named_struct(
        'similarity', {judged}, 'before', -w.start, 'close', -w.distance, 'm', m)))""")
    found = pairs.select(*ROW_KEY, "item_id", best.alias("best")).groupBy(*ROW_KEY, "item_id").agg(
        F.max("best").alias("best")).where(F.col("best.similarity") >= SIMILARITY)
    long = found.select(*ROW_KEY, "item_id", (-F.col("best.before")).alias("start_word"),
                        (F.col("best.m") + SHINGLE - 1).alias("n_words"), "best.similarity",
                        (-F.col("best.close")).alias("distance"))
    return long.unionByName(short_items(docs, benchmark))


def short_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The same columns for items of one to four words: the first place where exactly these words stand.

    Documents are only read for the lengths that occur, four at most.
    """
    def words(df: DataFrame) -> DataFrame:
        return df.withColumn("__words", F.array_remove(F.split(F.lower(F.coalesce("text", F.lit(""))), _WORDS), ""))

    items = words(benchmark.select("item_id", "text")).where(F.size("__words").between(1, SHINGLE - 1))
    items = cut_lineage(items.select("item_id", F.size("__words").alias("n"), F.array_join("__words", " ").alias("gram")).distinct())
    found = []
    for n in sorted(r.n for r in items.select("n").distinct().collect()):
        held = words(with_row_key(docs).select(*ROW_KEY, "text")).where(F.size("__words") >= n)
        places = held.select(*ROW_KEY, F.expr(f"""inline(transform(sequence(0, size(__words) - {n}), i -> named_struct(
            'start', i, 'gram', array_join(slice(__words, i + 1, {n}), ' '))))"""))
        first = places.groupBy(*ROW_KEY, "gram").agg(F.min("start").alias("start_word"))
        found.append(join_small(first, cut_lineage(items.where(F.col("n") == n)), "gram").select(
            *ROW_KEY, "item_id", "start_word", F.col("n").alias("n_words")))
    every = found[0] if found else with_row_key(docs).limit(0).select(
        *ROW_KEY, F.lit(0).cast(benchmark.schema["item_id"].dataType).alias("item_id"), F.lit(0).alias("start_word"), F.lit(0).alias("n_words"))
    for more in found[1:]:
        every = every.unionByName(more)
    return every.groupBy(*ROW_KEY, "item_id").agg(F.max(F.struct("n_words", (-F.col("start_word")).alias("before"))).alias("b")).select(
        *ROW_KEY, "item_id", (-F.col("b.before")).alias("start_word"), "b.n_words", F.lit(1.0).alias("similarity"),
        F.lit(0).alias("distance"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold no passage of the benchmark. All their columns come back, repeated rows too."""
    found = contaminations(docs, benchmark).select(*ROW_KEY).distinct()
    return with_row_key(docs).join(cut_lineage(found), ROW_KEY, "left_anti").select(*docs.columns)


@query()
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item found in it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contaminations(docs, table(spark, sf_dir, "benchmark"))
    return with_row_key(docs).select("doc_id", *ROW_KEY).distinct().join(found, ROW_KEY).drop(*ROW_KEY)
