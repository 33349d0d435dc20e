"""Information-theoretic sanitisation of personal data.

Patterns find the protected entities. Around them, corpus co-occurrence tells how much a term
gives them away: with IC(kind) = -log p(kind) and PMI(term; kind) estimated from the words
in the contexts of the kind and in the whole corpus, the disclosure of a term is PMI / IC. It is
1 for a term met only beside such entities and 0 for one that is independent of them. Terms above
a threshold are generalised, above a higher one removed, wherever they stand in any text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civitally.session import cut_lineage

from .registry import query, table
from .rows import ROW_KEY, small_batches, with_row_key

KINDS = ("email", "ip", "card", "phone")
#: Words on either side of an entity that make its context, looked for in so many characters.
CONTEXT_WORDS, CONTEXT_CHARS = 3, 64
#: Different entities a term must stand beside, and the disclosures from which it is treated.
MIN_ENTITIES, GENERALISE, REMOVE = 3, 0.6, 0.9
#: Bits of the filter that candidate terms leave for the count of all words; its size is fixed.
FILTER_BITS = 1 << 22
_BITMAP = 32768  # bits of one bitmap of bitmap_construct_agg

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits begins, and never gives digits back.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W\d_][\w'-]*")
#: Necessary for any entity; texts without it have none.
MAY_HOLD = r"@|\+[0-9]|[0-9]\.[0-9]|[0-9](?:[ -]?[0-9]){13}"


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from the @ outwards so that long runs cost their length only."""
    floor, at = 0, text.find("@")
    while at >= 0:
        before = text[floor:at]
        local = len(before) - len(before.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at) if local else None
        if m:
            yield at - local, m.end()
        floor = m.end() if m else at + 1
        at = text.find("@", floor)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of kind, end) of all entities, sorted."""
    spans = [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            spans.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def _marks(text: str) -> list[dict]:
    """Entities, and the words of their contexts with the entity they stand beside."""
    spans = base_spans(text)
    taken = [(s, e) for s, _, e in spans]
    out = []
    for start, kind, end in spans:
        value = int(np.uint64(xxhash.xxh64_intdigest(text[start:end].encode(), 1)).view(np.int64))
        out.append({"kind": kind, "start": start, "end": end, "value": value, "term": None})
        left = max(0, start - CONTEXT_CHARS)
        before = [m for m in _WORD.finditer(text, left, start) if not (m.start() == left > 0 and text[left - 1].isalnum())]
        after = [m for m in _WORD.finditer(text, end, end + CONTEXT_CHARS) if not (
            m.end() == end + CONTEXT_CHARS < len(text) and text[m.end()].isalnum())]
        for m in before[-CONTEXT_WORDS:] + after[:CONTEXT_WORDS]:
            if not any(s < m.end() and m.start() < e for s, e in taken):
                out.append({"kind": kind, "start": m.start(), "end": m.end(), "value": value, "term": m[0].lower()})
    return out


def _bits(terms: DataFrame) -> np.ndarray:
    """Filter of the terms' hashes: at most FILTER_BITS bits, however many terms there are."""
    place = F.pmod(F.xxhash64("term"), F.lit(FILTER_BITS))
    parts = terms.groupBy((place / _BITMAP).cast("int").alias("part")).agg(
        F.bitmap_construct_agg((place % _BITMAP).cast("long")).alias("bits"))
    bits = np.zeros((FILTER_BITS // _BITMAP, _BITMAP // 8), np.uint8)
    for part, found in parts.collect():
        bits[part] = np.frombuffer(found, np.uint8)
    return bits.reshape(-1)


def word_totals(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, total) over all words of all texts for every one of ``terms`` that occurs, and a few more; null: all words."""
    bits = _bits(terms)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: Counter = Counter()
            for text in batch["text"]:
                counts.update(map(str.lower, _WORD.findall(text)))
            words = list(counts)
            hashes = np.fromiter((xxhash.xxh64_intdigest(w.encode(), 42) for w in words), np.uint64, len(words))
            places = (hashes % np.uint64(FILTER_BITS)).astype(np.int64)
            kept = np.flatnonzero(bits[places >> 3] >> (places & 7).astype(np.uint8) & 1)
            rows = [(words[i], counts[words[i]]) for i in kept] + [(None, counts.total())]
            yield pd.DataFrame(rows, columns=["term", "n"])

    return docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInPandas(
        count, "term string, n long").groupBy("term").agg(F.sum("n").alias("total"))


def disclosing_terms(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """(term, kind, disclosure) of the terms to treat, from ``marks`` and the words of ``docs``."""
    beside = marks.where("term IS NOT NULL")
    pairs = cut_lineage(
        beside.groupBy("term", "kind", "value").agg(F.count("*").alias("n"))
        .groupBy("term", "kind").agg(F.sum("n").alias("together"), F.count("*").alias("entities"))
        .where(F.col("entities") >= MIN_ENTITIES))
    totals = cut_lineage(word_totals(docs, pairs.select("term").distinct()))
    kinds = beside.groupBy("kind").agg(F.count("*").alias("near"))
    words = totals.where("term IS NULL").agg(F.sum("total")).scalar()
    # A word that is cut short by the entity it touches may be no word of any text.
    known = pairs.join(totals, "term", "left").join(kinds, "kind").withColumn("total", F.coalesce("total", "together"))
    # A kind that is as common as words tells nothing: its IC is 0.
    ic = F.log(words / F.col("near"))
    disclosure = F.when(ic > 0, 1 - F.log(F.greatest("total", "together") / F.col("together")) / ic).otherwise(F.lit(0.0))
    return known.select("term", "kind", F.round(disclosure, 9).alias("disclosure")).where(
        F.col("disclosure") >= GENERALISE)


def occurrences(keyed: DataFrame, terms: DataFrame) -> DataFrame:
    """(row key, start, end, term) of every word that may be one of ``terms`` and is not part of an entity."""
    bits = _bits(terms)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known: dict[str, bool] = {}
            rows = []
            for *key, text in batch.itertuples(index=False):
                words = {w.lower() for w in _WORD.findall(text)}
                new = [w for w in words if w not in known]
                hashes = np.fromiter((xxhash.xxh64_intdigest(w.encode(), 42) for w in new), np.uint64, len(new))
                places = (hashes % np.uint64(FILTER_BITS)).astype(np.int64)
                known.update(zip(new, (bits[places >> 3] >> (places & 7).astype(np.uint8) & 1).tolist()))
                if not any(map(known.get, words)):
                    continue
                taken = base_spans(text)
                rows += [(*key, m.start(), m.end(), w) for m in _WORD.finditer(text) if known[w := m[0].lower()]
                         and not any(s < m.end() and m.start() < e for s, _, e in taken)]
            yield pd.DataFrame(rows, columns=[*ROW_KEY, "start", "end", "term"])

    return keyed.where("text IS NOT NULL").select(*ROW_KEY, "text").mapInPandas(
        find, f"{ROW_KEY[0]} long, {ROW_KEY[1]} long, start int, end int, term string")


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with ``pii_spans``: entities and terms of the whole text, in order.

    A span has start and end (code points, end exclusive), kind (email, ip, card, phone or
    term) and ``action``: mask, generalise or remove. Null and empty texts have none. Equal
    rows have equal spans; null ids do not matter, as rows are told apart by their content.
    Disclosing terms are spans wherever they stand, in texts without an entity too. Where no term discloses
    anything, only texts that may hold an entity are joined and others pass through.
    """
    @F.pandas_udf("array<struct<kind: int, start: int, end: int, value: long, term: string>>")
    def detect(texts: pd.Series) -> pd.Series:
        return texts.map(_marks)

    kept = [c for c in docs.columns if c not in ("pii_spans", *ROW_KEY)]
    keyed = with_row_key(small_batches(docs).select(*kept))
    may = F.coalesce(F.col("text").rlike(MAY_HOLD), F.lit(False))
    marks = keyed.where(may).select(*ROW_KEY, detect("text").alias("marks")).where(F.size("marks") > 0)
    marks = cut_lineage(marks.dropDuplicates(ROW_KEY).select(*ROW_KEY, F.inline("marks")))
    telling = cut_lineage(disclosing_terms(docs, marks).groupBy("term").agg(F.max("disclosure").alias("d")))
    if telling.isEmpty():
        asked, terms = may, marks.limit(0).select(*ROW_KEY, "start", "end", F.lit(0.0).alias("d"))
    else:
        # A word cut short by the entity it touches is a term beside it, but no word of the text.
        beside = marks.where("term IS NOT NULL").select(*ROW_KEY, "start", "end", "term")
        asked, terms = F.lit(True), beside.unionByName(occurrences(keyed, telling)).join(telling, "term").groupBy(
            *ROW_KEY, "start", "end").agg(F.max("d").alias("d"))
    names = F.array(*map(F.lit, KINDS))
    spans = marks.where("term IS NULL").select(
        *ROW_KEY, F.struct("start", F.col("kind").alias("order"), "end", names[F.col("kind")].alias("kind"),
                           F.lit("mask").alias("action")).alias("span"))
    spans = spans.unionByName(terms.select(*ROW_KEY, F.struct(
        "start", F.lit(len(KINDS)).alias("order"), "end", F.lit("term").alias("kind"),
        F.when(F.col("d") >= REMOVE, "remove").otherwise("generalise").alias("action")).alias("span")))
    spans = spans.groupBy(*ROW_KEY).agg(F.sort_array(F.collect_list("span")).alias("pii_spans"))
    none = F.array().cast(spans.schema["pii_spans"].dataType)
    held = keyed.where(asked).join(spans, ROW_KEY, "left")
    return held.select(*kept, F.coalesce("pii_spans", none).alias("pii_spans")).unionByName(
        keyed.where(~asked).select(*kept, none.alias("pii_spans")))


def _treat(text: str, spans) -> str:
    """Text with spans masked, generalised or removed; spans inside an earlier one go with it."""
    out, at = [], 0
    for span in spans:
        if span["start"] < at:
            at = max(at, span["end"])
            continue
        out.append(text[at:span["start"]])
        if span["action"] == "mask":
            out.append(f"<{span['kind'].upper()}>")
        elif span["action"] == "generalise":
            out.append("<NAME>" if text[span["start"]].isupper() else "<TERM>")
        at = span["end"]
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with entities masked and disclosing terms generalised or removed; n_chars follows if it is there.

    Texts without spans are untouched; null stays null. The columns of ``docs`` come back.
    """

    @F.pandas_udf("string")
    def treat(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_treat(t, s) for t, s in zip(texts, spans)], dtype=object)

    spanned = with_spans(docs)
    changed = spanned.where(F.size("pii_spans") > 0).withColumn("text", treat("text", "pii_spans"))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.unionByName(spanned.where(F.size("pii_spans") == 0)).select(*docs.columns)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


@query()
def op1_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities and treated terms of every document."""
    spanned = with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.expr(f"CAST(size(filter(pii_spans, s -> s.kind = '{k}')) AS long)").alias(f"n_{k}") for k in KINDS]
    base = F.filter("pii_spans", lambda s: s.kind != "term")
    return spanned.select("doc_id", *counts, F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
                          _listed(F.col("pii_spans")).alias("spans"))
