"""Quality rules judged by host: failures counted per host, shrunk, and joined back to documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civitally.session import cut_lineage

from .registry import query, table

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
#: A host is refused when its shrunk rate of failing documents is above this.
HOST_LIMIT = 0.5
#: Strength of the prior when all hosts fail alike, so that moments give none.
FLAT_PRIOR = 20.0

# Rules beside the base rule that count as a failure of a document towards its host.
RULES = {
    "short": "n_words < 10",
    "repeats": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "lines": "2 * n_dup_lines > n_lines",
    "words": "word_chars > 20 * n_words",
}


def _repeat_words() -> Column:
    """Words in windows found twice or more, from ``grams`` (one hash per window).

    Positions of repeated windows come from a sort of (hash, position); each covers as many
    new words as lie between it and the next one, at most a window.
    """
    at = F.expr("array_sort(transform(grams, (g, i) -> named_struct('g', g, 'i', i)))")
    repeated = F.expr("""array_sort(transform(filter(transform(byhash, (x, k) -> named_struct('i', x.i, 'twice',
        (k > 0 AND byhash[greatest(k - 1, 0)].g = x.g)
        OR (k + 1 < size(byhash) AND byhash[least(k + 1, size(byhash) - 1)].g = x.g))), x -> x.twice), x -> x.i))""")
    covered = F.expr(f"""aggregate(transform(places, (p, k) -> CASE WHEN k + 1 < size(places)
        THEN least({WINDOW}, places[least(k + 1, size(places) - 1)] - p) ELSE {WINDOW} END), 0L, (a, x) -> a + x)""")
    return at, repeated, covered


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words of the whole text.

    Null counts as empty: all zero. Windows are compared by 64-bit hashes of their words.
    """
    kept = [c for c in docs.columns if c not in (
        "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")]
    whole = F.coalesce(F.col(text), F.lit(""))
    df = docs.select(*kept, whole.alias("__text")).select(
        *kept, "__text", F.array_remove(F.split("__text", SPACE + "+"), "").alias("words"),
        F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    words = ", ".join(f"words[i + {k}]" for k in range(WINDOW))
    df = df.select(
        *kept, F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("__text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(f"""CASE WHEN size(words) >= {WINDOW}
            THEN transform(sequence(0, size(words) - {WINDOW}), i -> xxhash64({words}))
            ELSE CAST(array() AS array<bigint>) END""").alias("grams"))
    at, repeated, covered = _repeat_words()
    named = [*kept, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    none = F.expr("CAST(NULL AS array<struct<g: bigint, i: int>>)")
    df = df.select(*named, F.when(F.size(F.array_distinct("grams")) < F.size("grams"), at).otherwise(none).alias("byhash"))
    df = df.select(*named, F.when(F.col("byhash").isNotNull(), repeated).alias("places"))
    return df.select(*named, F.coalesce(F.when(F.col("places").isNotNull(), covered), F.lit(0)).cast("long")
                     .alias("n_repeat_words"))


def host_verdicts(measured: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """Per host: documents, failing ones, shrunk rate and ``host_ok``.

    A document fails by any rule. The beta prior comes from the hosts' own rates by moments: mean m and
    variance v give alpha + beta = m (1 - m) / v - 1. Of the rates' variance the part that comes from counting
    n documents, m (1 - m) / n on average, is taken off first, as it is no difference between hosts. Where
    nothing is left, or the spread exceeds what a beta allows, a flat strength is used. A null host is a
    host of its own.
    """
    failed = F.expr(" OR ".join(f"({r})" for r in RULES.values())).cast("long")
    hosts = measured.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n_docs"), F.sum(failed).alias("n_failed"))
    moments = hosts.agg(
        (F.sum("n_failed") / F.sum("n_docs")).alias("mean"), F.avg(F.lit(1.0) / F.col("n_docs")).alias("per_doc"),
        F.var_samp(F.round(F.col("n_failed") / F.col("n_docs"), 9)).alias("raw"))
    rates = moments.select("mean", F.round(F.col("raw") - F.expr("mean * (1 - mean) * per_doc"), 12).alias("spread")).select(
        "mean", F.when((F.col("spread") > 0) & (F.expr("try_divide(mean * (1 - mean), spread)") > 1),
                       F.expr("try_divide(mean * (1 - mean), spread) - 1")).otherwise(FLAT_PRIOR).alias("strength"))
    mean, strength = rates.select("mean").scalar(), rates.select("strength").scalar()
    shrunk = (F.col("n_failed") + strength * mean) / (F.col("n_docs") + strength)
    return hosts.select("host", "n_docs", "n_failed", F.round(shrunk, 6).alias("host_rate")).withColumn(
        "host_ok", F.col("host_rate") <= limit)


def judge(docs: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """Measures of every document with base_failed, the host's rate, and ``kept``.

    ``docs`` needs doc_id, text and the host column; texts are measured once. Repeated rows
    and null ids stay, each with its verdict.
    """
    measured = cut_lineage(measures(docs.select("doc_id", "text", F.col(host).alias("host"))).drop("text"))
    verdicts = host_verdicts(measured, "host", limit).withColumnRenamed("host", "h")
    base_failed = F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")
    return measured.join(verdicts, F.col("host").eqNullSafe(F.col("h")), "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & F.col("host_ok")).alias("kept"), "host", "host_rate")


_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT k, doc_id, source, t, list_filter(regexp_split_to_array(t, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS ws,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS ls FROM d),
g AS (SELECT k, i, array_to_string(ws[i:i + 4], ' ') AS gram
      FROM w, LATERAL (SELECT unnest(range(1, len(ws) - 3)) AS i)),
twice AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, gram) AS c FROM g) WHERE c > 1),
rep AS (SELECT k, count(DISTINCT i + o) AS n FROM twice, (SELECT unnest(range(0, 5)) AS o) GROUP BY k),
m AS (SELECT doc_id, source AS host, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(len(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN rep USING (k)),
h AS (SELECT host, count(*) AS n_docs, sum(CASE WHEN n_words < 10 OR 100 * n_repeat_words > 20 * n_words
        OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR word_chars > 20 * n_words THEN 1 ELSE 0 END) AS n_failed
      FROM m GROUP BY host),
o AS (SELECT sum(n_failed) / sum(n_docs) AS mean, avg(1.0::DOUBLE / n_docs) AS per_doc, var_samp(round(n_failed / n_docs, 9)) AS raw FROM h),
p AS (SELECT mean, round(raw - mean * (1 - mean) * per_doc, 12) AS spread FROM o),
s AS (SELECT mean, CASE WHEN spread > 0 AND mean * (1 - mean) / spread > 1
        THEN mean * (1 - mean) / spread - 1 ELSE 20.0 END AS strength FROM p),
v AS (SELECT host, round((n_failed + strength * mean) / (n_docs + strength), 6) AS host_rate FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND host_rate <= 0.5 AS kept, m.host, host_rate
FROM m JOIN v ON m.host IS NOT DISTINCT FROM v.host
"""


@query(_SQL)
def op8_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    return judge(table(spark, sf_dir, "documents"))
