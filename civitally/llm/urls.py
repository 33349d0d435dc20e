"""URL filter: ordered host and path rules, and a ratio of character language models for the rest.

The rules label the URLs they fit. From those, two variable-order Markov models of characters are
counted, one of accepted and one of rejected URLs: contexts of none to five characters of the whole URL,
each smoothed by the next shorter one (Witten-Bell), so that a rare context falls back on what is
known of its end. The models are a table of the different character sequences, which grows with the
URLs. A URL's score is its mean log ratio; the threshold is the one that parts labelled
URLs kept out of the counts best. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from civitally.session import cut_lineage

from .registry import query, table
from .rows import join_small, once

#: (verdict, host/path): a rule fits its host and all subdomains where the path starts as given.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))
#: Characters of the longest context, and the marks of a URL's start and end.
ORDER, START, END = 5, "\x02", "\x03"
#: Units in which log ratios are kept, so that their sums are exact.
UNITS = 1_000_000
#: Thresholds are tried in steps of 0.01 from -5 to 5.
STEPS = 500

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with host (A-Z lower-cased) and path; both empty for a null url or one without ``://``."""
    at = F.col(f"`{url}`")
    rest = F.when(F.instr(at, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)"))
    rest = F.coalesce(rest, F.lit(""))
    return pages.withColumns({
        "host": F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER),
        "path": F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)})


def _first_fit(rules: Sequence[tuple[str, str]], value) -> Column:
    """Of the rules that fit host and path the longest one's value, else null."""
    out = F.lit(None).cast("string")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        host, _, path = rule.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(f"/{path}")
        out = F.when(fits, F.lit(value(verdict, rule))).otherwise(out)
    return out


def with_rule(parts: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    return parts.withColumns({"rule": _first_fit(rules, lambda v, r: r), "__label": _first_fit(rules, lambda v, r: v)})


def _with_windows(urls: DataFrame) -> DataFrame:
    """``urls`` with one row per ``window``; the characters are split once."""
    signs = F.concat(F.lit(START), F.translate("url", _UPPER, _LOWER), F.lit(END))
    held = urls.withColumn("__signs", F.array_remove(F.split(signs, ""), ""))
    cut = once(f"""transform(sequence(1, size(__signs) - 1), i -> array_join(slice(
        __signs, greatest(i - {ORDER - 1}, 1), least(i + 1, {ORDER + 1})), ''))""")
    return held.withColumn("__windows", cut).select(*urls.columns, F.explode("__windows").alias("window"))


def log_ratios(urls: DataFrame) -> DataFrame:
    """(window, ratio) for every window of ``urls`` (url, n, label; null: not counted), in UNITS.

    ``ratio`` is log p(accepted) - log p(rejected) of the window's last character behind the others. A window's
    ends are the same event behind shorter contexts, so all counts come from the different windows.
    Per class a context seen n times before t different characters leaves t / (n + t) to the shorter context,
    and no context leaves it evenly to all characters counted and one more.
    """
    by = {v: F.coalesce(F.sum(F.when(F.col("label") == v, F.col("n"))), F.lit(0)).alias(v) for v in ("allow", "block")}
    counted = _with_windows(urls).groupBy("window").agg(*by.values())
    ends = counted.withColumn("j", F.explode(F.sequence(F.lit(1), F.length("window")))).select(
        F.expr("right(window, j)").alias("gram"), "j", "allow", "block")
    grams = cut_lineage(ends.groupBy("gram", "j").agg(*(F.sum(v).alias(v) for v in by)))
    behind = F.expr("left(gram, j - 1)").alias("context")
    contexts = cut_lineage(grams.groupBy("j", behind).agg(
        *(F.sum(v).alias(f"n_{v}") for v in by), *(F.count_if(F.col(v) > 0).alias(f"t_{v}") for v in by)))
    signs = grams.where("j = 1 AND allow + block > 0").agg(F.count("*") + 1).scalar()
    known, shorter = [], None
    for j in range(1, ORDER + 2):
        rows = join_small(grams.where(F.col("j") == j).select("gram", *by, behind),
                          contexts.where(F.col("j") == j).drop("j"), "context")
        if shorter is None:
            rows = rows.select("*", *((F.lit(1.0) / signs).alias(f"p_{v}") for v in by))
        else:
            rows = join_small(rows.withColumn("end", F.expr(f"right(gram, {j - 1})")), shorter, "end")
        p = {v: F.when(F.col(f"n_{v}") > 0, (F.col(v) + F.col(f"t_{v}") * F.col(f"p_{v}")) / (
            F.col(f"n_{v}") + F.col(f"t_{v}"))).otherwise(F.col(f"p_{v}")).alias(f"p_{v}") for v in by}
        level = cut_lineage(rows.select("gram", *p.values()))
        shorter = level.withColumnRenamed("gram", "end")
        known.append(level)
    every = known[0]
    for level in known[1:]:
        every = every.unionByName(level)
    ratio = F.round((F.log("p_allow") - F.log("p_block")) * UNITS).cast("long")
    return counted.select("window").join(every, F.col("window") == F.col("gram")).select("window", ratio.alias("ratio"))


def with_score(urls: DataFrame, ratios: DataFrame) -> DataFrame:
    """url and ``score`` of every different url."""
    met = join_small(_with_windows(urls.select("url")), ratios, "window")
    return met.groupBy("url").agg(F.round(F.sum("ratio") / F.count("*") / UNITS, 6).alias("score"))


def threshold(scored: DataFrame) -> DataFrame:
    """One row with the ``least`` score to accept: the smallest with the best balanced accuracy, 0 where a label is missing."""
    step = F.greatest(F.lit(-STEPS), F.least(F.lit(STEPS), F.floor(F.col("score") * 100))).cast("int")
    by = scored.groupBy(step.alias("step")).agg(
        *(F.sum(F.when(F.col("__label") == v, F.col("n"))).alias(v) for v in ("allow", "block")))
    up = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)  # at most 1,001 rows
    both = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    below = {v: F.try_divide(F.coalesce(F.sum(v).over(up), F.lit(0)), F.sum(v).over(both)) for v in ("allow", "block")}
    gain = F.round(below["block"] - below["allow"], 9)
    best = by.select("step", gain.alias("gain")).where("gain IS NOT NULL").agg(
        F.max(F.struct("gain", (-F.col("step")).alias("low"))).alias("best"))
    return best.select(F.coalesce(-F.col("best.low") / 100, F.lit(0.0)).alias("least"))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, score and verdict; a rule decides before the models.

    Equal URLs are judged once and counted as often as they occur. A null URL is read as an empty one, which
    has its end alone to score; very long ones are scored whole. Repeated rows stay. Without labelled URLs
    all characters are alike and the threshold is 0, so all is accepted. Columns of ``pages`` named
    host, path, rule, score or verdict are replaced, all others stay; ``__`` names are reserved.
    """
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "score", "verdict")]
    quoted = [F.col(f"`{c}`") for c in kept]
    given = F.coalesce(F.col(f"`{url}`"), F.lit(""))
    different = pages.select(given.alias("url")).groupBy("url").agg(F.count("*").alias("n"))
    aside = F.substring(F.md5(F.col("url").cast("binary")), 1, 1).isin("0", "1", "2", "3")
    urls = cut_lineage(with_rule(with_parts(different), rules).withColumn("__aside", aside))
    counted = F.when(~F.col("__aside"), F.col("__label"))
    ratios = cut_lineage(log_ratios(urls.select("url", "n", counted.alias("label"))))
    scored = cut_lineage(urls.join(with_score(urls, ratios), "url"))
    least = cut_lineage(threshold(scored.where("__aside AND __label IS NOT NULL")))
    verdict = F.coalesce("__label", F.when(F.col("score") >= least.scalar(), "allow").otherwise("block"))
    judged = scored.select(F.col("url").alias("__url"), "host", "path", "rule", "score", verdict.alias("verdict"))
    return join_small(pages.select(*quoted, given.alias("__url")), cut_lineage(judged), "__url").select(
        *quoted, "host", "path", "rule", "score", "verdict")


def _probability(j: int) -> str:
    """SQL of the level of grams of j characters."""
    def p(v: str, before: str) -> str:
        return f"CASE WHEN n_{v} > 0 THEN ({v} + t_{v} * {before}) / (n_{v} + t_{v}) ELSE {before} END AS p_{v}"

    if j == 1:
        one = "(1.0::DOUBLE / (SELECT count(*) + 1 FROM g WHERE j = 1 AND allow + block > 0))"
        return f"p1 AS MATERIALIZED (SELECT gram, {p('allow', one)}, {p('block', one)} FROM g JOIN c ON c.j = 1 WHERE g.j = 1)"
    return (f"p{j} AS MATERIALIZED (SELECT g.gram, {p('allow', 's.p_allow')}, {p('block', 's.p_block')} FROM g"
            f" JOIN c ON c.j = {j} AND c.context = left(g.gram, {j - 1}) JOIN p{j - 1} s ON s.gram = right(g.gram, {j - 1})"
            f" WHERE g.j = {j})")


_SQL = rf"""
WITH u AS (SELECT coalesce(url, '') AS url, count(*) AS n FROM pages GROUP BY 1),
p AS (SELECT *, coalesce(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END, '') AS rest FROM u),
q AS (SELECT url, n, translate(regexp_extract(rest, '^[^/?#]*', 0), '{_UPPER}', '{_LOWER}') AS host,
   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, substr(md5(url), 1, 1) IN ('0', '1', '2', '3') AS aside FROM p),
rules(label, h, s, rule) AS (VALUES ('allow', 'com', '/', 'com/'), ('block', 'example.com', '/en/', 'example.com/en/'),
   ('allow', 'www.example.com', '/en/', 'www.example.com/en/'), ('block', 'net', '/es/', 'net/es/'), ('block', 'net', '/fr/', 'net/fr/')),
hit AS (SELECT url, arg_max(rule, length(rule)) AS rule, arg_max(label, length(rule)) AS label
   FROM q JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s) GROUP BY url),
r AS (SELECT q.*, rule, label, chr(2) || translate(q.url, '{_UPPER}', '{_LOWER}') || chr(3) AS t FROM q LEFT JOIN hit USING (url)),
w AS MATERIALIZED (SELECT url, n, CASE WHEN NOT aside THEN label END AS label, substr(t, greatest(i - 4, 1)::INT, least(i + 1, 6)::INT) AS w
   FROM r, LATERAL (SELECT unnest(range(1, length(t))) AS i)),
d AS (SELECT w, coalesce(sum(n) FILTER (label = 'allow'), 0)::BIGINT AS allow, coalesce(sum(n) FILTER (label = 'block'), 0)::BIGINT AS block FROM w GROUP BY w),
g AS MATERIALIZED (SELECT right(w, j) AS gram, j, sum(allow)::BIGINT AS allow, sum(block)::BIGINT AS block
   FROM d, LATERAL (SELECT unnest(range(1, length(w) + 1)) AS j) GROUP BY ALL),
c AS MATERIALIZED (SELECT j, left(gram, j - 1) AS context, sum(allow)::BIGINT AS n_allow, sum(block)::BIGINT AS n_block,
   count(*) FILTER (allow > 0) AS t_allow, count(*) FILTER (block > 0) AS t_block FROM g GROUP BY ALL),
{", ".join(map(_probability, range(1, ORDER + 2)))},
l AS (SELECT gram, CAST(round((ln(p_allow) - ln(p_block)) * 1000000) AS BIGINT) AS x FROM ({
    " UNION ALL ".join(f"SELECT * FROM p{j}" for j in range(1, ORDER + 2))})),
s AS MATERIALIZED (SELECT url, round(sum(x) / count(*) / 1000000, 6) AS score FROM w JOIN l ON l.gram = w.w GROUP BY url),
k AS (SELECT CAST(greatest(-500, least(500, floor(score * 100))) AS INT) AS step, sum(n) FILTER (label = 'allow') AS a, sum(n) FILTER (label = 'block') AS b
   FROM r JOIN s USING (url) WHERE aside AND label IS NOT NULL GROUP BY 1),
e AS (SELECT step, round(coalesce(sum(b) OVER up, 0) / nullif(sum(b) OVER (), 0) - coalesce(sum(a) OVER up, 0) / nullif(sum(a) OVER (), 0), 9) AS gain
   FROM k WINDOW up AS (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT coalesce((SELECT step / 100 FROM e WHERE gain IS NOT NULL ORDER BY gain DESC, step LIMIT 1), 0.0) AS least)
SELECT page_id, host, path, rule, score, coalesce(label, CASE WHEN score >= least THEN 'allow' ELSE 'block' END) AS verdict
FROM pages JOIN r ON r.url = coalesce(pages.url, '') JOIN s ON s.url = r.url, f
"""


@query(_SQL)
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts, rule, score and verdict of every page's URL."""
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")
