"""Mixing sources to target weights by hierarchical budgets, with DataFrame functions only.

The corpus is a tree, here domain, language, source, and each of its levels has weights of its own. From the
root down every node shares its budget among its children by their weights, however many children those have. A child cannot take more than its texts give over the allowed epochs; what it cannot
take goes to its siblings by their weights, and only what all of them cannot take goes
short further up. A leaf then takes whole epochs of its documents and a prefix of one more, in an
order seeded by epoch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from civitally.session import cut_lineage

from .registry import query, table

LEVELS = ("domain", "lang", "source")
#: Times a document may be taken, the seed of the orders, and the share of all tokens to take.
EPOCHS, SEED, SHARE = 4, 7, 0.6
#: First signs of the order's hash by which a leaf is cut into parts, so that no leaf is sorted whole.
PART_SIGNS = 3
#: Tasks over which a leaf is spread when its documents get their places.
SALTS = 64
WORD = r"[^\x20\x09-\x0D]+"


def order_hash(epoch: Column, doc_id: str = "doc_id") -> Column:
    """Place of a document in the order of an epoch, as text; equal ids have equal places."""
    return F.md5(F.concat_ws(":", F.lit(str(SEED)), epoch.cast("string"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))).cast("binary"))


def share_budget(nodes: DataFrame, parents: Sequence[str], child: str) -> DataFrame:
    """Fills ``budget`` of every child: its share by weight, at most its capacity, shortages to its siblings.

    ``nodes`` has the parents' columns, child, weight, capacity and ``given``: the parent's budget.
    Sorted by capacity per weight, the first children are those that run short; the level at which
    the rest share what is left is a running sum, so one window settles all shortages.
    """
    rank = F.when(F.col("weight") > 0, F.try_divide("capacity", "weight"))
    order = Window.partitionBy(*parents).orderBy(rank.asc_nulls_last(), child)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = F.try_divide(F.col("given") - F.coalesce(F.sum("capacity").over(before), F.lit(0)), F.sum("weight").over(after))
    levels = nodes.withColumns({"__rank": rank, "__level": F.when(F.col("weight") > 0, level)})
    # The first child that the level does not fill sets the level for all after it.
    first = F.min(F.when(F.col("__level") <= F.col("__rank"), F.struct("__rank", child, "__level"))).over(
        Window.partitionBy(*parents))
    share = F.floor(F.col("weight") * first["__level"]).cast("long")
    budget = F.when(F.col("weight") <= 0, 0).otherwise(F.least("capacity", F.coalesce(share, F.col("capacity"))))
    return levels.withColumn("budget", F.greatest(budget, F.lit(0)).cast("long")).drop("__rank", "__level")


def budgets(leaves: DataFrame, levels: Sequence[str], total: Column) -> DataFrame:
    """Leaves (levels, capacity and weights) with ``budget``, from the root down.

    ``__w0``, ``__w1`` and so on are the weights of the levels, alike where a column is missing; the last one may
    be named ``weight``. A leaf below a weight of zero or less can take nothing, so it is no capacity of its ancestors.
    """
    named = {i: f"__w{i}" if f"__w{i}" in leaves.columns else "weight" if i == len(levels) - 1 and "weight" in leaves.columns
             else None for i in range(len(levels))}
    weights = {i: F.lit(1) if c is None else F.col(c) for i, c in named.items()}
    usable = F.lit(True)
    for weight in weights.values():
        usable = usable & (F.coalesce(weight, F.lit(0)) > 0)
    counted = leaves.withColumn("__usable", F.when(usable, F.col("capacity")).otherwise(0))
    given, known = None, []
    for i, child in enumerate(levels):
        nodes = counted.groupBy(*known, child).agg(F.max(weights[i]).alias("weight"), F.sum("__usable").alias("capacity"))
        if given is None:
            nodes = nodes.withColumn("given", total)
        else:
            nodes = nodes.join(given, known)
        known = [*known, child]
        given = share_budget(nodes, known[:-1], child).select(*known, F.col("budget").alias("given"))
    return leaves.join(given.withColumnRenamed("given", "budget"), known)


def plan(measured: DataFrame, levels: Sequence[str], weights: Mapping[str, Column], share: float, epochs: int) -> DataFrame:
    """Per leaf: ``whole`` epochs taken and ``cut``: the order hash up to which the next one is taken (null: nothing).

    ``measured`` has the levels, doc_id and tokens. Only totals are gathered by leaf, and by
    part of a leaf; documents are sorted only inside the one part in which a prefix ends.
    """
    leaves = measured.groupBy(*levels).agg(F.sum("tokens").alias("tokens")).withColumns(
        {f"__w{i}": weights.get(level, F.lit(1)) for i, level in enumerate(levels)})
    leaves = cut_lineage(leaves.withColumn("capacity", F.col("tokens") * epochs))
    total = F.floor(F.lit(share) * leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).scalar()).cast("long")
    planned = budgets(leaves, levels, total)
    planned = cut_lineage(planned.select(
        *levels, "budget", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0).alias("whole"),
        F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(0).alias("rest")))
    # Salted, so that the rows of a large leaf go to many tasks and are summed there first.
    salted = planned.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = measured.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    placed = dealt.join(salted, [*levels, "salt"]).select(
        *levels, "tokens", "rest", order_hash(F.col("whole")).alias("hash")).withColumn(
        "part", F.substring("hash", 1, PART_SIGNS))
    parts = placed.groupBy(*levels, "rest", "part").agg(F.sum("tokens").alias("tokens"))
    upto = Window.partitionBy(*levels).orderBy("part")
    parts = parts.withColumn("upto", F.sum("tokens").over(upto))
    ends = cut_lineage(parts.where("upto > rest").groupBy(*levels).agg(F.min(F.struct(
        "part", (F.col("upto") - F.col("tokens")).alias("before"))).alias("end")).select(*levels, "end.part", "end.before"))
    within = placed.join(ends, [*levels, "part"]).groupBy(*levels, "part", "before", "rest", "hash").agg(
        F.sum("tokens").alias("tokens"))
    within = within.withColumn("upto", F.col("before") + F.sum("tokens").over(Window.partitionBy(*levels).orderBy("hash")))
    inside = within.where("upto <= rest").groupBy(*levels).agg(F.max("hash").alias("last"))
    # All before the part in which the prefix ends, and in it what still fits; an ending before it has all parts.
    return planned.join(ends.select(*levels, "part"), list(levels), "left").join(inside, list(levels), "left").select(
        *levels, "budget", "whole", F.coalesce("last", F.col("part"), F.lit("g")).alias("cut"))


def mix(docs: DataFrame, levels: Sequence[str] = LEVELS, weight: Column | Mapping[str, Column] | None = None,
        share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """Rows of ``docs`` once for every epoch they are taken in, with ``tokens`` and ``epoch`` (from 0).

    ``weight`` gives levels a column of weights among siblings, over the level and those above; a single
    column is that of the last level, and siblings without one are alike. Zero or less takes nothing.
    ``share`` of all tokens is the budget. Null levels are a value of their own. Null
    texts have no tokens; documents without tokens come with a prefix they lie in. Rows with
    equal ids go together. The table of leaves is joined, never the texts moved by leaf
    where it is small enough to broadcast.
    """
    kept = [c for c in docs.columns if c not in ("tokens", "epoch")]
    keys = {f"__{c}": F.coalesce(F.col(c), F.lit("\u0000")) for c in levels}
    tokens = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    measured = docs.select(*kept).withColumns({**keys, "tokens": tokens})
    named, keys_of = list(keys), dict(zip(keys, levels))
    small = cut_lineage(measured.select("doc_id", *named, "tokens"))
    weights = weight if isinstance(weight, Mapping) else {} if weight is None else {levels[-1]: weight}
    leaves = plan(small.withColumnsRenamed(keys_of), levels, weights, share, epochs)
    leaves = cut_lineage(leaves.where("budget > 0").select(
        *(F.col(c).alias(k) for k, c in keys_of.items()), F.col("whole").alias("__whole"), F.col("cut").alias("__cut")))
    taken = measured.join(leaves, named)
    times = F.col("__whole") + F.when(order_hash(F.col("__whole")) <= F.col("__cut"), 1).otherwise(0)
    return taken.withColumn("__times", times.cast("int")).where("__times > 0").select(
        *kept, "tokens", F.explode(F.sequence(F.lit(0), F.col("__times") - 1)).alias("epoch"))


#: Weights of the query's levels: documents have no domain, so sources are dealt to three by number,
#: and domains, and languages within each domain, are wanted in these shares. Sources are alike.
DOMAIN_WEIGHTS = {"d0": 5, "d1": 3, "d2": 2}
LANG_WEIGHTS = {"en": 4, "de": 2, "fr": 2}


def with_domain(docs: DataFrame) -> DataFrame:
    number = F.coalesce(F.regexp_extract("source", "[0-9]+", 0).try_cast("int"), F.lit(0))
    return docs.withColumn("domain", F.concat(F.lit("d"), F.pmod(number, F.lit(3)).cast("string")))


def target_weight() -> dict[str, Column]:
    def of(column: str, weights: dict[str, int]) -> Column:
        out = F.lit(1)
        for value, weight in weights.items():
            out = F.when(F.col(column) == value, weight).otherwise(out)
        return out

    return {"domain": of("domain", DOMAIN_WEIGHTS), "lang": of("lang", LANG_WEIGHTS)}


_SQL = r"""
WITH m AS (SELECT doc_id, source, lang, 'd' || coalesce(TRY_CAST(regexp_extract(source, '[0-9]+', 0) AS INT), 0) % 3 AS domain,
   len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '')) AS tokens FROM documents),
l AS (SELECT domain, lang, source, sum(tokens) AS tokens, sum(tokens) * 4 AS capacity,
   CASE domain WHEN 'd0' THEN 5 WHEN 'd1' THEN 3 ELSE 2 END AS wd, CASE lang WHEN 'en' THEN 4 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS wl
   FROM m GROUP BY ALL),
n1 AS (SELECT domain, max(wd) AS w, sum(capacity) AS c, (SELECT CAST(floor(0.6::DOUBLE * sum(tokens)) AS BIGINT) FROM l) AS given FROM l GROUP BY ALL),
v1 AS (SELECT *, c / w AS r, (given - coalesce(sum(c) OVER (ORDER BY c / w, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
   / sum(w) OVER (ORDER BY c / w, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM n1),
b1 AS (SELECT domain, CAST(least(c, coalesce(floor(w * arg_min(CASE WHEN level <= r THEN level END, CASE WHEN level <= r THEN (r, domain) END) OVER ()), c)) AS BIGINT) AS given FROM v1),
n2 AS (SELECT domain, lang, max(wl) AS w, sum(capacity) AS c, any_value(given) AS given FROM l JOIN b1 USING (domain) GROUP BY domain, lang),
v2 AS (SELECT *, c / w AS r, (given - coalesce(sum(c) OVER (PARTITION BY domain ORDER BY c / w, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
   / sum(w) OVER (PARTITION BY domain ORDER BY c / w, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM n2),
b2 AS (SELECT domain, lang, CAST(least(c, coalesce(floor(w * arg_min(CASE WHEN level <= r THEN level END, CASE WHEN level <= r THEN (r, lang) END) OVER (PARTITION BY domain)), c)) AS BIGINT) AS given FROM v2),
n3 AS (SELECT domain, lang, source, 1 AS w, capacity AS c, tokens, given FROM l JOIN b2 USING (domain, lang)),
v3 AS (SELECT *, c / w AS r, (given - coalesce(sum(c) OVER (PARTITION BY domain, lang ORDER BY c / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
   / sum(w) OVER (PARTITION BY domain, lang ORDER BY c / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM n3),
b3 AS (SELECT domain, lang, source, tokens, CAST(least(c, coalesce(floor(w * arg_min(CASE WHEN level <= r THEN level END, CASE WHEN level <= r THEN (r, source) END)
   OVER (PARTITION BY domain, lang)), c)) AS BIGINT) AS budget FROM v3),
p AS (SELECT doc_id, domain, lang, source, m.tokens, CAST(CASE WHEN b3.tokens > 0 THEN budget // b3.tokens ELSE 0 END AS BIGINT) AS whole,
   CASE WHEN b3.tokens > 0 THEN budget % b3.tokens ELSE 0 END AS rest, budget FROM m JOIN b3 USING (domain, lang, source)),
o AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('7:' || whole || ':' || doc_id)) AS upto FROM p WHERE budget > 0)
SELECT doc_id, domain, lang, source, CAST(tokens AS BIGINT) AS tokens, CAST(unnest(range(0, whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END)) AS INT) AS epoch FROM o
"""


@query(_SQL)
def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document taken, once for each epoch."""
    docs = with_domain(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return mix(docs, weight=target_weight()).select("doc_id", "domain", "lang", "source", "tokens", "epoch")
