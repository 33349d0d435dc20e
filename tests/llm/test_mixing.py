from __future__ import annotations

import random

from pyspark.sql import functions as F

from civitally.llm import mixing


def fill(budget, nodes):
    """{name: (weight, capacity)} filled by rounds: whoever is short frees the rest."""
    out, open_ = {}, {k: v for k, v in nodes.items() if v[0] > 0}
    while open_:
        level = (budget - sum(out.values())) / sum(w for w, _ in open_.values())
        short = {k: c for k, (w, c) in open_.items() if c < w * level}
        if not short:
            return {**{k: 0 for k in nodes}, **out, **{k: int(w * level) for k, (w, _) in open_.items()}}
        out |= short
        open_ = {k: v for k, v in open_.items() if k not in short}
    return {**{k: 0 for k in nodes}, **out}


def test_shortages_go_to_siblings(spark):
    rnd = random.Random(3)
    rows, want = [], {}
    for parent in range(40):
        nodes = {f"c{i}": (rnd.choice([0, 1, 2, 5]), rnd.choice([0, 3, 50, 400])) for i in range(rnd.randint(1, 7))}
        given = rnd.randint(0, 900)
        want |= {(parent, k): v for k, v in fill(given, nodes).items()}
        rows += [(parent, k, w, c, given) for k, (w, c) in nodes.items()]
    df = spark.createDataFrame(rows, "p int, c string, weight int, capacity long, given long")
    found = {(r.p, r.c): r.budget for r in mixing.share_budget(df, ["p"], "c").collect()}
    assert {k: v for k, v in found.items() if abs(v - want[k]) > 1} == {}


def test_shortage_stays_below_its_ancestor(spark):
    leaves = spark.createDataFrame(
        [("a", "x", 1, 10), ("a", "y", 1, 1000), ("b", "x", 1, 1000), ("b", "y", 1, 1000)],
        "d string, l string, weight int, capacity long")
    found = {(r.d, r.l): r.budget for r in mixing.budgets(leaves, ["d", "l"], F.lit(400).cast("long")).collect()}
    assert found == {("a", "x"): 10, ("a", "y"): 190, ("b", "x"): 100, ("b", "y"): 100}


def test_weights_hold_whatever_lies_below(spark):
    # Domain a has ten sources, b one; a zero weight below takes nothing from its ancestors' siblings.
    rows = [("a", f"s{i}", 10_000, 5, 1) for i in range(10)] + [("b", "t", 10_000, 3, 1), ("c", "u", 10_000, 2, 1), ("c", "v", 99_000, 2, 0)]
    leaves = spark.createDataFrame(rows, "d string, s string, capacity long, __w0 int, __w1 int")
    found = {(r.d, r.s): r.budget for r in mixing.budgets(leaves, ["d", "s"], F.lit(10_000).cast("long")).collect()}
    assert {d: sum(b for (x, _), b in found.items() if x == d) for d in "abc"} == {"a": 5000, "b": 3000, "c": 2000}
    assert found["c", "v"] == 0
    found = {(r.d, r.s): r.budget for r in mixing.budgets(leaves, ["d", "s"], F.lit(100_000).cast("long")).collect()}
    assert (found["b", "t"], found["c", "u"], sum(b for (x, _), b in found.items() if x == "a")) == (10_000, 10_000, 80_000)


def test_shares_of_the_given_table(spark):
    docs = mixing.with_domain(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    found = {r.domain: r.n for r in mixing.mix(docs, weight=mixing.target_weight(), share=0.3).groupBy("domain").agg(
        F.sum("tokens").alias("n")).collect()}
    total = sum(found.values())
    assert all(abs(found[d] / total - w / 10) < 0.01 for d, w in mixing.DOMAIN_WEIGHTS.items())


def test_prefix_of_the_next_epoch(spark):
    rnd = random.Random(8)
    rows = [(i, " ".join(["w"] * rnd.randint(0, 30)), "en", f"s{i % 2}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    weight = F.when(F.col("source") == "s0", 9).otherwise(1)
    found = mixing.mix(docs, ("lang", "source"), weight, share=0.9).collect()
    tokens = {s: sum(len(t.split()) for _, t, _, x in rows if x == s) for s in ("s0", "s1")}
    total = int(0.9 * sum(tokens.values()))
    for source, share in (("s0", 0.9), ("s1", 0.1)):
        taken = sum(r.tokens for r in found if r.source == source)
        assert 0 <= int(total * share) - taken <= 30
    order = {i: mixing_hash(1, i) for i, *_ in rows}
    second = {r.doc_id for r in found if r.source == "s0" and r.epoch == 1}
    assert second and max(order[i] for i in second) < min(
        order[i] for i, t, _, s in rows if s == "s0" and i not in second and t)


def mixing_hash(epoch, doc_id):
    import hashlib

    return hashlib.md5(f"{mixing.SEED}:{epoch}:{doc_id}".encode()).hexdigest()
