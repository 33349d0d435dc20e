from __future__ import annotations

import numpy as np

from civitally.llm import gru
from civitally.llm.queries import QUERIES
from civitally.llm.registry import table

SF_DIR = "/root/testdata/sf0.01"


def test_gradients(monkeypatch):
    rnd = np.random.default_rng(1)
    net = gru.fit([(b"a b c d e f", 1), (b"g h " * 40, 0)], 0.5, steps=1)
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    windows = rnd.integers(0, 7, (5, gru.WINDOW))
    windows[:, 3:][windows[:, 3:] == 0] = 1
    windows[0, 9:] = 0
    inputs = np.concatenate((np.zeros((1, 6 * gru.UNITS)), rnd.normal(size=(6, 6 * gru.UNITS))))
    weight = rnd.normal(size=5)

    def loss():
        return float(net._forward(windows, inputs)[0] @ weight)

    grads, dinputs = net._backward(windows, inputs, net._forward(windows, inputs, keep=True)[1], weight)
    for name, of in [*((k, net.p[k]) for k in grads), ("inputs", inputs)]:
        g = dinputs if name == "inputs" else grads[name]
        for _ in range(4):
            at = tuple(rnd.integers(0, n) for n in of.shape)
            if name == "inputs" and at[0] == 0:
                continue
            old, eps = of[at], 1e-6
            of[at] = old + eps
            up = loss()
            of[at] = old - eps
            slope = (up - loss()) / (2 * eps)
            of[at] = old
            assert abs(slope - g[at]) < 1e-5 * max(1, abs(slope)), (name, at)


def test_every_window_counts():
    assert gru.window_starts(0) == [0] == gru.window_starts(gru.WINDOW)
    for n in range(gru.WINDOW, 300):
        starts = gru.window_starts(n)
        assert {i for s in starts for i in range(s, s + gru.WINDOW)} == set(range(n))
        assert len(set(starts)) == len(starts) and all(b - a <= gru.STRIDE for a, b in zip(starts, starts[1:]))


def test_both_ways_to_score_agree():
    rnd = np.random.default_rng(2)
    texts = [" ".join(rnd.choice(["ab", "cd", "ef", "gh", "éé"], n)).encode() for n in (0, 1, 31, 32, 33, 500)]
    net = gru.fit([(t, i % 2) for i, t in enumerate(texts)], 0.3, steps=3)
    scores = net.scores(texts)
    for t, s in zip(texts, scores):
        words = gru.tokens(t)
        rows = np.zeros((len(gru.window_starts(len(words))), gru.WINDOW), int)
        for row, a in zip(rows, gru.window_starts(len(words))):
            row[:len(words[a:a + gru.WINDOW])] = net.numbers(words[a:a + gru.WINDOW])
        net.learn_inputs()
        logit = net._forward(rows, net.inputs)[0].max() + net.shift
        assert abs(1 / (1 + np.exp(-logit)) - s) < 1e-5


def test_held_out_accuracy(spark):
    found = QUERIES["op9_toxicity_scores"](spark, SF_DIR).join(table(spark, SF_DIR, "labels"), "doc_id").where("held_out").collect()
    assert len(found) > 80 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    assert sum(r.predicted == r.toxic for r in found) / len(found) >= 0.88
    insults = [r for r in found if r.toxic and r.predicted]
    assert len(insults) >= 0.55 * sum(r.toxic for r in found)
