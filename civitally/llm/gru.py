"""A small bidirectional gated recurrent network with attention pooling, in numpy.

A token enters as the sum of a word vector (words of the training sample only) and the mean of
its character trigram vectors. A text is cut into overlapping windows; its score is that
of its strongest window. Training spreads a text's label over its windows by a softmax of
their logits, so that one strong window is enough.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np

WINDOW, STRIDE = 32, 24
UNITS, WIDTH = 8, 8
TRIGRAMS = 2048
_CHUNK = 2048
_KNOWN_MOST, _BYTES = 100_000, 4 << 20
# ASCII that is neither letter nor digit parts tokens; digits count as one sign.
_SIGNS = bytes(c if c >= 128 or chr(c).isalpha() else 48 if chr(c).isdigit() else 32 for c in range(256))


def tokens(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().translate(_SIGNS).split()


def window_starts(n: int) -> list[int]:
    """Starts of the overlapping windows over ``n`` tokens; the last one ends with the text."""
    if n <= WINDOW:
        return [0]
    return [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class _Known(dict):
    """Number of every token met; number 0 is padding."""

    def __init__(self):
        super().__init__()
        self.fresh: list[bytes] = []

    def __missing__(self, token):
        self[token] = n = len(self) + 1
        self.fresh.append(token)
        return n


def _trigrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram numbers of all words, and where each word's begin; a sign marks either end."""
    data = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 2)
    whole = (data[:-2] * 961 + data[1:-1] * 31 + data[2:]) * 2654435761 % (1 << 32) % TRIGRAMS
    inside = np.ones(len(data), bool)
    inside[ends - 1] = inside[ends - 2] = False
    return whole[inside[:-2]], np.cumsum(lengths) - lengths


@dataclass
class Network:
    vocabulary: dict[bytes, int]
    p: dict[str, np.ndarray]
    shift: float = 0.0
    known: _Known = field(default_factory=_Known)
    inputs: np.ndarray = field(default_factory=lambda: np.zeros((1, 6 * UNITS), np.float32))
    halved: list | None = None

    def __getstate__(self):
        return self.vocabulary, {k: v.astype(np.float32) for k, v in self.p.items()}, self.shift

    def __setstate__(self, state):
        self.vocabulary, self.p, self.shift = state
        self._forget()

    def _forget(self):
        self.known, self.inputs, self.halved = _Known(), np.zeros((1, 6 * UNITS), np.float32), None

    def _embed(self, words: list[bytes]) -> tuple[np.ndarray, tuple]:
        number = np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int64, len(words))
        grams, starts = _trigrams(words)
        counts = np.diff(np.append(starts, len(grams)))
        x = self.p["word"][number] + np.add.reduceat(self.p["tri"][grams], starts) / counts[:, None]
        return x, (number, grams, counts)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.known.__getitem__, words), np.int32, len(words))

    def learn_inputs(self) -> None:
        """Input sums of the gates for tokens not met before."""
        if self.known.fresh:
            x, _ = self._embed(self.known.fresh)
            new = (x @ self.p["in"] + self.p["in_b"]).astype(np.float32)
            self.inputs = np.concatenate((self.inputs, new))
            self.known.fresh.clear()

    def logits(self, windows: np.ndarray) -> np.ndarray:
        return np.concatenate([
            self._forward(windows[i:i + _CHUNK], self.inputs)[0] if (windows[i:i + _CHUNK] == 0).any()
            else self._full(windows[i:i + _CHUNK]) for i in range(0, len(windows), _CHUNK)])

    def _full(self, windows: np.ndarray) -> np.ndarray:
        """As ``_forward`` for windows without padding, with features before windows and no copies kept.

        Gates use tanh(x / 2); the halves are in the weights.
        """
        p, u, (b, t) = self.p, UNITS, windows.shape
        halves = np.repeat(np.array([0.5, 0.5, 1], np.float32), u)
        order = np.ascontiguousarray(windows.T)
        states = np.empty((t, 2 * u, b), np.float32)
        if self.halved is None or len(self.halved[0]) != len(self.inputs):
            self.halved = [np.ascontiguousarray(self.inputs[:, 3 * u * w:3 * u * (w + 1)] * halves) for w in (0, 1)]
        for way in (0, 1):
            h = np.zeros((u, b), np.float32)
            weights = np.ascontiguousarray((p["rec"][way] * halves).T)
            for i in (range(t) if way == 0 else range(t - 1, -1, -1)):
                x = self.halved[way].take(order[i], axis=0).T
                a = weights @ h
                gates = a[:2 * u]
                gates += x[:2 * u]
                np.tanh(gates, out=gates)
                gates *= 0.5
                gates += 0.5
                n = a[2 * u:]
                n *= gates[u:]
                n += x[2 * u:]
                np.tanh(n, out=n)
                h -= n
                h *= gates[:u]
                h += n
                states[i, u * way:u * (way + 1)] = h
        score = np.einsum("k,tkb->tb", p["att_v"], np.tanh(np.matmul(p["att"].T, states) + p["att_b"][:, None]))
        score = np.exp(score - score.max(axis=0))
        score /= score.sum(axis=0)
        pooled = np.einsum("tb,tkb->kb", score, states)
        return p["out"] @ pooled + p["out_b"][0]

    def _forward(self, windows: np.ndarray, inputs: np.ndarray, keep: bool = False):
        """Logits of windows (rows of token numbers), and what the way back needs."""
        b, t = windows.shape
        p, u = self.p, UNITS
        mask = windows > 0
        full = bool(mask.all())
        states, steps = np.zeros((t, b, 2 * u), inputs.dtype), []
        for way in (0, 1):
            h = np.zeros((b, u), inputs.dtype)
            weights = p["rec"][way]
            for i in (range(t) if way == 0 else range(t - 1, -1, -1)):
                x = inputs[windows[:, i], 3 * u * way:3 * u * (way + 1)]
                a = h @ weights
                gates = _sigmoid(x[:, :2 * u] + a[:, :2 * u])
                z, r = gates[:, :u], gates[:, u:]
                n = np.tanh(x[:, 2 * u:] + r * a[:, 2 * u:])
                new = n + z * (h - n)
                if not full:
                    new *= mask[:, i, None]
                if keep:
                    steps.append((way, i, h, z, r, n, a[:, 2 * u:]))
                h = new
                states[i, :, u * way:u * (way + 1)] = h
        e = np.tanh(states @ p["att"] + p["att_b"])
        score = e @ p["att_v"]
        if not full:
            score = np.where(mask.T, score, -1e9)
        score = np.exp(score - score.max(axis=0))
        alpha = score / score.sum(axis=0)
        pooled = np.einsum("tb,tbk->bk", alpha, states)
        return pooled @ p["out"] + p["out_b"][0], (mask, states, steps, e, alpha, pooled)

    def _backward(self, windows, inputs, kept, dlogit) -> tuple[dict, np.ndarray]:
        mask, states, steps, e, alpha, pooled = kept
        p, u, g = self.p, UNITS, {}
        g["out"], g["out_b"] = pooled.T @ dlogit, np.array([dlogit.sum()])
        dpooled = dlogit[:, None] * p["out"]
        dstates = alpha[:, :, None] * dpooled
        dalpha = np.einsum("tbk,bk->tb", states, dpooled)
        dscore = alpha * (dalpha - (alpha * dalpha).sum(axis=0))
        g["att_v"] = np.einsum("tbk,tb->k", e, dscore)
        de = dscore[:, :, None] * p["att_v"] * (1 - e * e)
        g["att"] = np.einsum("tbi,tbj->ij", states, de)
        g["att_b"] = de.sum(axis=(0, 1))
        dstates += de @ p["att"].T
        dinputs = np.zeros_like(inputs)
        g["rec"] = np.zeros_like(p["rec"])
        carried = [np.zeros((len(windows), u)), np.zeros((len(windows), u))]
        for way, i, h, z, r, n, a in reversed(steps):
            d = (carried[way] + dstates[i, :, u * way:u * (way + 1)]) * mask[:, i, None]
            dn = d * (1 - z) * (1 - n * n)
            dz = d * (h - n) * z * (1 - z)
            dr = dn * a * r * (1 - r)
            rec = np.concatenate((dz, dr, dn * r), axis=1)
            g["rec"][way] += h.T @ rec
            carried[way] = d * z + rec @ p["rec"][way].T
            np.add.at(dinputs[:, 3 * u * way:3 * u * (way + 1)], windows[:, i], np.concatenate((dz, dr, dn), axis=1))
        return g, dinputs

    def scores(self, texts: list) -> np.ndarray:
        """Score of every text: the largest of all its windows. Few texts at a time are held as tokens."""
        out, group, size = [np.zeros(0)], [], 0
        for text in texts:
            group.append(text)
            size += len(text or b"")
            if size >= _BYTES:
                out.append(self._scores(group))
                group, size = [], 0
        return np.concatenate([*out, self._scores(group)] if group else out)

    def _scores(self, texts: list) -> np.ndarray:
        if len(self.known) > _KNOWN_MOST:
            self._forget()
        numbers = [self.numbers(tokens(t)) for t in texts]
        self.learn_inputs()
        out = np.full(len(numbers), -np.inf)
        whole = [(k, window_starts(len(x))) for k, x in enumerate(numbers) if len(x) >= WINDOW]
        for group in _bounded(whole):
            owner = np.concatenate([np.full(len(s), k) for k, s in group])
            rows = np.concatenate([
                np.lib.stride_tricks.sliding_window_view(numbers[k], WINDOW)[s] for k, s in group])
            np.maximum.at(out, owner, self.logits(rows))
        short = [k for k, x in enumerate(numbers) if len(x) < WINDOW]
        if short:
            rows = np.zeros((len(short), WINDOW), np.int32)
            for row, k in zip(rows, short):
                row[:len(numbers[k])] = numbers[k]
            out[short] = self.logits(rows)
        return _sigmoid(out.astype(np.float64) + self.shift)


def _bounded(whole, most: int = 16 * _CHUNK):
    """Texts in groups of about ``most`` windows, so that a batch of long texts stays small."""
    group, n = [], 0
    for k, starts in whole:
        group.append((k, starts))
        n += len(starts)
        if n >= most:
            yield group
            group, n = [], 0
    if group:
        yield group


def fit(rows: list[tuple[bytes, int]], share: float, steps: int = 200, batch: int = 32, rate: float = 0.02,
        seed: int = 9) -> Network:
    """Network fitted to (text, label) rows by Adam; ``share`` of label 1 in all labelled rows sets the level.

    With one class only, or none, every text scores ``share``.
    """
    rnd = np.random.default_rng(seed)
    split = [tokens(t) for t, _ in rows]
    labels = np.array([y for _, y in rows], float)
    seen = Counter(w for s in split for w in set(s))
    vocabulary = {w: i + 1 for i, w in enumerate(sorted(w for w, n in seen.items() if n >= 3))}
    near = lambda *shape: rnd.normal(0, 0.3, shape)
    p = {"word": near(len(vocabulary) + 1, WIDTH), "tri": near(TRIGRAMS, WIDTH), "in": near(WIDTH, 6 * UNITS),
         "in_b": np.zeros(6 * UNITS), "rec": near(2, UNITS, 3 * UNITS), "att": near(2 * UNITS, UNITS),
         "att_b": np.zeros(UNITS), "att_v": near(UNITS), "out": near(2 * UNITS), "out_b": np.zeros(1)}
    p["word"][0] = 0
    net = Network(vocabulary, p)
    level = np.log(share / (1 - share)) if 0 < share < 1 else (40.0 if share >= 1 else -40.0)
    if len(set(labels.tolist())) < 2:
        p["out"][:] = 0
        net.shift = level
        return net
    numbers = [net.numbers(s) for s in split]
    words = list(net.known)
    rows_of = []
    for x in numbers:
        padded = np.zeros(max(len(x), WINDOW), np.int32)
        padded[:len(x)] = x
        rows_of.append(np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[window_starts(len(x))])
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    while step < steps:
        order = rnd.permutation(len(rows))
        for at in range(0, len(order), batch):
            texts = order[at:at + batch]
            sizes = [len(rows_of[k]) for k in texts]
            used, windows = np.unique(np.concatenate([rows_of[k] for k in texts]), return_inverse=True)
            if used[0] != 0:
                used, windows = np.concatenate(([0], used)), windows + 1
            windows = windows.reshape(-1, WINDOW)
            x, (number, grams, counts) = net._embed([words[i - 1] for i in used[1:]])
            inputs = np.concatenate((np.zeros((1, 6 * UNITS)), x @ p["in"] + p["in_b"]))
            logit, kept = net._forward(windows, inputs, keep=True)
            starts = np.cumsum(sizes) - sizes
            top = np.repeat(np.maximum.reduceat(logit, starts), sizes)
            weight = np.exp(logit - top)
            weight /= np.repeat(np.add.reduceat(weight, starts), sizes)
            of_text = np.add.reduceat(weight * logit, starts)
            slope = (_sigmoid(of_text) - labels[texts]) / len(texts)
            dlogit = np.repeat(slope, sizes) * weight
            g, dinputs = net._backward(windows, inputs, kept, dlogit)
            dinputs = dinputs[1:]
            g["in"], g["in_b"] = x.T @ dinputs, dinputs.sum(axis=0)
            dx = dinputs @ p["in"].T
            g["word"], g["tri"] = np.zeros_like(p["word"]), np.zeros_like(p["tri"])
            np.add.at(g["word"], number, dx)
            g["word"][0] = 0
            np.add.at(g["tri"], grams, np.repeat(dx / counts[:, None], counts, axis=0))
            step += 1
            for k, v in g.items():
                first[k] += 0.1 * (v - first[k])
                second[k] += 0.001 * (v * v - second[k])
                p[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    # The sample holds both classes in shares of its own; move the level back to that of all rows.
    mean = labels.mean()
    net.shift = float(level - np.log(mean / (1 - mean)))
    net.p = {k: v.astype(np.float32) for k, v in p.items()}
    net._forget()
    return net
