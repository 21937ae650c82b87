"""Operator 7, toxicity by a bidirectional gated recurrent network.

Tokens are words (ASCII in lower case; words of more than ``WORD_BYTES`` bytes
count as several). A word's input is its learned vector, its log-odds of
toxic over clean training documents, and a character vector: a bidirectional
GRU with attention pooling over the word's bytes. A second bidirectional GRU
with attention pooling reads windows of ``WINDOW`` tokens that overlap by half;
every window of a text is scored and the highest counts. Everything is numpy;
training goes through the highest window of each document (multiple-instance
learning) with Adam and a fixed seed, so reruns agree.

Bounds: at most ``SAMPLE`` labelled documents of each class train the model,
each with at most ``TRAIN_BYTES`` bytes spread over the text, weighted back to
the classes' true shares; the vocabulary has at most ``VOCABULARY`` words.
Scoring reads every whole text in pieces of bounded size, with a bounded table
of known words in each worker. The model (under 2 MB) goes out by broadcast.
A score doesn't depend on the rows that share its batch: in scoring, states and
weights are multiples of 2**-20, whose products add up without rounding in any
order, and blocks have one fixed shape, the last one filled up.

Defined cases: null, empty and wordless texts score what the network says of
nothing at all; without labels of both classes every score is the share of
toxic labels (0 without labels); labels other than 0 and 1 train nothing;
repeated rows get the same score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, mapped, pieces, quoted, texts_of
from .quality import labelled_sample, remainder

WINDOW, STRIDE = 24, 12
HIDDEN, CHAR_HIDDEN = 8, 6
WORD_DIM, CHAR_DIM = 6, 8
WORD_BYTES = 24
VOCABULARY = 20_000
SAMPLE = 1500
TRAIN_BYTES = 8000
EPOCHS, STEPS, BATCH, RATE = 12, 800, 64, 0.01  # at least so many epochs, and about so many steps
KNOWN_WORDS = 200_000
WORD_BLOCK, SHORT_WORD = 512, 8  # words are spelled in blocks of short ones and of long ones
WINDOW_BLOCK = 1024
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))


def tokens(text: bytes) -> list[bytes]:
    words = text.translate(_FOLD).split()
    if words and max(map(len, words)) > WORD_BYTES:
        words = [w[i:i + WORD_BYTES] for w in words for i in range(0, len(w), WORD_BYTES)]
    return words


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def on_grid(x: np.ndarray) -> np.ndarray:
    """Rounded to multiples of 2**-20 (exact in 32 bits up to 16)."""
    return np.rint(x * np.float32(1 << 20)) * np.float32(2.0 ** -20)


def exact_product(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Matrix product of numbers on the grid: 64 bits hold every partial sum,
    so the order that a library adds them in makes no difference."""
    return (x.astype(np.float64) @ w.astype(np.float64)).astype(np.float32)


def gru(project, steps: int, rows: int, state: np.ndarray, mask=None, back=False, keep=None):
    """States (steps, rows, hidden) of one direction. ``project(t)`` gives the
    inputs' part of the gates at a step; ``keep`` collects what the gradient
    needs."""
    h = state.shape[0]
    out = np.zeros((steps, rows, h), np.float32)
    now = np.zeros((rows, h), np.float32)
    for t in (range(steps - 1, -1, -1) if back else range(steps)):
        x, g = project(t), now @ state
        zr = _sigmoid(x[:, :2 * h] + g[:, :2 * h])
        z, r = zr[:, :h], zr[:, h:]
        c = np.tanh(x[:, 2 * h:] + r * g[:, 2 * h:])
        new = c + z * (now - c)
        if mask is not None:
            new = np.where(mask[t][:, None], new, now)
        if keep is not None:
            keep.append((t, z, r, c, g[:, 2 * h:], now))
        out[t] = now = new
    return out


def by_gate(x: np.ndarray) -> np.ndarray:
    """(rows, three gates side by side) as (gate, rows, hidden)."""
    return np.ascontiguousarray(x.reshape(len(x), 3, -1).transpose(1, 0, 2))


def gru_on_grid(project, steps: int, rows: int, state: np.ndarray, mask=None, back=False):
    """As ``gru``, with the gates apart and states that stay on the grid."""
    state = by_gate(state).astype(np.float64)
    out = np.zeros((steps, rows, state.shape[2]), np.float32)
    now = out[0].copy()
    half = np.float32(0.5)
    for t in (range(steps - 1, -1, -1) if back else range(steps)):
        x, g = project(t), (now.astype(np.float64) @ state).astype(np.float32)
        zr = x[:2] + g[:2]
        zr *= half
        np.tanh(zr, out=zr)
        zr *= half
        zr += half
        c = np.tanh(x[2] + zr[1] * g[2])
        new = on_grid(c + zr[0] * (now - c))
        out[t] = now = new if mask is None else np.where(mask[t][:, None], new, now)
    return out


def gru_gradient(d_out, keep, state, mask):
    """Gradients of the gate inputs and of the recurrent weights."""
    steps, rows, h = d_out.shape
    d_in = np.zeros((steps, rows, 3 * h), np.float32)
    d_state = np.zeros_like(state)
    carry = np.zeros((rows, h), np.float32)
    for t, z, r, c, gc, before in reversed(keep):
        d = d_out[t] + carry
        on = mask[t][:, None]
        dc = d * (1 - z) * (1 - c * c) * on
        dz = d * (before - c) * z * (1 - z) * on
        dr = dc * gc * r * (1 - r)
        dg = np.concatenate([dz, dr, dc * r], 1)
        d_in[t] = np.concatenate([dz, dr, dc], 1)
        d_state += before.T @ dg
        carry = np.where(on, d * z, d) + dg @ state.T
    return d_in, d_state


def attention(states, score, mask=None, exact=False):
    """Attention-pooled states and their weights."""
    e = exact_product(states, score) if exact else states @ score
    if mask is not None:
        e = np.where(mask, e, np.float32(-1e9))
    e = np.exp(e - e.max(0))
    if mask is not None:
        e = e * mask
    a = e / np.maximum(e.sum(0), 1e-9)
    return np.einsum("tb,tbh->bh", a, states), a


def encode(weights, name, x, mask, keep=None):
    """Pooled output of a bidirectional GRU over inputs (steps, rows, dim)."""
    parts, tapes = [], []
    for way in "fb":
        p = x @ weights[f"{name}_in_{way}"] + weights[f"{name}_bias_{way}"]
        tape = None if keep is None else []
        parts.append(gru(p.__getitem__, x.shape[0], x.shape[1], weights[f"{name}_state_{way}"], mask, way == "b", tape))
        tapes.append(tape)
    states = np.concatenate(parts, 2)
    pooled, a = attention(states, weights[f"{name}_look"], mask)
    if keep is not None:
        keep[name] = (x, mask, states, a, tapes)
    return pooled


def encode_gradient(weights, grads, name, d_pooled, keep):
    """Adds the gradients of an encoder's weights; returns that of its inputs."""
    x, mask, states, a, tapes = keep[name]
    h = states.shape[2] // 2
    da = np.einsum("bh,tbh->tb", d_pooled, states)
    de = a * (da - (a * da).sum(0))
    d_states = a[:, :, None] * d_pooled[None] + de[:, :, None] * weights[f"{name}_look"]
    grads[f"{name}_look"] += np.einsum("tb,tbh->h", de, states)
    dx = np.zeros_like(x)
    for k, way in enumerate("fb"):
        d_in, d_state = gru_gradient(d_states[:, :, k * h:(k + 1) * h], tapes[k], weights[f"{name}_state_{way}"], mask)
        grads[f"{name}_state_{way}"] += d_state
        grads[f"{name}_in_{way}"] += np.tensordot(x, d_in, ([0, 1], [0, 1]))
        grads[f"{name}_bias_{way}"] += d_in.sum((0, 1))
        dx += d_in @ weights[f"{name}_in_{way}"].T
    return dx


def letters(words: list[bytes], steps: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of words, one column a word, and which of them are real."""
    size = np.array([len(w) for w in words])
    steps = steps or int(size.max())
    flat = np.frombuffer(b"".join(w.ljust(steps, b"\0") for w in words), np.uint8).reshape(len(words), steps)
    return flat.T, np.arange(steps)[:, None] < size


def window_starts(n: int) -> np.ndarray:
    """Starts of the overlapping windows of a text; the last ends with it."""
    return np.arange(0, max(n - WINDOW, 0) + STRIDE, STRIDE).clip(max=max(n - WINDOW, 0))


class Model:
    """The trained network; plain arrays, so that it can be pickled."""

    def __init__(self, texts: list[tuple[bytes, int]], shares: tuple[int, int], seed: int = 7):
        self.shares, self.weights = shares, None
        docs = [(tokens(t), y) for t, y in texts]
        docs = [(w, y) for w, y in docs if w]
        n = [sum(y == k for _, y in docs) for k in (0, 1)]
        if min(n) < 2:
            return
        rng = np.random.default_rng(seed)
        seen = {}
        for words, y in docs:
            for w in set(words):
                seen.setdefault(w, [0, 0])[y] += 1
        chosen = sorted((w for w, c in seen.items() if sum(c) > 1), key=lambda w: (-sum(seen[w]), w))[:VOCABULARY]
        self.ids = {w: i + 1 for i, w in enumerate(chosen)}
        counts = np.array([[0, 0]] + [seen[w] for w in chosen], float)
        odds = lambda c, n: np.log((c[:, 1] + 0.3) / (n[1] + 0.6)) - np.log((c[:, 0] + 0.3) / (n[0] + 0.6))
        self.odds = odds(counts, n).astype(np.float32)
        # In training a document's own words don't count for their odds.
        without = [odds(np.maximum(counts - np.eye(2)[y], 0), np.array(n) - np.eye(2)[y]).astype(np.float32) for y in (0, 1)]
        for o in (self.odds, *without):
            o[0] = 0
        self._start(rng)
        self._fit(docs, without, n, rng)

    def _start(self, rng) -> None:
        def normal(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        w = {"words": 0.1 * rng.standard_normal((len(self.ids) + 1, WORD_DIM)).astype(np.float32),
             "chars": rng.standard_normal((256, CHAR_DIM)).astype(np.float32) * np.float32(0.5),
             "out": normal(2 * HIDDEN), "out_bias": np.zeros(1, np.float32)}
        for name, dim, h in (("char", CHAR_DIM, CHAR_HIDDEN), ("word", WORD_DIM + 2 * CHAR_HIDDEN + 1, HIDDEN)):
            w[f"{name}_look"] = np.zeros(2 * h, np.float32)
            for way in "fb":
                w[f"{name}_in_{way}"], w[f"{name}_state_{way}"] = normal(dim, 3 * h), normal(h, 3 * h)
                w[f"{name}_bias_{way}"] = np.zeros(3 * h, np.float32)
        self.weights = w

    def _fit(self, docs, without, n, rng) -> None:
        w = self.weights
        share = [self.shares[k] / max(sum(self.shares), 1) for k in (0, 1)]
        weigh = [share[k] * sum(n) / n[k] for k in (0, 1)]
        w["out_bias"][:] = np.log(max(share[1], 1e-3) / max(share[0], 1e-3))
        lists = [np.array([self.ids.get(x, 0) for x in words]) for words, _ in docs]
        ys = np.array([y for _, y in docs])
        starts = [window_starts(len(x)) for x in lists]
        moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in w.items()}
        # The first choice of windows: those with the highest odds.
        best = []
        for x, y, s in zip(lists, ys, starts):
            o = np.concatenate([[0], np.cumsum(np.maximum(without[y][x], 0))])
            best.append(int(s[np.argmax(o[np.minimum(s + WINDOW, len(x))] - o[s])]))
        step, epochs = 0, min(max(EPOCHS, STEPS * BATCH // len(docs)), 8 * EPOCHS)
        for epoch in range(epochs):
            if epoch and epoch % max(1, epochs // EPOCHS) == 0:
                best = self._highest(docs, starts)
            other = [int(rng.choice(s)) for s in starts]
            todo = [(i, best[i], weigh[ys[i]]) for i in range(len(docs))]
            todo += [(i, other[i], 0.5 * weigh[0]) for i in np.flatnonzero(ys == 0) if other[i] != best[i]]
            order = rng.permutation(len(todo))
            for k in range(0, len(order), BATCH):
                part = [todo[i] for i in order[k:k + BATCH]]
                grads = self._gradient([docs[i][0][s:s + WINDOW] for i, s, _ in part], ys[[i for i, _, _ in part]],
                                       np.array([v for _, _, v in part], np.float32), without, rng)
                step += 1
                rate = RATE * (1 - epoch / epochs) + 1e-3
                for name, g in grads.items():
                    m, v = moments[name]
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    w[name] -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)

    def _gradient(self, parts, ys, weigh, without, rng):
        w, keep = self.weights, {}
        grads = {k: np.zeros_like(v) for k, v in w.items()}
        vocab = sorted({x for p in parts for x in p})
        at = {x: i for i, x in enumerate(vocab)}
        size = np.array([len(p) for p in parts])
        index = np.zeros((WINDOW, len(parts)), np.int64)
        for b, p in enumerate(parts):
            index[:len(p), b] = [at[x] for x in p]
        mask = np.arange(WINDOW)[:, None] < size
        chars, real = letters(vocab)
        known = np.array([self.ids.get(x, 0) for x in vocab])
        known = np.where(rng.random(len(vocab)) < 0.15, 0, known)  # now and then a word is unknown
        spelled = encode(w, "char", w["chars"][chars], real, keep)
        odds = np.stack([o[known] for o in without], 1)[index, ys]
        x = np.concatenate([w["words"][known][index], spelled[index], 0.3 * odds[:, :, None]], 2)
        pooled = encode(w, "word", x, mask, keep)
        p = _sigmoid(pooled @ w["out"] + w["out_bias"])
        d = (p - ys) * weigh / len(parts)
        grads["out"] += pooled.T @ d + 1e-4 * w["out"]
        grads["out_bias"] += d.sum()
        dx = encode_gradient(w, grads, "word", d[:, None] * w["out"], keep) * mask[:, :, None]
        per_word = np.zeros((len(vocab), dx.shape[2]), np.float32)
        np.add.at(per_word, index.ravel(), dx.reshape(-1, dx.shape[2]))
        np.add.at(grads["words"], known, per_word[:, :WORD_DIM])
        grads["words"] += 1e-4 * w["words"]
        dc = encode_gradient(w, grads, "char", per_word[:, WORD_DIM:WORD_DIM + 2 * CHAR_HIDDEN], keep)
        np.add.at(grads["chars"], chars.ravel(), dc.reshape(-1, CHAR_DIM) * real.reshape(-1, 1))
        return grads

    def _highest(self, docs, starts) -> list[int]:
        values = Scorer(self).windows([words for words, _ in docs])
        edges = np.cumsum([0] + [len(s) for s in starts])
        return [int(s[np.argmax(values[a:b])]) for s, a, b in zip(starts, edges, edges[1:])]


class Scorer:
    """Scores texts with a model; holds the inputs' part of the gates of the
    words met so far, a bounded number of them."""

    def __init__(self, model: Model):
        self.model = model
        if model.weights is not None:
            self.weights = {k: on_grid(v) for k, v in model.weights.items()}
            self.odds = on_grid(np.float32(0.3) * model.odds)
            self._forget()

    def _forget(self) -> None:
        self.at, self.new = {}, []
        self.gates = [np.zeros((3, KNOWN_WORDS // 8, HIDDEN), np.float32) for _ in "fb"]

    def _learn(self) -> None:
        """Gate inputs of the words met since the last call."""
        done, room = len(self.at) - len(self.new), self.gates[0].shape[1]
        if len(self.at) > room:
            more = np.zeros((3, max(room, len(self.at) - room), HIDDEN), np.float32)
            self.gates = [np.concatenate([g, more], 1) for g in self.gates]
        size = np.array([len(x) for x in self.new])
        for steps, group in ((SHORT_WORD, np.flatnonzero(size <= SHORT_WORD)), (WORD_BYTES, np.flatnonzero(size > SHORT_WORD))):
            for k in range(0, len(group), WORD_BLOCK):
                self._spell(done, group[k:k + WORD_BLOCK], steps)
        self.new = []

    def _spell(self, done: int, part: np.ndarray, steps: int) -> None:
        w, ids = self.weights, self.model.ids
        words = [self.new[i] for i in part] + [b""] * (WORD_BLOCK - len(part))
        chars, real = letters(words, steps)
        parts = []
        for way in "fb":
            p = by_gate(exact_product(w["chars"], w[f"char_in_{way}"]) + w[f"char_bias_{way}"])
            parts.append(gru_on_grid(lambda t, p=p: p.take(chars[t], 1), len(chars), len(words), w[f"char_state_{way}"], real,
                                     way == "b"))
        spelled, _ = attention(np.concatenate(parts, 2), w["char_look"], real, exact=True)
        known = np.array([ids.get(x, 0) for x in words])
        x = np.concatenate([w["words"][known], on_grid(spelled), self.odds[known][:, None]], 1)
        for gates, way in zip(self.gates, "fb"):
            gates[:, done + part] = by_gate(exact_product(x, w[f"word_in_{way}"]) + w[f"word_bias_{way}"])[:, :len(part)]

    def windows(self, docs: list[list[bytes]]) -> np.ndarray:
        """Log-odds of every window of some non-empty token lists."""
        w = self.weights
        if len(self.at) > KNOWN_WORDS:
            self._forget()
        at, new, ids = self.at, self.new, []
        for words in docs:
            for x in words:
                i = at.get(x)
                if i is None:
                    i = at[x] = len(at)
                    new.append(x)
                ids.append(i)
        if new:
            self._learn()
        ids = np.array(ids, np.int64)
        size = np.array([len(x) for x in docs])
        base = np.cumsum(size) - size
        starts = [window_starts(n) for n in size]
        start = np.concatenate([s + b for s, b in zip(starts, base)])
        real = np.repeat(np.minimum(size, WINDOW), [len(s) for s in starts])
        out = np.empty(len(start), np.float32)
        steps = np.arange(WINDOW)
        # Full windows apart from short ones, so that each kind takes one way.
        for rows in (np.flatnonzero(real == WINDOW), np.flatnonzero(real < WINDOW)):
            for k in range(0, len(rows), WINDOW_BLOCK):
                at = rows[k:k + WINDOW_BLOCK]
                filled = np.concatenate([at, np.repeat(at[:1], WINDOW_BLOCK - len(at))])
                mask = steps[:, None] < real[filled]
                index = ids[np.where(mask, start[filled] + steps[:, None], 0)]
                some = mask if real[at[0]] < WINDOW else None
                parts = [gru_on_grid(lambda t, g=g: g.take(index[t], 1), WINDOW, WINDOW_BLOCK, w[f"word_state_{way}"], some,
                                     way == "b") for g, way in zip(self.gates, "fb")]
                pooled, _ = attention(np.concatenate(parts, 2), w["word_look"], some, exact=True)
                out[at] = (exact_product(on_grid(pooled), w["out"]) + w["out_bias"])[:len(at)]
        return out

    def texts(self, texts: list[bytes]) -> np.ndarray:
        """Score of each text, 0 to 1."""
        model = self.model
        if model.weights is None:
            return np.full(len(texts), model.shares[1] / max(sum(model.shares), 1))
        docs = [tokens(t) for t in texts]
        value = np.full(len(docs), model.weights["out_bias"][0], np.float64)
        some = [i for i, d in enumerate(docs) if d]
        if some:
            counts = np.array([len(window_starts(len(docs[i]))) for i in some])
            value[some] = np.maximum.reduceat(self.windows([docs[i] for i in some]), np.cumsum(counts) - counts)
        return 1 / (1 + np.exp(-value))


def train(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> Model:
    counts = {r[0]: r[1] for r in labels.filter(learn & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("toxic").count().collect()}
    return Model(labelled_sample(docs, labels, "toxic", learn, sample, TRAIN_BYTES), (counts.get(0, 0), counts.get(1, 0)))


def toxicity_scores(docs: DataFrame, model: Model, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with one column more, the score, and its name."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    name = fresh("toxicity_score", docs.columns)

    def work():
        scorer = Scorer(held.value)

        def score(columns: list[pa.Array]) -> list[pa.Array]:
            out = [scorer.texts(list(texts_of(columns[0].slice(a, b - a)))) for a, b in pieces(columns[0], 1 << 20)]
            return [pa.array(np.concatenate(out) if out else [], pa.float64())]

        return score

    return mapped(docs, [text_col], [T.StructField(name, T.DoubleType())], work), name


def remove_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score under the threshold, columns unchanged."""
    scored, name = toxicity_scores(docs, model, text_col)
    return scored.filter(quoted(name) < threshold).drop(name)


def learnable() -> Column:
    """Label rows that may be learned from: remainder not 0 modulo 5."""
    return remainder("doc_id", 5) != 0


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of every document; labels of remainder 0 modulo 5 are held out."""
    scored, name = toxicity_scores(docs.select("doc_id", "text"), train(docs, labels, learnable()))
    score = quoted(name)
    return scored.select("doc_id", (~learnable()).alias("held_out"), score.alias("score"),
                         (score >= 0.5).cast("int").alias("predicted"))
