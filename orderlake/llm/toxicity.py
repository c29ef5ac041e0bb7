"""Toxicity (operator 9): a bidirectional gated recurrent network with attention pooling.

Words are lower-cased runs of letters, digits and non-ASCII characters.  A word's input is the
sum of its word vector (vocabulary: the words of at least ``MIN_DOCS`` training texts, at most
``VOCABULARY``; others have none) and the vectors of its first, last and middle three bytes and
its first six, hashed, so that unknown words are read by their characters.  Windows of ``WINDOW`` words
begin every ``STRIDE`` words, so they overlap by half; two recurrent passes read a window in
either direction, attention pools the states of both, and a logistic unit scores the
window.  A text's score is that of its highest window.

Labels are per text, so training (numpy, Adam, a fixed number of steps at any table size) uses
each text's currently highest window and, for clean texts, a random one too.  The word vectors
start from the words' log odds, and a word counts as unknown in ``UNKNOWN`` of its uses, so that
its characters are learned too, and shrinks back to where it began, so that the words of a few
texts aren't memorised.  It learns from a bounded sample of ``SAMPLE`` labelled
documents that aren't held out; every window of every text is scored.

Cases: a null or wordless text is one empty window.  Without labels of both kinds every score is
the share of label 1 (0 without any).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm import textbuf
from orderlake.llm.common import labelled_sample
from orderlake.llm.quality_mil import Adam

WINDOW = 24
STRIDE = 12
WIDTH = 16
HIDDEN = 8
VOCABULARY = 20_000
MIN_DOCS = 3
CHAR_BUCKETS = 1 << 14
SAMPLE = 4000
EPOCHS = 5
STEPS = 300
BATCH = 64
RATE = 0.01
UNKNOWN = 0.2
SHRINK = 0.01


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def char_parts(w: textbuf.Words) -> np.ndarray:
    """Buckets of the first, last and middle three bytes and of the first six bytes of each word."""
    norm = np.concatenate((w.norm, np.zeros(6, np.uint8))).astype(np.uint32)
    length = w.ends - w.starts
    middle = w.starts + np.maximum(length - 3, 0) // 2
    out = []
    for k, (start, n) in enumerate(((w.starts, 3), (np.maximum(w.ends - 3, w.starts), 3), (middle, 3), (w.starts, 6))):
        code = np.full(len(start), k + 1, np.uint32)
        for j in range(n):
            code = code * np.uint32(257) + np.where(j < length, norm[start + j], 0).astype(np.uint32)
        out.append((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - CHAR_BUCKETS.bit_length() + 1))
    return np.stack(out, axis=1).astype(np.int64)


@dataclass
class Chunk:
    """Distinct words of a chunk, its word sequence as indexes into them, and its windows."""

    hashes: np.ndarray
    chars: np.ndarray
    words: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    first: np.ndarray


def read(data: np.ndarray, offsets: np.ndarray) -> Chunk:
    w = textbuf.words(data, offsets, textbuf.ALNUM_WORDS)
    hashes, at, words = np.unique(w.hashes(), return_index=True, return_inverse=True)
    distinct = textbuf.Words(w.norm, w.starts[at], w.ends[at], np.zeros(1, np.int64))
    counts = w.counts
    windows = 1 + np.maximum(0, -(-(counts - WINDOW) // STRIDE))
    first = np.concatenate(([0], np.cumsum(windows)))
    text = np.repeat(np.arange(len(counts)), windows)
    starts = w.first[text] + (np.arange(first[-1]) - first[text]) * STRIDE
    return Chunk(hashes, char_parts(distinct), words, starts, np.clip(w.first[text + 1] - starts, 0, WINDOW), first)


def read_all(texts: list[str]) -> Chunk:
    """All texts as one chunk, read a chunk at a time."""
    parts = [read(data, offsets) for _, data, offsets in textbuf.chunks(pa.array(texts, pa.large_string()))]
    hashes, at, new = np.unique(np.concatenate([c.hashes for c in parts]), return_index=True, return_inverse=True)
    ends = [np.cumsum([0, *(len(x) for x in of)]) for of in ([c.hashes for c in parts], [c.words for c in parts],
                                                             [c.starts for c in parts])]
    return Chunk(hashes, np.concatenate([c.chars for c in parts])[at].astype(np.int32),
                 np.concatenate([new[a + c.words].astype(np.int32) for a, c in zip(ends[0], parts)]),
                 np.concatenate([a + c.starts for a, c in zip(ends[1], parts)]),
                 np.concatenate([c.sizes for c in parts]),
                 np.concatenate([[0], *(a + c.first[1:] for a, c in zip(ends[2], parts))]))


@dataclass
class Model:
    vocabulary: np.ndarray
    p: dict[str, np.ndarray]
    share: float

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        """Row of the word vectors; 0 is the unknown word."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def inputs(self, ids: np.ndarray, chars: np.ndarray) -> np.ndarray:
        x = self.p["words"][ids]
        for j in range(chars.shape[-1]):
            x += self.p["chars"][chars[..., j]]
        return x

    def run(self, x: np.ndarray, sizes: np.ndarray, keep: bool = False):
        """x: (step, window, 3 HIDDEN) input terms of both directions; returns scores, and all states to learn from."""
        p, steps = self.p, x[0].shape[0]
        states, trace = [], []
        for d, xs in zip("fb", x):
            h = np.zeros((xs.shape[1], HIDDEN), xs.dtype)
            own, kept = np.empty((steps, xs.shape[1], HIDDEN), xs.dtype), []
            rec, cand = p[f"{d}_gates"], p[f"{d}_cand"]
            for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
                live = (t < sizes)[:, None]
                gates = _sigmoid(xs[t, :, :2 * HIDDEN] + h @ rec)
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                n = np.tanh(xs[t, :, 2 * HIDDEN:] + (r * h) @ cand)
                new = np.where(live, h + z * (n - h), h)
                if keep:
                    kept.append((t, h, z, r, n, live))
                own[t] = h = new
            states.append(own)
            trace.append(kept)
        s = np.concatenate(states, axis=2)
        e = np.tanh(s @ p["att"]) @ p["att_out"]
        e = np.where(np.arange(steps)[:, None] < np.maximum(sizes, 1), e, -1e9)
        e = np.exp(e - e.max(axis=0))
        a = e / e.sum(axis=0)
        pooled = (a[:, :, None] * s).sum(axis=0)
        return pooled @ p["out"] + p["bias"], (s, a, pooled, trace)

    def terms(self, x: np.ndarray) -> list[np.ndarray]:
        return [x @ self.p[f"{d}_in"] + self.p[f"{d}_bias"] for d in "fb"]

    def window_scores(self, c: Chunk, at: np.ndarray | None = None) -> np.ndarray:
        """Logits of the chunk's windows (or of those ``at``)."""
        starts, sizes = (c.starts, c.sizes) if at is None else (c.starts[at], c.sizes[at])
        if not len(c.words):
            return np.full(len(starts), float(self.p["bias"][0]))
        terms = self.terms(self.inputs(self.word_ids(c.hashes), c.chars))
        out = []
        for a in range(0, len(starts), 2048):
            size = sizes[a:a + 2048]
            steps = max(1, int(size.max()))
            seq = c.words[np.minimum(starts[a:a + 2048] + np.arange(steps)[:, None], len(c.words) - 1)]
            out.append(self.run([t[seq] for t in terms], size)[0])
        return np.concatenate(out)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if not self.p:
            return np.full(len(offsets) - 1, self.share)
        c = read(data, offsets)
        return _sigmoid(np.maximum.reduceat(self.window_scores(c), c.first[:-1]).astype(np.float64))

    def gradient(self, ids: np.ndarray, chars: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Mean logistic loss of windows: ids (step, window), chars (step, window, parts)."""
        p, steps = self.p, len(ids)
        x = self.inputs(ids, chars)
        logit, (s, a, pooled, trace) = self.run(self.terms(x), sizes, keep=True)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        d = (_sigmoid(logit) - y) / len(y)
        g["out"], g["bias"] = pooled.T @ d, d.sum(keepdims=True)
        dp = d[:, None] * p["out"]
        ds = a[:, :, None] * dp
        da = (dp * s).sum(axis=2)
        de = a * (da - (a * da).sum(axis=0))
        u = np.tanh(s @ p["att"])
        g["att_out"] = np.einsum("tnk,tn->k", u, de)
        du = de[:, :, None] * p["att_out"] * (1 - u * u)
        g["att"] = np.einsum("tnh,tnk->hk", s, du)
        ds = ds + du @ p["att"].T
        dx = np.zeros_like(x)
        for k, name in enumerate("fb"):
            dh = np.zeros_like(s[0, :, :HIDDEN])
            for t, h, z, r, n, live in reversed(trace[k]):
                dh = dh + ds[t, :, k * HIDDEN:(k + 1) * HIDDEN]
                dnew = np.where(live, dh, 0)
                dn = dnew * z * (1 - n * n)
                drh = dn @ p[f"{name}_cand"].T
                dgate = np.concatenate((dnew * (n - h) * z * (1 - z), drh * h * r * (1 - r)), axis=1)
                g[f"{name}_cand"] += (r * h).T @ dn
                g[f"{name}_gates"] += h.T @ dgate
                dall = np.concatenate((dgate, dn), axis=1)
                g[f"{name}_in"] += x[t].T @ dall
                g[f"{name}_bias"] += dall.sum(axis=0)
                dx[t] += dall @ p[f"{name}_in"].T
                dh = np.where(live, dnew * (1 - z) + drh * r + dgate @ p[f"{name}_gates"].T, dh)
        flat = dx.reshape(-1, WIDTH)
        np.add.at(g["words"], ids.ravel(), flat)
        for j in range(chars.shape[2]):
            np.add.at(g["chars"], chars[:, :, j].ravel(), flat)
        g["words"][0] = 0
        return g


def fit(sample: list[tuple[str, int]], seed: int = 11) -> Model:
    y = np.array([label for _, label in sample], np.float64)
    share = float(y.mean()) if len(y) else 0.0
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(0, np.uint64), {}, share)
    rng = np.random.default_rng(seed)
    c = read_all([t for t, _ in sample])
    texts = np.repeat(np.arange(len(y)), np.diff(c.first))

    # Vocabulary by document frequency, word vectors from log odds.  A text's windows follow each other.
    last = c.first[1:] - 1
    counts = c.starts[last] + c.sizes[last] - c.starts[c.first[:-1]]
    pairs = np.unique(np.repeat(np.arange(len(y)), counts) * len(c.hashes) + c.words)
    docs, word = pairs // max(len(c.hashes), 1), pairs % max(len(c.hashes), 1)
    df = np.bincount(word, minlength=len(c.hashes))
    bad = np.bincount(word, weights=y[docs], minlength=len(c.hashes))
    known = np.flatnonzero(df >= MIN_DOCS)
    known = np.sort(known[np.argsort(-df[known], kind="stable")[:VOCABULARY]])
    odds = np.log((bad + share) / (df - bad + 1 - share)) - np.log(share / (1 - share))

    def normal(*shape: int) -> np.ndarray:
        return rng.normal(0, shape[0] ** -0.5, shape)

    p = {"words": np.concatenate((np.zeros((1, WIDTH)), rng.normal(0, 0.05, (len(known), WIDTH)))),
         "chars": rng.normal(0, 0.05, (CHAR_BUCKETS, WIDTH)),
         "att": normal(2 * HIDDEN, HIDDEN), "att_out": normal(HIDDEN), "out": normal(2 * HIDDEN), "bias": np.array([-1.0])}
    p["words"][1:, 0] += odds[known]
    for d in "fb":
        p |= {f"{d}_in": normal(WIDTH, 3 * HIDDEN), f"{d}_bias": np.zeros(3 * HIDDEN),
              f"{d}_gates": normal(HIDDEN, 2 * HIDDEN), f"{d}_cand": normal(HIDDEN, HIDDEN)}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    model = Model(c.hashes[known], p, share)
    ids = model.word_ids(c.hashes)
    adam = Adam(p, RATE)
    begin = p["words"].copy()
    odds = np.where(ids > 0, odds, 0)

    def words_of(at: np.ndarray) -> np.ndarray:
        return c.words[np.minimum(c.starts[at] + np.arange(WINDOW)[:, None], len(c.words) - 1)]

    if not len(c.words):
        return model
    level = np.concatenate([
        np.where(np.arange(WINDOW)[:, None] < c.sizes[at], odds[words_of(at)], 0).max(axis=0)
        for at in np.array_split(np.arange(len(c.starts)), len(c.starts) // 10_000 + 1)])
    toxic, clean = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    for epoch in range(EPOCHS):
        if epoch:
            level = model.window_scores(c)
        order = np.lexsort((level, texts))
        best = order[c.first[1:] - 1]
        for step in range(STEPS):
            pos, neg = rng.choice(toxic, BATCH // 4), rng.choice(clean, 3 * BATCH // 4)
            hard, some = neg[::2], neg[1::2]
            lucky = c.first[some] + (rng.random(len(some)) * np.diff(c.first)[some]).astype(np.int64)
            at = np.concatenate((best[pos], best[hard], lucky))
            seq = words_of(at)
            adam.rate = RATE * (1 - (epoch * STEPS + step) / (EPOCHS * STEPS)) + 1e-4
            known = np.where(rng.random(seq.shape) < UNKNOWN, 0, ids[seq])
            adam.step(model.gradient(known, c.chars[seq], c.sizes[at],
                                     np.concatenate((np.ones(len(pos)), np.zeros(len(at) - len(pos)))).astype(np.float32)))
            # Word vectors fall back to where they began unless many uses move them.
            p["words"] += SHRINK * (begin - p["words"])
    model.p = {k: v.astype(np.float32) for k, v in p.items()}
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    return fit(labelled_sample(docs, labels, label, SAMPLE))


def score(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """The score of each whole text, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(column: pa.Array) -> pa.Array:
        parts = [shared.value.score(data, offsets) for _, data, offsets in textbuf.chunks(column)]
        return pa.array(np.concatenate([np.zeros(0), *parts]).astype(np.float64))

    return F.arrow_udf(run, "double")(F.col(text))
