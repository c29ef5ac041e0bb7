"""Quality classifier (operator 4): attention-based multiple-instance learning.

A text is a bag of passages of ``PASSAGE_WORDS`` words.  A passage is encoded by counts (kinds
of characters, word lengths, repeats, the size of its text) and hashed words, then by a learned
layer.  Gated attention, softmax over the bag of w . (tanh(V h) * sigmoid(U h)), weighs the
passages; the weighted mean is scored by a logistic unit.  Only documents have labels.

Trained in numpy, a fixed number of Adam steps whatever the table's size, on a bounded sample
(``SAMPLE`` labelled documents that aren't held out).  Training and scoring take every passage of
a text.

Cases: a null or wordless text is a bag of one empty passage.  Without labels of both kinds
every score is the share of label 1 (0.5 without any).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm import textbuf
from orderlake.llm.common import labelled_sample

PASSAGE_WORDS = 48
WORD_BUCKETS = 64
HIDDEN = 24
GATE = 12
SAMPLE = 3000
STEPS = 1500
BATCH = 64
RATE = 0.003

# Kinds of bytes whose share of a passage is a feature.
_KINDS = [np.isin(np.arange(256), list(k)) for k in (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:", b"!?", b"|", b"#*$%&<>", b"\n", b"()[]{}=_/\\", range(128, 256))]


def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Raw passage features (float32) and the first passage of each text, with the end appended."""
    w = textbuf.words(data, offsets)
    counts = w.counts
    bags = np.maximum(1, -(-counts // PASSAGE_WORDS))
    first = np.concatenate(([0], np.cumsum(bags)))
    text = np.repeat(np.arange(len(counts)), bags)
    lo = w.first[text] + (np.arange(first[-1]) - first[text]) * PASSAGE_WORDS
    hi = np.minimum(lo + PASSAGE_WORDS, w.first[text + 1])
    words = np.maximum(hi - lo, 1).astype(np.float32)
    starts = np.append(w.starts, len(data))
    a = np.where(hi > lo, starts[lo], offsets[text])
    b = np.where(hi < w.first[text + 1], starts[np.minimum(hi, len(starts) - 1)], offsets[text + 1])
    a = np.where(lo == w.first[text], offsets[text], a)
    size = np.maximum(b - a, 1).astype(np.float32)

    def part(flags: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[hi] - total[lo]

    columns = [part(kind[data], a, b) / size for kind in _KINDS]
    hashes = w.hashes()
    passage = np.repeat(np.arange(len(lo)), hi - lo)
    length = w.ends - w.starts
    columns += [part(length, lo, hi) / words / 10, part(length <= 3, lo, hi) / words, part(length > 20, lo, hi) / words]
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])
    columns.append(part(again, lo, hi) / words)
    distinct = np.unique(textbuf.mix(hashes ^ textbuf.mix(passage.astype(np.uint64) + np.uint64(1))), return_index=True)[1]
    columns.append(np.bincount(passage[distinct], minlength=len(lo)) / words)
    initial = data[w.starts] if len(w.starts) else np.zeros(0, np.uint8)
    columns.append(part((initial >= 65) & (initial <= 90), lo, hi) / words)
    columns += [(hi - lo) / PASSAGE_WORDS, np.log1p(counts[text]) / 8, np.log1p(size) / 8,
                (counts[text] < 8).astype(np.float32)]
    bucket = (hashes >> np.uint64(64 - WORD_BUCKETS.bit_length() + 1)).astype(np.int64)
    hashed = np.bincount(passage * WORD_BUCKETS + bucket, minlength=len(lo) * WORD_BUCKETS).reshape(len(lo), WORD_BUCKETS)
    return np.concatenate([np.stack(columns, axis=1), hashed / words[:, None]], axis=1).astype(np.float32), first


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]
    share: float

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        """All layers for bags x[first[i]:first[i + 1]], none of them empty."""
        p, at, size = self.p, first[:-1], np.diff(first)
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ p["w"] + p["b"])
        v, u = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        e = (v * u) @ p["a"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, at), size))
        att = e / np.repeat(np.add.reduceat(e, at), size)
        z = np.add.reduceat(att[:, None] * h, at, axis=0)
        return {"x": x, "h": h, "v": v, "u": u, "att": att, "z": z, "score": _sigmoid(z @ p["c"] + p["d"])}

    def gradient(self, f: dict[str, np.ndarray], first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, size = self.p, np.diff(first)
        out = (f["score"] - y) / len(y)
        dz = np.repeat(out[:, None] * p["c"], size, axis=0)
        datt = (dz * f["h"]).sum(axis=1)
        de = f["att"] * (datt - np.repeat(np.add.reduceat(f["att"] * datt, first[:-1]), size))
        dv = de[:, None] * p["a"] * f["u"] * (1 - f["v"] ** 2)
        du = de[:, None] * p["a"] * f["v"] * f["u"] * (1 - f["u"])
        dh = f["att"][:, None] * dz + dv @ p["v"].T + du @ p["u"].T
        dx = dh * (1 - f["h"] ** 2)
        return {"w": f["x"].T @ dx, "b": dx.sum(axis=0), "v": f["h"].T @ dv, "u": f["h"].T @ du,
                "a": (f["v"] * f["u"]).T @ de, "c": f["z"].T @ out, "d": out.sum(keepdims=True)}

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if not self.p:
            return np.full(len(offsets) - 1, self.share)
        x, first = encode(data, offsets)
        return self.forward(x, first)["score"]


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.s = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, d in g.items():
            self.m[k] += 0.1 * (d - self.m[k])
            self.s[k] += 0.001 * (d * d - self.s[k])
            self.p[k] -= self.rate * (self.m[k] / (1 - 0.9 ** self.t)) / (np.sqrt(self.s[k] / (1 - 0.999 ** self.t)) + 1e-8)


def fit(sample: list[tuple[str, int]], seed: int = 7) -> Model:
    y = np.array([label for _, label in sample], np.float64)
    share = float(y.mean()) if len(y) else 0.5
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(0), np.zeros(0), {}, share)
    parts, bags = [], []
    for _, data, offsets in textbuf.chunks(pa.array([t for t, _ in sample], pa.string())):
        x, first = encode(data, offsets)
        parts.append(x)
        bags += [x[a:b] for a, b in zip(first[:-1], first[1:])]
    passages = sum(len(x) for x in parts)
    mean = sum(x.sum(axis=0, dtype=np.float64) for x in parts) / passages
    scale = np.sqrt(sum(((x - mean) ** 2).sum(axis=0) for x in parts) / passages) + 1e-3
    rng = np.random.default_rng(seed)
    d = len(mean)
    p = {"w": rng.normal(0, d ** -0.5, (d, HIDDEN)), "b": np.zeros(HIDDEN),
         "v": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)), "u": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)),
         "a": rng.normal(0, GATE ** -0.5, GATE), "c": rng.normal(0, HIDDEN ** -0.5, HIDDEN),
         "d": np.array([np.log(share / (1 - share))])}
    model = Model(mean.astype(np.float32), scale.astype(np.float32), p, share)
    adam = Adam(p, RATE)
    for step in range(STEPS):
        drawn = rng.choice(len(bags), min(BATCH, len(bags)), replace=False)
        first = np.concatenate(([0], np.cumsum([len(bags[i]) for i in drawn])))
        f = model.forward(np.concatenate([bags[i] for i in drawn]), first)
        g = model.gradient(f, first, y[drawn])
        for k in ("w", "v", "u"):
            g[k] += 1e-4 * p[k]
        adam.rate = RATE * (1 - step / STEPS) + 1e-5
        adam.step(g)
    model.p = {k: v.astype(np.float32) for k, v in p.items()}
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    return fit(labelled_sample(docs, labels, label, SAMPLE))


def score(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """The score of each whole text, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(column: pa.Array) -> pa.Array:
        parts = [shared.value.score(data, offsets) for _, data, offsets in textbuf.chunks(column)]
        return pa.array(np.concatenate([np.zeros(0), *parts]).astype(np.float64))

    return F.arrow_udf(run, "double")(F.col(text))
