"""Language ID (operator 8): nearest centroid over TF-IDF character n-gram vectors.

A text's vector: its byte 2-grams and 3-grams (ASCII and Latin-1 letters lower-cased, all
other ASCII as one blank), hashed into ``DIM`` buckets, log(1 + count) times the inverse
document frequency, normalised.  Each language has up to ``CLUSTERS`` centroids, from
spherical k-means over its training texts; a text gets the language of the centroid with the
largest cosine, which is its score.

A text without a letter is rejected, and one whose cosine is below ``REJECT`` times the ``QUANTILE`` of
the cosines that the language's texts of about its length have.  Lengths go by factors of 4; a
class of fewer than ``CALIBRATE_LEAST`` distinct texts takes the limit of the next class with enough: that of
a shorter class as it is, that of a longer one halved for each factor of 4, as cosines fall
with the root of the length.  No class has a higher limit than a longer one.

Document frequencies and the quantiles come from all labelled rows that aren't held out, in one pass
each; only the centroids are fitted on a bounded sample of their distinct texts (``SAMPLE`` in all, at
least ``SAMPLE_LEAST`` a language, drawn by a hash of the text).  Tasks encode the sample, so the size of a text
or the number of its copies doesn't matter to the driver.  Every row is predicted.

Cases: a null text, or one without a letter, is ``und`` with score 0; without training rows
everything is.  Repeated rows get the same prediction.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm import textbuf
from orderlake.llm.common import held_out, small_batches, spread

DIM = 8192
CLUSTERS = 3
SAMPLE = 2000
SAMPLE_LEAST = 20
REJECT = 0.5
QUANTILE = 0.01
CALIBRATE_LEAST = 50
SIZE_CLASSES = 7  # under 64 grams, under 256, ... by factors of 4
ROUNDS = 10
OUTLIERS = 0.05
TEXTS_AT_ONCE = 128
UNKNOWN = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 32


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """n-gram counts, a row of DIM buckets per text."""
    b = _FOLD[data]
    upper = np.flatnonzero((b[1:] >= 0x80) & (b[1:] <= 0x9E) & (b[:-1] == 0xC3)) + 1
    b[upper] += 32
    b = b.astype(np.uint32)
    rows = len(offsets) - 1
    text = np.repeat(np.arange(rows), np.diff(offsets))
    out = np.zeros(rows * DIM, np.int64)
    for n, seed in ((2, 0x9E3779B1), (3, 0x85EBCA6B)):
        if len(b) < n:
            continue
        gram = b[:len(b) - n + 1].copy()
        for j in range(1, n):
            gram = gram * np.uint32(257) + b[j:len(b) - n + 1 + j]
        bucket = (gram * np.uint32(seed)) >> np.uint32(32 - DIM.bit_length() + 1)
        whole = text[:len(gram)] == text[n - 1:]
        out += np.bincount(text[:len(gram)][whole] * DIM + bucket[whole], minlength=rows * DIM)
    return out.reshape(rows, DIM)


def blocks(text: pa.Array):
    """(first row, counts) of runs of at most TEXTS_AT_ONCE texts."""
    for row, data, offsets in textbuf.chunks(text):
        for a in range(0, len(offsets) - 1, TEXTS_AT_ONCE):
            part = offsets[a:a + TEXTS_AT_ONCE + 1]
            yield row + a, counts(data[part[0]:part[-1]], part - part[0])


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def size_class(tf: np.ndarray) -> np.ndarray:
    """The length of each text, by its number of n-grams over 32 in factors of 4."""
    grams = np.maximum(tf.sum(axis=1) / 32.0, 1.0)
    return np.minimum(np.log2(grams) // 2, SIZE_CLASSES - 1).astype(np.int64)


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    langs: list[str]     # of each centroid
    limits: np.ndarray   # of each centroid and size class; a smaller cosine is rejected

    def vectors(self, tf: np.ndarray) -> np.ndarray:
        return _unit(np.log1p(tf).astype(np.float32) * self.idf)

    def predict(self, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid and its cosine."""
        cosine = self.vectors(tf) @ self.centroids.T
        best = cosine.argmax(axis=1)
        return best, np.clip(cosine[np.arange(len(best)), best], 0.0, 1.0)


def k_means(v: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; no randomness.

    The start is farthest-first, passing over the farthest OUTLIERS of the vectors, so that a few garbled
    texts get no centroid of their own.
    """
    centers = [_unit(v.mean(axis=0, keepdims=True))[0]]
    for _ in range(1, min(k, len(v))):
        nearness = np.max(v @ np.stack(centers).T, axis=1)
        centers.append(v[np.argsort(nearness, kind="stable")[int(OUTLIERS * len(v))]])
    c = np.stack(centers)
    for _ in range(ROUNDS):
        own = (v @ c.T).argmax(axis=1)
        c = np.stack([_unit(v[own == i].mean(axis=0, keepdims=True))[0] if (own == i).any() else c[i]
                      for i in range(len(c))])
    return c


def fit(tf: np.ndarray, langs: list[str], idf: np.ndarray, clusters: int = CLUSTERS) -> Model:
    """Centroids of the texts with counts ``tf``; nothing is rejected yet."""
    v = _unit(np.log1p(tf).astype(np.float32) * idf)
    labels = np.array(langs, dtype=object)
    found = {lang: k_means(v[labels == lang], clusters) for lang in sorted(set(langs))}
    names = [lang for lang, c in found.items() for _ in c]
    return Model(idf, np.concatenate(list(found.values())).astype(np.float32), names, np.zeros((len(names), SIZE_CLASSES)))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def learnable(docs: DataFrame) -> DataFrame:
    """(text, lang) of the labelled rows that aren't held out and have a letter."""
    return docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & has_letter(F.col("text"))).select("text", "lang")


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """How many texts there are, and how many have each bucket; a task adds its texts up first."""
    def count(batches):
        rows, having = 0, np.zeros(DIM, np.int64)
        for batch in batches:
            for _, tf in blocks(batch.column(0)):
                rows += len(tf)
                having += (tf > 0).sum(axis=0)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, DIM)), pa.array(np.concatenate([[rows], having]))],
                                             ["bucket", "n"])

    sums = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(DIM + 1, np.int64)
    for r in sums.collect():  # DIM + 1 rows at most
        out[r.bucket] = r.n
    return int(out[-1]), out[:-1]


def _encoded(text: Column) -> Column:
    """Each text's counts: the buckets that it has (two bytes each), then how often (four)."""
    def encode(column: pa.Array) -> pa.Array:
        found = []
        for _, tf in blocks(column):
            for row in tf:
                at = np.flatnonzero(row)
                found.append(at.astype("<u2").tobytes() + row[at].astype("<u4").tobytes())
        return pa.array(found, pa.binary())

    return F.arrow_udf(encode, "binary")(text)


def _decoded(codes: list[bytes]) -> np.ndarray:
    tf = np.zeros((len(codes), DIM), np.float32)
    for i, code in enumerate(codes):
        n = len(code) // 6
        tf[i, np.frombuffer(code, "<u2", n)] = np.frombuffer(code, "<u4", n, 2 * n)
    return tf


def training_sample(rows: DataFrame) -> list:
    """(lang, code) of distinct texts, about the same number for each language."""
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(
        F.approx_count_distinct(F.xxhash64("text")).alias("n")).collect()}  # a row per language
    if not sizes:
        return []
    each = max(SAMPLE_LEAST, SAMPLE // len(sizes))
    below = F.lit(None).cast("double")
    for lang, n in sizes.items():
        below = F.when(F.col("lang") == lang, F.lit(min(1.0, each / n))).otherwise(below)
    at = spread(F.xxhash64("text"), F.col("lang"))
    drawn = rows.withColumn("at", at).where(F.col("at") / float(1 << 60) < below).dropDuplicates(["lang", "text"])
    drawn = drawn.orderBy("at", "lang", "text").limit(2 * each * len(sizes))
    return drawn.select("at", "lang", _encoded(F.col("text")).alias("code")).orderBy("at", "lang", "code").collect()


def class_limits(found: dict[int, tuple[int, float]]) -> list[float]:
    """The limit of each size class from {class: (texts, quantile)} of a language."""
    enough = {c: q for c, (n, q) in found.items() if n >= CALIBRATE_LEAST} or {c: q for c, (_, q) in found.items()}
    out = []
    for c in range(SIZE_CLASSES):
        shorter, longer = [k for k in enough if k <= c], [k for k in enough if k > c]
        limit = enough[max(shorter)] if shorter else enough[min(longer)] / 2 ** (min(longer) - c) if longer else 0.0
        out.append(REJECT * limit)
    return [min(out[c:]) for c in range(SIZE_CLASSES)]


def calibrate(rows: DataFrame, model: Model) -> Model:
    """The model with its limits, from all distinct texts whose language it gets right."""
    found = rows.select("lang", F.xxhash64("text").alias("copy"), _nearest(rows, model, F.col("text")).alias("p"))
    found = (found.where(F.col("p.lang") == F.col("lang")).groupBy("lang", "copy")
             .agg(F.min(F.struct("p.size", "p.score")).alias("p")))
    quantiles = found.groupBy("lang", F.col("p.size").alias("size")).agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx("p.score", QUANTILE, 10_000).alias("q"))
    by_lang: dict[str, dict[int, tuple[int, float]]] = {}
    for r in quantiles.collect():  # a row per language and size class
        by_lang.setdefault(r.lang, {})[r["size"]] = (r.n, r.q)
    model.limits = np.array([class_limits(by_lang.get(lang, {})) for lang in model.langs])
    return model


def train(docs: DataFrame) -> Model | None:
    """Fit on the documents' own ``lang``, without the held-out rows."""
    rows = learnable(docs)
    sample = training_sample(rows)
    if not sample:
        return None
    n, having = document_frequencies(rows)
    idf = np.log((1 + n) / (1 + having)).astype(np.float32) + np.float32(1)
    return calibrate(rows, fit(_decoded([r.code for r in sample]), [r.lang for r in sample], idf))


PREDICTION = "struct<lang:string,score:double,rejected:boolean>"


def _nearest(docs: DataFrame, model: Model, text: Column) -> Column:
    """lang, score, rejected and size class of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(column: pa.Array) -> pa.Array:
        m = shared.value
        best, score, size = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)]
        for _, tf in blocks(column):
            b, s = m.predict(tf)
            best.append(b)
            score.append(s)
            size.append(size_class(tf))
        at, cosine, sizes = np.concatenate(best), np.concatenate(score).astype(np.float64), np.concatenate(size)
        names = pa.array(m.langs, pa.string()).take(pa.array(at))
        return pa.StructArray.from_arrays(
            [names, pa.array(cosine), pa.array(cosine < m.limits[at, sizes]), pa.array(sizes.astype(np.int32))],
            ["lang", "score", "rejected", "size"])

    return F.arrow_udf(predict, "struct<lang:string,score:double,rejected:boolean,size:int>")(text)


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> Column:
    """The language of each text with its score, and whether it is rejected."""
    unknown = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    if model is None:
        return unknown.cast(PREDICTION)
    found = _nearest(docs, model, F.col(text)).dropFields("size")
    return F.when(has_letter(F.col(text)), found).otherwise(unknown.cast(PREDICTION))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language is recognised, columns unchanged."""
    small_batches(docs.sparkSession)
    columns = docs.columns
    rows = docs.select(F.struct(*columns).alias("_row"), F.col("text").alias("_text"))
    judged = rows.withColumn("_lang", identify(rows, train(docs), "_text"))
    return judged.where(~F.col("_lang.rejected")).select(*[F.col("_row")[c].alias(c) for c in columns])
