"""Benchmark decontamination (operator 6): a broadcast hash set of normalised test n-grams.

Words: A-Z lower-cased, then runs of letters, digits and non-ASCII characters.  A window
is ``n`` consecutive words of a benchmark item; an item with fewer words, but not none,
is one window.  Every word of every text starts a probe of the hash set for each window
length in it; hash hits are verified word by word.  Words inside any occurrence of a
window are hit, and the item has an occurring window.

The set is broadcast in blocks of at most ``MAX_WINDOWS`` windows.  A larger benchmark takes
one pass per block, each adding its spans to the stored result of the one before, so the
memory of a task doesn't grow with the benchmark and no window is dropped.

Nulls: a null text has no words (neither as document nor as item); an item without id
marks words but is in no item list.  Repeated items count once by id.  Extra columns of
the documents pass through; the result column is named by ``out``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.config import materialize
from orderlake.llm import textbuf

WINDOW_WORDS = 10
MAX_WINDOWS = 500_000
_BITS = 20

FOUND = "struct<n_words:bigint,spans:array<struct<start:bigint,stop:bigint>>,items:array<string>>"


def benchmark_windows(items: DataFrame, n: int = WINDOW_WORDS) -> DataFrame:
    """One row per distinct (window, item): block key, words joined by a space, item id as text."""

    @F.arrow_udf("array<string>")
    def windows(text: pa.Array) -> pa.Array:
        out = []
        for _, data, offsets in textbuf.chunks(text):
            w = textbuf.words(data, offsets, textbuf.ALNUM_WORDS)
            for a, b in zip(w.first[:-1], w.first[1:]):
                size = min(n, b - a)
                out.append([w.normalised(i, size).decode("utf-8", "replace")
                            for i in range(a, b - size + 1)] if size else [])
        return pa.array(out, pa.list_(pa.string()))

    return (items.select(F.col("item_id").cast("string").alias("item"),
                         F.explode(windows(F.col("text"))).alias("window"))
            .distinct())


class WindowSet:
    """The windows of a block, to be broadcast: hashes sorted, their words, and their items."""

    def __init__(self, rows: list[tuple[str, list[str]]]):
        column = pa.array([w for w, _ in rows], pa.string())
        hashes = np.zeros(len(rows), np.uint64)
        lengths = np.zeros(len(rows), np.int64)
        for row, data, offsets in textbuf.chunks(column):
            w = textbuf.words(data, offsets, textbuf.ALNUM_WORDS)
            words = w.hashes()
            for d, (a, b) in enumerate(zip(w.first[:-1], w.first[1:])):
                hashes[row + d] = textbuf.window_hashes(words[a:b], b - a)[0]
                lengths[row + d] = b - a
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.lengths = hashes[order], lengths[order]
        self.rows = [(rows[i][0].encode(), rows[i][1]) for i in order]
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[self.hashes >> np.uint64(64 - _BITS)] = True
        self.sizes = sorted(set(lengths.tolist()))

    def find(self, w: textbuf.Words) -> list[tuple[int, int, int]]:
        """(first word, words, row) of each occurrence, verified."""
        found = []
        words, room = w.hashes(), w.room()
        for n in self.sizes:
            h = textbuf.window_hashes(words, n)
            at = np.flatnonzero(self.seen[h >> np.uint64(64 - _BITS)] & (room[:len(h)] >= n))
            lo = np.searchsorted(self.hashes, h[at], "left")
            hi = np.searchsorted(self.hashes, h[at], "right")
            for i, a, b in zip(at[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
                text = w.normalised(i, n)
                found.extend((i, n, r) for r in range(a, b) if self.lengths[r] == n and self.rows[r][0] == text)
        return found


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scanner(block):
    """A column function: text and the earlier blocks' result -> the result with this block's windows."""

    @F.arrow_udf(FOUND)
    def scan(text: pa.Array, earlier: pa.Array) -> pa.Array:
        windows, out = block.value, []
        before = earlier.to_pylist()
        for row, data, offsets in textbuf.chunks(text):
            w = textbuf.words(data, offsets, textbuf.ALNUM_WORDS)
            hits: dict[int, list[tuple[int, int, int]]] = {}
            for i, n, r in windows.find(w):
                hits.setdefault(int(np.searchsorted(w.first, i, "right")) - 1, []).append((i, n, r))
            for d, count in enumerate(w.counts.tolist()):
                old = before[row + d] or {"spans": [], "items": []}
                spans = [(s["start"], s["stop"]) for s in old["spans"]]
                items = set(old["items"])
                for i, n, r in hits.get(d, ()):
                    a = i - int(w.first[d])
                    spans.append((a, a + n))
                    items.update(windows.rows[r][1])
                out.append({"n_words": count, "items": sorted(items),
                            "spans": [{"start": a, "stop": b} for a, b in _merge(spans)]})
        return pa.array(out, pa.struct([
            ("n_words", pa.int64()),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
            ("items", pa.list_(pa.string()))]))

    return scan


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", out: str = "_found",
                  n: int = WINDOW_WORDS, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """``docs`` with ``out``: words, merged spans of hit words [start, stop), items that occur."""
    spark = docs.sparkSession
    windows = materialize(benchmark_windows(items, n), "windows")
    blocks = max(1, -(-windows.select("window").distinct().count() // max_windows))
    docs = docs.withColumn(out, F.lit(None).cast(FOUND))
    for b in range(blocks):
        part = (windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == b)
                .groupBy("window").agg(F.collect_set("item").alias("items")))
        block = spark.sparkContext.broadcast(WindowSet([(r.window, r["items"]) for r in part.toLocalIterator()]))
        docs = docs.withColumn(out, _scanner(block)(F.col(text), F.col(out)))
        if b < blocks - 1:
            docs = materialize(docs, "decontaminated")
    return docs


def hit_words(found: Column) -> Column:
    return F.aggregate(found["spans"], F.lit(0).cast("bigint"), lambda s, x: s + x["stop"] - x["start"])


def strip_spans(text: Column, found: Column) -> Column:
    """The text without its hit words (and what stands between two words of one span)."""

    @F.arrow_udf("string")
    def strip(text: pa.Array, found: pa.Array) -> pa.Array:
        out, spans = [], found.to_pylist()
        for row, data, offsets in textbuf.chunks(text):
            w = textbuf.words(data, offsets, textbuf.ALNUM_WORDS)
            for d in range(len(offsets) - 1):
                keep, at = [], int(offsets[d])
                for s in (spans[row + d] or {"spans": []})["spans"]:
                    keep.append(data[at:w.starts[w.first[d] + s["start"]]].tobytes())
                    at = int(w.ends[w.first[d] + s["stop"] - 1])
                out.append(b"".join([*keep, data[at:offsets[d + 1]].tobytes()]).decode("utf-8", "replace"))
        return pa.array(out, pa.string())

    return F.when(F.size(found["spans"]) > 0, strip(text, found)).otherwise(text)


def decontaminate(docs: DataFrame, items: DataFrame, mode: str = "documents", text: str = "text",
                  n: int = WINDOW_WORDS) -> DataFrame:
    """Documents without contaminated ones (``mode`` documents) or without their hit words (``spans``)."""
    columns = docs.columns
    # The row travels as one column, so that a column of it may have any name.
    rows = docs.select(F.struct(*columns).alias("_row"), F.col(text).alias("_text"))
    found = contamination(rows, items, "_text", "_found", n)
    if mode == "documents":
        return found.where(F.size(F.col("_found.spans")) == 0).select(*[F.col("_row")[c].alias(c) for c in columns])
    if mode == "spans":
        cut = found.withColumn("_text", strip_spans(F.col("_text"), F.col("_found")))
        return cut.select(*[F.col("_text").alias(c) if c == text else F.col("_row")[c].alias(c) for c in columns])
    raise ValueError(f"mode is documents or spans, not {mode!r}")
