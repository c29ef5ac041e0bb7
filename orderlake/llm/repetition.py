"""Quality rules (operator 5): repetition within a text by suffix array, and simple counts.

All texts of a chunk get one suffix array over their words, by prefix doubling: suffixes
are sorted by their first word (and text), then by 2, 4, 8, ... words, and only suffixes that
still tie are sorted again.  The ranks of every doubling give the longest common prefix (LCP)
of neighbouring suffixes.  The longest repeated substring that starts at a word is the larger
LCP to its two neighbours, the value of the innermost LCP interval that holds its suffix;
the spans of all maximal repeats of at least ``MIN_REPEAT`` words are united.  A text passes
if they cover at most ``MAX_COVERED`` of its words and the longest has at most ``MAX_REPEAT``.

Words are ``[^\\x20\\x09-\\x0D]+``, compared as written.  A null or empty text has no words
and fails the base rule.  Memory is set by the longest single text; work is n log n at worst.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm import textbuf

MIN_WORDS = 50
MAX_TRIGRAM_PERCENT = 50
MIN_REPEAT = 10
MAX_COVERED = 0.3
MAX_REPEAT = 100
SYMBOLS = b"#*$%&|<>"

_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))
_EXACT = textbuf.byte_table(b"", lower=False)
FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")


def longest_repeats(words: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """Per word, the length in words of the longest substring from it that stands twice in its text."""
    n = len(words)
    if n < 2:
        return np.zeros(n, np.int64)
    key = textbuf.mix(words ^ textbuf.mix(text_of.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    key = key[order]
    fresh = np.concatenate(([True], key[1:] != key[:-1]))
    slot = np.arange(n)
    start = np.maximum.accumulate(np.where(fresh, slot, 0))
    rank = np.empty(n, np.int64)
    rank[order] = start
    end = np.searchsorted(text_of, text_of, "right")
    ranks, length = [rank], 1
    while True:
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        at = order[slots]
        follow = at + length
        inside = follow < end[at]
        second = np.where(inside, rank[np.minimum(follow, n - 1)] + 1, 0)
        key = rank[at] * (n + 1) + second
        by = np.argsort(key, kind="stable")
        order[slots] = at[by]
        key = key[by]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        fresh[slots] = new
        rank = rank.copy()
        rank[order[slots]] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        length *= 2
        ranks.append(rank)
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        step = 1 << level
        live = np.flatnonzero((a < n) & (b < n))
        same = live[ranks[level][a[live]] == ranks[level][b[live]]]
        common[same] += step
        a[same] += step
        b[same] += step
    longest = np.zeros(n, np.int64)
    longest[order[1:]] = common
    longest[order[:-1]] = np.maximum(longest[order[:-1]], common)
    return longest


def covered(longest: np.ndarray, at_least: int, span: int | None = None) -> np.ndarray:
    """Words inside a repeat of ``at_least`` words or more (or its first ``span`` words)."""
    at = np.flatnonzero(longest >= at_least)
    delta = np.zeros(len(longest) + 1, np.int64)
    np.add.at(delta, at, 1)
    np.add.at(delta, at + (span or longest[at]), -1)
    return np.cumsum(delta[:-1]) > 0


def duplicate_lines(data: np.ndarray, offsets: np.ndarray, w: textbuf.Words) -> np.ndarray:
    """Per text, its lines with a word that equal an earlier line."""
    breaks = np.flatnonzero(data == 10)
    starts = np.union1d(breaks + 1, offsets[:-1])
    starts = starts[starts < len(data)]
    ends = np.minimum(np.append(starts[1:], len(data)), np.append(breaks, len(data))[np.searchsorted(breaks, starts)])
    texts = np.searchsorted(offsets, starts, "right") - 1
    ends = np.minimum(ends, offsets[texts + 1])
    wordy = np.searchsorted(w.starts, ends) > np.searchsorted(w.starts, starts)
    starts, ends, texts = starts[wordy], ends[wordy], texts[wordy]
    lines = textbuf.range_hashes(_EXACT[data], starts, ends)
    _, once = np.unique(textbuf.mix(lines ^ textbuf.mix(texts.astype(np.uint64) + np.uint64(1))), return_index=True)
    return np.bincount(texts, minlength=len(offsets) - 1) - np.bincount(texts[once], minlength=len(offsets) - 1)


def measure_chunk(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of FIELDS per text."""
    w = textbuf.words(data, offsets, textbuf.SPACE_WORDS_CASED)
    longest = longest_repeats(w.hashes(), w.text_of())
    best = np.zeros(len(offsets) - 1, np.int64)
    np.maximum.at(best, w.text_of(), longest)
    return np.stack([
        w.counts,
        textbuf.sums_by_text((w.norm != 0) & (data & 0xC0 != 0x80), offsets),
        textbuf.sums_by_text(_SYMBOL[data], offsets),
        duplicate_lines(data, offsets, w),
        textbuf.sums_by_text(covered(longest, 3, 3), w.first),
        textbuf.sums_by_text(covered(longest, MIN_REPEAT), w.first),
        np.where(best >= MIN_REPEAT, best, 0),
    ], axis=1)


def measure(text: pa.Array) -> pa.Array:
    rows = [measure_chunk(data, offsets) for _, data, offsets in textbuf.chunks(text)]
    table = np.concatenate(rows) if rows else np.zeros((0, len(FIELDS)), np.int64)
    return pa.StructArray.from_arrays([pa.array(table[:, i]) for i in range(len(FIELDS))], list(FIELDS))


def repetition(text: Column) -> Column:
    """The counts of FIELDS for each text, as a struct."""
    return F.arrow_udf(measure, "struct<" + ",".join(f"{f}:bigint" for f in FIELDS) + ">")(text)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (m["n_repeat_words"] * 100 > m["n_words"] * MAX_TRIGRAM_PERCENT)


def passes(m: Column, max_covered: float = MAX_COVERED, max_repeat: int = MAX_REPEAT) -> Column:
    """The verdict on repetition alone."""
    return (m["covered_words"] <= m["n_words"] * max_covered) & (m["longest_repeat"] <= max_repeat)


def filter_repetitive(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass both, with their columns unchanged."""
    columns = docs.columns
    measured = docs.select(F.struct(*columns).alias("_row"), repetition(F.col(text)).alias("_m"))
    return (measured.where(~base_failed(F.col("_m")) & passes(F.col("_m")))
            .select(*[F.col("_row")[c].alias(c) for c in columns]))
