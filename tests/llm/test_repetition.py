"""Suffix-array repetition against windows counted one by one."""

import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderlake.llm import repetition, textbuf

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeated(words, n):
    seen = {}
    for i in range(len(words) - n + 1):
        seen.setdefault(tuple(words[i:i + n]), []).append(i)
    return [i for at in seen.values() if len(at) > 1 for i in at]


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    longest = 0
    while repeated(words, longest + 1):
        longest += 1

    def cover(n):
        return len({j for i in repeated(words, n) for j in range(i, i + n)}) if n <= len(words) else 0

    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            cover(3), cover(repetition.MIN_REPEAT), longest if longest >= repetition.MIN_REPEAT else 0)


def measured(texts, chunk=1 << 20):
    parts = [repetition.measure_chunk(d, o) for _, d, o in textbuf.chunks(pa.array(texts, pa.string()), chunk)]
    return [tuple(r) for p in parts for r in p.tolist()]


@settings(max_examples=120, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "A", "é#", "\n", "\t", "c\n", "x y"]), max_size=60), max_size=4),
       st.sampled_from([16, 1 << 20]))
def test_short_texts(parts, chunk):
    texts = [" ".join(p) for p in parts] + [None, ""]
    assert measured(texts, chunk) == [brute(t) for t in texts]


def test_periodic_nested_and_long_repeats():
    rng = random.Random(4)
    some = [f"w{i}" for i in range(300)]
    rng.shuffle(some)
    texts = ["a " * 200, "a b " * 150, " ".join(some + some[50:170] + ["z"] + some[100:115]), " ".join(some),
             " ".join(some[:15] * 3 + some), "\n".join(["same line"] * 4 + ["", " ", "other"])]
    assert measured(texts) == [brute(t) for t in texts]
    assert measured(texts)[2][6] == 120


def test_long_text_is_exact():
    rng = random.Random(9)
    words = [f"w{rng.randrange(30000)}" for _ in range(40_000)]
    words[30_000:30_500] = words[100:600]
    (row,) = measured([" ".join(words)])
    longest = repetition.longest_repeats(np.array([hash(w) & (2**63 - 1) for w in words], np.uint64), np.zeros(len(words), np.int64))
    assert row[6] == 500 == longest.max() and row[5] == 1000


def test_filter_on_odd_rows(spark, odd_docs, no_docs, clashing):
    kept = repetition.filter_repetitive(clashing)
    assert kept.columns == clashing.columns
    assert sorted((r.doc_id for r in kept.select("doc_id").collect()), key=repr) == [1, 2, 2, 3, 7, None]
    assert repetition.filter_repetitive(no_docs).count() == 0
    m = odd_docs.select("text", repetition.repetition(F.col("text")).alias("m")).collect()
    assert all(tuple(r.m) == brute(r.text) for r in m if len(r.text or "") < 10_000)
