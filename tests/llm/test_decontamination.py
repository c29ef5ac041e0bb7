"""Benchmark windows against words compared one by one."""

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderlake.llm import decontamination
from tests.llm.conftest import DOC_SCHEMA, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    own, hit, found = words(text), set(), set()
    for item, item_text in items:
        w = words(item_text)
        n = min(10, len(w))
        windows = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(own) - n + 1 if n else 0):
            if tuple(own[i:i + n]) in windows:
                hit.update(range(i, i + n))
                found |= {str(item)} - {"None"}
    return len(own), len(hit), sorted(found)


def found(spark, docs, items, **options):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontamination.contamination(d, b, **options).select(
        "doc_id", "_found.n_words", decontamination.hit_words(F.col("_found")).alias("h"), "_found.items").collect()
    return [(r.n_words, r.h, r["items"]) for r in sorted(rows)]


def cases():
    rng = random.Random(2)
    items = [(i, prose(i, rng.choice([2, 9, 10, 11, 30]), 5000)) for i in range(20)]
    items += [(3, items[3][1]), (None, prose(99, 14, 5000)), (50, None), (51, "..."), (52, "Solo!"), (53, items[2][1])]
    docs = [None, "", "!!", "solo", prose(500, 40)]
    for i, (_, t) in enumerate(items):
        w = (t or "").split(" ")
        docs.append(f"{prose(600 + i, 8)}; {', '.join(w).upper()} -- {prose(700 + i, 5)}")
        docs.append(" ".join(w[:9]))
        docs.append(" ".join(w[1:12] + w[:12]))
    return docs, items


def test_against_brute_force(spark):
    docs, items = cases()
    assert found(spark, docs, items) == [brute(t, items) for t in docs]


def test_blocks_of_windows_give_the_same(spark):
    docs, items = cases()
    assert found(spark, docs, items, max_windows=40) == found(spark, docs, items)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.sampled_from("aAbB,é"), max_size=60).map(" ".join), st.lists(st.sampled_from("aAbé."), max_size=14).map(" ".join))
def test_few_words(spark, text, item):
    assert found(spark, [text], [(1, item)]) == [brute(text, [(1, item)])]


def test_modes_keep_columns(spark, clashing, no_docs):
    items = spark.createDataFrame([(1, "A b, c D")], "item_id bigint, text string")
    left = decontamination.decontaminate(clashing, items)
    assert left.columns == clashing.columns and left.count() == 14
    assert left.where("doc_id = 10").count() == 0
    assert sorted(map(tuple, left.collect()), key=repr) == sorted(
        (tuple(r) for r in clashing.collect() if r.doc_id != 10), key=repr)
    cut = decontamination.decontaminate(clashing, items, mode="spans")
    assert cut.count() == 15 and cut.where("doc_id = 10").first().text == ""
    assert decontamination.decontaminate(no_docs, items).count() == 0
    none = items.limit(0)
    assert decontamination.decontaminate(clashing, none).count() == 15


def test_spans_cut_only_the_hit_words(spark):
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, f"Before. {item.title()}! After", "en", "a", 0), (2, "clean", "en", "a", 0)], DOC_SCHEMA)
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    cut = decontamination.decontaminate(docs, items, mode="spans")
    assert [r.text for r in cut.orderBy("doc_id").collect()] == ["Before. ! After", "clean"]
