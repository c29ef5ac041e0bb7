"""Mixing: targets, taken words, positions and the mix itself."""

import random

import pytest
from pyspark.sql import functions as F

from orderlake.llm import mixing
from tests.llm.conftest import CLASHING, DOC_SCHEMA, rows


def water_fill(sizes: dict, share=1.5, epochs=2):
    """The contract's words: share by weight, cap, share the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, free = {s: 0.0 for s in sizes}, share * sum(sizes.values()), set(names)
    while left > 1e-9 and free:
        total = sum(weight[s] for s in free)
        give = {s: left * weight[s] / total for s in free}
        left = 0.0
        for s, g in give.items():
            target[s] += g
            cap = epochs * sizes[s]
            if target[s] >= cap:
                left += target[s] - cap
                target[s] = float(cap)
                free.discard(s)
    return target


def plan_rows(df):
    return mixing.plan(df).select("doc_id", "source", "size", "source_size", "target", "epochs").collect()


def test_targets_and_taken_words(spark):
    rng = random.Random(3)
    data = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 300])), "en",
             rng.choice(["a", "a", "a", "b", "c", "é", "Z", None]), 0) for i in range(400)]
    found = plan_rows(spark.createDataFrame(data, DOC_SCHEMA))
    sizes = {}
    for r in found:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    want = water_fill(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert sum(r.epochs) <= 2 * r["size"]
        taken[r.source] += sum(r.epochs)
    for s, t in taken.items():
        assert t == int(want[s] + 1e-9)


def test_reruns_agree_and_order_follows_demand(spark):
    data = [(i, " ".join(["w"] * (i % 7 + 1)), "en", "abc"[i % 3], 0) for i in range(300)]
    df = spark.createDataFrame(data, DOC_SCHEMA)
    first = mixing.curriculum(mixing.plan(df.repartition(7))).collect()
    second = mixing.curriculum(mixing.plan(df.repartition(2))).collect()
    assert [tuple(r) for r in first] == [tuple(r) for r in second]
    placed = [r for r in first if r.position is not None]
    assert [r.position for r in placed] == sorted(r.position for r in placed)
    assert all(0 <= r.position <= mixing.TIME_STEPS for r in placed)
    # Source a (ramp 0.5 -> 1.5) has taken t/2 + t^2/2 of its target by time t, wherever t is.
    own = sorted((r for r in placed if r.source == "a"), key=lambda r: r.position)
    done = 0
    for r in own:
        t = (r.position + 0.5) / mixing.TIME_STEPS
        assert done + r["words"] / 2 == pytest.approx(r.target * (t / 2 + t * t / 2), abs=0.01 * r.target + 1e-3)
        done += r["words"]


def test_odd_rows(odd_docs, no_docs):
    found = plan_rows(odd_docs)
    assert len(found) == 15
    assert all(sum(r.epochs) == 0 for r in found if r["size"] == 0)
    assert plan_rows(no_docs) == [] and mixing.mixed(no_docs).count() == 0


def test_one_source_without_words(spark):
    found = plan_rows(spark.createDataFrame([(1, None, None, "a", 0), (2, " ", None, None, 0)], DOC_SCHEMA))
    assert {(r["size"], r.target, sum(r.epochs)) for r in found} == {(0, 0.0, 0)}


def test_mixed_keeps_columns_and_counts_copies(clashing, odd_docs):
    mixed = mixing.mixed(clashing)
    assert mixed.columns == clashing.columns
    assert mixed.select(*CLASHING).distinct().count() == 1
    plain = rows(mixing.mixed(odd_docs).groupBy("doc_id", "source").count())
    assert plain == rows(mixed.groupBy("doc_id", "source").count())
    assert mixed.where(~F.coalesce("text", F.lit("")).rlike(r"\S")).count() == 0
