"""Language ID, quality and toxicity: gradients, held-out accuracy, odd rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderlake.llm import langid, quality_mil, textbuf, toxicity
from orderlake.llm.common import held_out, labelled_sample
from orderlake.sources.tables import read_table
from tests.conftest import SF_ORACLE
from tests.llm.conftest import DOC_SCHEMA


def numeric_gradient(loss, p, picks, step=1e-5):
    out = {}
    for k, at in picks:
        old = p[k][at]
        p[k][at] = old + step
        high = loss()
        p[k][at] = old - step
        low = loss()
        p[k][at] = old
        out[k, at] = (high - low) / (2 * step)
    return out


def log_loss(score, y):
    return float(-np.mean(y * np.log(score) + (1 - y) * np.log(1 - score)))


def picks(p, rng, each=4):
    return [(k, tuple(rng.integers(0, n) for n in v.shape)) for k, v in p.items() for _ in range(each)]


def test_mil_gradient():
    rng = np.random.default_rng(1)
    p = {"w": rng.normal(size=(5, 4)), "b": rng.normal(size=4), "v": rng.normal(size=(4, 3)), "u": rng.normal(size=(4, 3)),
         "a": rng.normal(size=3), "c": rng.normal(size=4), "d": rng.normal(size=1)}
    model = quality_mil.Model(np.zeros(5), np.ones(5), p, 0.5)
    x, first, y = rng.normal(size=(9, 5)), np.array([0, 1, 4, 9]), np.array([1.0, 0.0, 1.0])
    got = model.gradient(model.forward(x, first), first, y)
    for (k, at), d in numeric_gradient(lambda: log_loss(model.forward(x, first)["score"], y), p, picks(p, rng)).items():
        assert got[k][at] == pytest.approx(d, abs=1e-6), k


def test_recurrent_gradient():
    rng = np.random.default_rng(2)
    h, w = toxicity.HIDDEN, toxicity.WIDTH
    shapes = {"words": (6, w), "chars": (7, w), "att": (2 * h, h), "att_out": (h,), "out": (2 * h,), "bias": (1,)}
    for d in "fb":
        shapes |= {f"{d}_in": (w, 3 * h), f"{d}_bias": (3 * h,), f"{d}_gates": (h, 2 * h), f"{d}_cand": (h, h)}
    p = {k: rng.normal(size=s) * 0.5 for k, s in shapes.items()}
    model = toxicity.Model(np.zeros(0, np.uint64), p, 0.5)
    ids, chars = rng.integers(1, 6, (5, 3)), rng.integers(0, 7, (5, 3, 4))
    sizes, y = np.array([5, 2, 0]), np.array([1.0, 0.0, 1.0])

    def loss():
        logit, _ = model.run(model.terms(model.inputs(ids, chars)), sizes)
        return log_loss(1 / (1 + np.exp(-logit)), y)

    got = model.gradient(ids, chars, sizes, y)
    for (k, at), d in numeric_gradient(loss, p, picks(p, rng, 6)).items():
        if k != "words" or at[0] != 0:
            assert got[k][at] == pytest.approx(d, abs=1e-6), k


def scores(module, model, texts):
    return np.concatenate([model.score(d, o) for _, d, o in textbuf.chunks(pa.array(texts, pa.string()))])


def test_toxicity_learns_words_and_stems_anywhere():
    rng = np.random.default_rng(3)

    def text(n, bad):
        words = [f"w{rng.integers(0, 3000)}" for _ in range(n)]
        if bad:
            words[rng.integers(0, n)] = rng.choice(["vileword", f"gargoyle{rng.integers(0, 50)}"])
        return " ".join(words)

    data = [(text(int(rng.integers(5, 200)), i % 4 == 0), int(i % 4 == 0)) for i in range(900)]
    model = toxicity.fit(data[:700])
    s = scores(toxicity, model, [t for t, _ in data[700:]])
    assert np.mean((s >= 0.5) == np.array([y for _, y in data[700:]])) > 0.97
    long = ["a " * 3000 + "VILEWORD! " + "b " * 3000, "a " * 6000, None, "", " .!"]
    s = scores(toxicity, model, long)
    assert s[0] >= 0.5 and (s[1:] < 0.5).all() and ((s >= 0) & (s <= 1)).all()


def test_quality_learns_from_every_passage():
    rng = np.random.default_rng(4)
    passages = 200
    # Where 64 evenly spaced passages of a text leave gaps.
    gaps = np.setdiff1d(np.arange(passages), np.linspace(0, passages - 1, 64).astype(int))

    def text(bad):
        words = [[f"word{rng.integers(0, 300)}" for _ in range(quality_mil.PASSAGE_WORDS)] for _ in range(passages)]
        for i in rng.choice(gaps, 20, replace=False):
            words[i] = ["#|$"] * quality_mil.PASSAGE_WORDS if bad else words[i]
        return " ".join(w for passage in words for w in passage)

    data = [(text(i % 2 == 0), i % 2) for i in range(120)]
    model = quality_mil.fit(data[:80])
    s = scores(quality_mil, model, [t for t, _ in data[80:]])
    assert np.mean((s >= 0.5) == np.array([y for _, y in data[80:]])) > 0.95


def test_windows_cover_every_word():
    for n in (0, 1, 23, 24, 25, 36, 37, 100):
        data = " ".join(f"w{i}" for i in range(n)).encode()
        c = toxicity.read(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        covered = {i for s, k in zip(c.starts, c.sizes) for i in range(s, s + k)}
        assert covered == set(range(n)) and c.first.tolist() == [0, len(c.starts)]


def test_models_without_both_labels():
    for module in (toxicity, quality_mil):
        assert scores(module, module.fit([]), ["a", None]).tolist() == [module.fit([]).share] * 2
        assert scores(module, module.fit([("a", 1)]), ["a"]).tolist() == [1.0]


def test_held_out_accuracy_on_the_tables(spark):
    docs, labels = read_table(spark, SF_ORACLE, "documents"), read_table(spark, SF_ORACLE, "labels")
    tested = docs.join(labels, "doc_id").where(held_out(F.col("doc_id")))
    good = quality_mil.train(docs, labels)
    bad = toxicity.train(docs, labels)
    lang = langid.identify(tested, langid.train(docs))
    rows = tested.select("quality", "toxic", "lang", quality_mil.score(tested, good).alias("q"),
                         toxicity.score(tested, bad).alias("t"), lang.alias("l")).collect()
    assert np.mean([(r.q >= 0.3) == r.quality for r in rows]) > 0.9
    assert np.mean([(r.t >= 0.5) == r.toxic for r in rows]) > 0.9
    assert np.mean([r.l["lang"] == r.lang for r in rows]) > 0.95


def test_sample_leaves_out_held_out_rows(spark):
    docs = spark.createDataFrame([(i, f"t{i}", "en", "a", 0) for i in range(100)], DOC_SCHEMA)
    labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 2).alias("toxic"))
    out = {r.doc_id for r in docs.where(held_out(F.col("doc_id"))).collect()}
    drawn = labelled_sample(docs, labels, "toxic", 1000)
    assert {int(t[1:]) for t, _ in drawn} == set(range(100)) - out
    assert labelled_sample(docs, labels, "toxic", 10) == [s for s in drawn if s in labelled_sample(docs, labels, "toxic", 10)]
    assert len(labelled_sample(docs, labels, "toxic", 10)) == 10


def test_odd_rows(odd_docs, no_docs, clashing):
    model = langid.train(odd_docs)
    got = {(r.doc_id, r.text): r.p for r in odd_docs.select("doc_id", "text", langid.identify(odd_docs, model).alias("p")).collect()}
    assert got[4, None] == got[5, ""] == got[6, " \t\n "] == ("und", 0.0, True)
    assert all(0 <= p.score <= 1 and p.lang in ("en", "fr", "de", "xx", "und") for p in got.values())
    kept = langid.keep_identified(clashing)
    assert kept.columns == clashing.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} >= {1, 2, 3, 7, 11}
    assert langid.train(no_docs) is None and langid.keep_identified(no_docs).count() == 0
    nothing = odd_docs.select(langid.identify(odd_docs, None).alias("p")).distinct().collect()
    assert nothing == [(("und", 0.0, True),)]
    labels = odd_docs.select("doc_id", F.lit(None).cast("int").alias("quality"), F.lit(1).alias("toxic"))
    for module, label in ((quality_mil, "quality"), (toxicity, "toxic")):
        m = module.train(odd_docs, labels, label)
        s = [r.s for r in clashing.select(module.score(clashing, m).alias("s")).collect()]
        assert len(s) == 15 and all(0 <= x <= 1 for x in s)


def test_k_means_finds_separate_clusters():
    rng = np.random.default_rng(1)
    centers = np.eye(3, 6)
    v = langid._unit(np.concatenate([c + 0.05 * rng.normal(size=(20, 6)) for c in centers]))
    found = langid.k_means(v, 3)
    assert sorted((found @ centers.T).argmax(axis=1).tolist()) == [0, 1, 2]
