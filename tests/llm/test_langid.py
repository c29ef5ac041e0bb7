"""Language ID against plain versions, and its rejection of noise and languages that it didn't learn."""

import base64
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlake.llm import langid
from orderlake.llm.common import held_out
from orderlake.sources.tables import read_table
from tests.conftest import SF_ORACLE
from tests.llm.conftest import DOC_SCHEMA


def plain_counts(text):
    """n-gram buckets of a text, gram by gram."""
    b = list(text.encode())
    out = []
    for i, x in enumerate(b):
        if x < 128:
            out.append(ord(chr(x).lower()) if chr(x).isalpha() else 32)
        elif 0x80 <= x <= 0x9E and i and b[i - 1] == 0xC3:
            out.append(x + 32)
        else:
            out.append(x)
    found = Counter()
    for n, seed in ((2, 0x9E3779B1), (3, 0x85EBCA6B)):
        for i in range(len(out) - n + 1):
            gram = 0
            for x in out[i:i + n]:
                gram = (gram * 257 + x) % 2 ** 32
            found[(gram * seed % 2 ** 32) >> 19] += 1
    return found


def plain_cosine(text, idf, centroid):
    v = {g: math.log(1 + n) * float(idf[g]) for g, n in plain_counts(text).items()}
    size = math.sqrt(sum(x * x for x in v.values()))
    return sum(x * float(centroid[g]) for g, x in v.items()) / size


@pytest.fixture(scope="module")
def docs(spark):
    return read_table(spark, SF_ORACLE, "documents")


@pytest.fixture(scope="module")
def model(docs):
    return langid.train(docs)


def test_document_frequencies_cover_every_learnable_row(docs, model):
    rows = [r.text for r in langid.learnable(docs.where("doc_id % 10 = 3")).collect()]
    n, having = langid.document_frequencies(langid.learnable(docs.where("doc_id % 10 = 3")).repartition(5))
    want = Counter(g for t in rows for g in plain_counts(t))
    assert n == len(rows) and dict(want) == {int(g): int(having[g]) for g in np.flatnonzero(having)}
    n, having = langid.document_frequencies(langid.learnable(docs))
    assert n == docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & langid.has_letter(F.col("text"))).count()
    assert np.allclose(model.idf, np.log((1 + n) / (1 + having)) + 1, atol=1e-5)


def test_predictions_equal_plain_cosines(docs, model):
    few = docs.where("doc_id % 97 = 0")
    for r in few.select("text", langid.identify(few, model).alias("p")).collect():
        if not r.text or r.p["lang"] == "und":
            continue
        cosines = [plain_cosine(r.text, model.idf, c) for c in model.centroids]
        assert abs(max(cosines) - r.p.score) < 1e-3
        assert max(c for c, lang in zip(cosines, model.langs) if lang == r.p["lang"]) > max(cosines) - 1e-4


def test_noise_and_unlearned_languages_are_rejected_and_clean_rows_kept(spark, docs, model):
    rng = random.Random(5)
    noise = [base64.b64encode(rng.randbytes(1200)).decode(),
             " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(rng.randint(3, 9))) for _ in range(200)),
             "Съешь же ещё этих мягких французских булок да выпей чаю, сказал он и ушёл домой. " * 8,
             "Ο γρήγορος καφέ αλεπού πηδάει πάνω από το τεμπέλικο σκυλί κάθε πρωί στο χωριό. " * 8,
             "敏捷的棕色狐狸每天早上跳过村里那只懒惰的狗。" * 12]
    planted = spark.createDataFrame([(i, t, None, "x", len(t)) for i, t in enumerate(noise)], DOC_SCHEMA)
    assert all(r.p.rejected for r in planted.select(langid.identify(planted, model).alias("p")).collect())
    judged = docs.where(F.col("lang").isNotNull() & langid.has_letter(F.col("text"))).select(
        langid.identify(docs, model).alias("p"))
    assert judged.where("p.rejected").count() <= 0.001 * judged.count()


def test_short_clean_texts_are_kept(docs, model):
    """The first eight words of clean texts, shorter than any that the model was calibrated on."""
    short = docs.where(langid.has_letter(F.col("text")) & (F.col("doc_id") % 5 == 1)).withColumn(
        "text", F.array_join(F.slice(F.split("text", r"\s+"), 1, 8), " "))
    judged = short.where(langid.has_letter(F.col("text"))).select(langid.identify(short, model).alias("p"))
    lost = judged.where("p.rejected").collect()
    assert len(lost) <= 0.02 * judged.count(), lost


def test_a_garbled_row_does_not_move_the_limit(spark, docs):
    """Rows of noise under a learned label, and one text on many rows."""
    some = docs.where("doc_id % 4 = 1").select(*[c.split()[0] for c in DOC_SCHEMA.split(",")])
    base = langid.train(some)
    junk = [(10_000_000 + i, "qzx jvk wqp " * 40 + str(i), base.langs[0], "x", 1) for i in range(3)]
    copies = [(7, "the same few words again and again in one text", base.langs[0], "x", 1)] * 3000
    damaged = some.unionByName(spark.createDataFrame(junk, DOC_SCHEMA))
    limits = langid.train(damaged).limits
    assert np.allclose(limits, base.limits, atol=0.06) and (limits[:, 3:] > 0.05).all(), (limits.round(2), base.limits.round(2))
    rows = langid.learnable(some.unionByName(spark.createDataFrame(copies, DOC_SCHEMA)))
    drawn = langid.training_sample(rows)
    assert len({(r.lang, bytes(r.code)) for r in drawn}) == len(drawn)
    assert {r.lang for r in drawn} == set(base.langs)
    per_lang = Counter(r.lang for r in drawn)
    assert min(per_lang.values()) >= min(langid.SAMPLE_LEAST, min(
        r["count"] for r in langid.learnable(some).distinct().groupBy("lang").count().collect()))


def test_class_limits():
    half = langid.REJECT
    got = langid.class_limits({3: (100, 0.4), 5: (60, 0.6), 1: (2, 0.01)})
    assert got == pytest.approx([half * x for x in (0.05, 0.1, 0.2, 0.4, 0.4, 0.6, 0.6)])
    assert langid.class_limits({1: (90, 0.9), 3: (100, 0.4)}) == pytest.approx([half * 0.4] * 7)
    assert langid.class_limits({2: (1, 0.4)})[2] == pytest.approx(half * 0.4)
    assert langid.class_limits({}) == [0.0] * langid.SIZE_CLASSES


def test_codes_keep_every_count(spark):
    text = "abc déf " * 70_000
    coded = spark.createDataFrame([(text,)], "text string").select(langid._encoded(F.col("text")).alias("c")).first().c
    tf = langid._decoded([bytes(coded)])[0]
    assert {int(g): int(tf[g]) for g in np.flatnonzero(tf)} == dict(plain_counts(text))
