"""K-d tree shards: balance, slots and odd rows."""

import random
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from orderlake.llm import sharding
from tests.llm.conftest import DOC_SCHEMA


def placed(df, shards):
    return (sharding.slots(df.select("doc_id", sharding.size_of(F.col("text")).alias("size"),
                                     sharding.text_crc32(F.col("text")).alias("text_crc32"),
                                     sharding.plan(df, shards).alias("shard")), "shard", "slot").collect())


def check(found, shards):
    by = defaultdict(list)
    for r in found:
        assert 0 <= r.shard < shards
        by[r.shard].append(r)
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    return {s: sum(r["size"] for r in own) for s, own in by.items()}


def test_balanced_bytes_with_a_hot_source(spark):
    rng = random.Random(5)
    data = [(i, "x" * rng.choice([0, 10, 100, 400]), rng.choice(["en", "fr", None]),
             "hot" if i % 3 == 0 else f"s{rng.randrange(20)}", 0) for i in range(3000)]
    df = spark.createDataFrame(data, DOC_SCHEMA)
    for shards in (1, 7, 16):
        sums = check(placed(df, shards), shards)
        mean = sum(sums.values()) / shards
        assert len(sums) == shards
        assert max(abs(b - mean) for b in sums.values()) <= 2 * 416


def test_equal_ids_metadata_and_reruns(spark):
    data = [(i, "same text", "en", "a", 0) for i in range(500)]
    df = spark.createDataFrame(data, DOC_SCHEMA)
    first, second = placed(df.repartition(5), 10), placed(df.repartition(2), 10)
    assert Counter(map(tuple, first)) == Counter(map(tuple, second))
    assert max(check(first, 10).values()) - min(check(first, 10).values()) <= 2 * 25
    assert {r.text_crc32 for r in first} == {zlib.crc32(b"same text")}


def test_target_bytes(spark):
    df = spark.createDataFrame([(i, "x" * 84, "en", f"s{i % 5}", 0) for i in range(400)], DOC_SCHEMA)
    sizes = [r.n for r in sharding.sharded(df, target_bytes=1000).groupBy("shard").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 40 and max(sizes) <= 12


def test_odd_rows(odd_docs, no_docs, clashing):
    found = placed(odd_docs, 4)
    assert len(found) == 15
    check(found, 4)
    assert {r["size"] for r in found if r.text_crc32 is None} == {16}
    assert placed(no_docs, 4) == []
    out = sharding.sharded(clashing, 4)
    assert out.columns == [*clashing.columns, "_shard", "_slot"] and out.count() == 15
