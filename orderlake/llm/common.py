"""Small Spark helpers that several operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake.config import materialize

HELD_OUT_EVERY = 5
# A key with more than 1/HOT_SHARE of all rows is hot; there can be at most HOT_SHARE such keys.
HOT_SHARE = 1000
# Ids that may be broadcast: 16 MB of them.
MAX_BROADCAST_IDS = 2_000_000
# Rows that a Python worker gets at once where texts are worked on.  Both the JVM, outside its heap, and the worker
# hold a batch whole, and a worker that is reused keeps the memory of its largest one.
BATCH_ROWS = 256
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Buckets per group of a distributed running sum.
SCAN_BUCKETS = 4096


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as ``--py-files`` would."""
    sc = spark.sparkContext
    if getattr(sc, "_orderlake_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="orderlake-py-"), "orderlake_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(archive)
    sc._orderlake_shipped = True


def small_batches(spark: SparkSession) -> None:
    """From now on the session hands its Python workers at most BATCH_ROWS rows at once; a smaller setting stays."""
    if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))


def held_out(doc_id: Column) -> Column:
    """True where crc32(doc_id as text) mod 5 is 0; a null id counts as its empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % HELD_OUT_EVERY == 0


def spread(*columns: Column) -> Column:
    """A repeatable pseudo-random integer in [0, 2^60) of the columns' text, the same in any SQL engine."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def running_sum(df: DataFrame, group: str, order: str, value: str, out: str, ties: list[str] | None = None,
                facts: DataFrame | None = None) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the group's earlier rows, by ``order`` and then ``ties``.

    ``group`` is never null; ``order`` holds integers in [0, 2^60), spread evenly (``spread``).
    No task holds a group: rows are summed by (group, leading bits of order), the sums are
    scanned (SCAN_BUCKETS rows a group at most), and rows are scanned within their bucket.
    ``facts`` (one row per group) is joined to the sums, so that a group with a third of all
    rows meets its facts bucket by bucket.  ``ties`` should tell apart all rows that differ in
    ``value``; rows that tie are interchangeable, so the result is repeatable.
    """
    bucket = F.shiftright(F.col(order), 60 - SCAN_BUCKETS.bit_length() + 1).cast("int")
    rows = df.withColumn("_bucket", bucket)
    sums = rows.groupBy(group, "_bucket").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = (sums.withColumn("_base", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
            .drop("_sum"))
    if facts is not None:
        base = base.join(facts, group)
    within = (Window.partitionBy(group, "_bucket").orderBy(order, *(ties or []))
              .rowsBetween(Window.unboundedPreceding, -1))
    return (rows.withColumn("_before", F.coalesce(F.sum(value).over(within), F.lit(0)))
            .join(base, [group, "_bucket"])
            .withColumn(out, F.col("_base") + F.col("_before"))
            .drop("_base", "_before", "_bucket"))


def ranked(rows: DataFrame, group: list[str], order: list[str], out: str, count: str, at: str | None = None) -> DataFrame:
    """Adds ``out``, the place in the group by ``order`` from 0, and ``count``, the group's rows.

    Also ``at``, if named: a number that grows along all groups, with gaps.

    ``group`` is never null, ``rows`` should be stored.  No task holds a group: rows are sorted by
    range, rows that tie being dealt out by a salt, and stored; a group's rows in one partition are a run,
    and a place is the rows of the group's earlier runs plus the place in the run.  Rows that tie are
    placed in any order.
    """
    keys = [*group, *order, "_salt"]
    place = (rows.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id()))
             .repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_salt")
             .withColumn("_at", F.monotonically_increasing_id()))
    stored = materialize(place, "ranked").withColumn("_part", F.shiftright("_at", 33))
    runs = stored.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    by_group = Window.partitionBy(*group)
    earlier = by_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = runs.select(*group, "_part", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_base"),
                       F.sum("_rows").over(by_group).alias(count))
    return (stored.join(base, [*group, "_part"]).withColumn(out, F.col("_at") + F.col("_base"))
            .withColumnRenamed("_at", at or "_at").drop("_at", "_part", "_base"))


def join_hot_apart(rows: DataFrame, side: DataFrame, key: str, count: str, how: str = "left") -> DataFrame:
    """Join many rows to one row per key, with hot keys' rows left where they are.

    ``side`` has one row per key and in ``count`` how many of ``rows`` have it.  Keys with
    over 1/HOT_SHARE of the counted rows are at most HOT_SHARE, so their rows of ``side`` are
    broadcast; all other keys meet in a shuffle join.  ``side`` should be stored, it is read
    three times.
    """
    total = side.agg(F.sum(count)).first()[0] or 0
    hot_over = max(total // HOT_SHARE, 1)
    hot = side.where(F.col(count) > hot_over).drop(count)
    marked = rows.join(F.broadcast(hot.select(F.col(key), F.lit(True).alias("_hot"))), key, "left")
    warm = marked.where(F.col("_hot").isNull()).drop("_hot").join(
        side.where(F.col(count) <= hot_over).drop(count), key, how)
    return warm.unionByName(marked.where("_hot").drop("_hot").join(F.broadcast(hot), key, "inner"))


def bounded_semi_join(rows: DataFrame, ids: DataFrame, key: str, id_key: str, wanted: bool = True,
                      unless: Column | None = None) -> DataFrame:
    """``rows`` whose ``key`` is (or, with ``wanted`` false, isn't) among ``ids``; rows ``unless`` stay anyway.

    The ids, which should be stored, are broadcast if they are at most MAX_BROADCAST_IDS; more are met
    in a shuffle join.  A null key is equal to a null id.  The columns of ``rows`` are unchanged.
    """
    marks = ids.select(F.col(id_key).alias("_semi_id")).distinct().withColumn("_semi_found", F.lit(True))
    if ids.count() <= MAX_BROADCAST_IDS:
        marks = F.broadcast(marks)
    joined = rows.join(marks, F.col(key).eqNullSafe(F.col("_semi_id")), "left")
    keep = F.col("_semi_found").isNotNull() if wanted else F.col("_semi_found").isNull()
    if unless is not None:
        keep = keep | unless
    return joined.where(keep).drop("_semi_id", "_semi_found")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> list[tuple[str, int]]:
    """At most ``rows`` (text, label) pairs of documents that aren't held out, the same on every run.

    The sample is drawn from the narrow label table; only its documents' texts reach the driver.
    """
    drawn = (labels.select("doc_id", F.col(label).cast("int").alias("label"))
             .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .distinct().orderBy(spread(F.col("doc_id")), "doc_id", "label").limit(rows))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(drawn), "doc_id")
    return [(r.text, r.label) for r in texts.orderBy(spread(F.col("doc_id")), "doc_id", "label", "text").collect()]
