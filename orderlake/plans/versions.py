"""Which version of an order the published fact shows (S13, X4): order index and delete files.

Each run that brings orders keeps them all, as they came, in its part of the fact.  Beside the parts stand

* the **order index**: per part the order ids in hash buckets (``bucket=…`` folders), so a publish
  looks for its orders in the buckets they fall into, and nowhere else;
* the **delete files**: per part the order ids whose version there isn't shown, because another part
  has a better one.  Readers leave them out (merge on read); data files are never rewritten.

A publish settles the orders that it brings and, if its run is repeated, those that the run brought
before: of each order's versions in all parts, the largest ordering tuple is shown.  So a
repeated run that no longer has an order brings the other runs' version back.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from orderlake.config import child_names, materialize_at, path_exists
from orderlake.plans.partials import partials_of

ORDER, RUN, BUCKET = "order_id", "run_id", "bucket"
INDEX_ROW = StructType([StructField(ORDER, StringType()), StructField(RUN, StringType()), StructField(BUCKET, IntegerType())])
DELETE_ROW = StructType([StructField(ORDER, StringType()), StructField(RUN, StringType())])


def index_of(table: str) -> str:
    return f"{table}/index"


def deletes_of(table: str) -> str:
    return f"{table}/deletes"


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64(ORDER), F.lit(buckets)).cast("int").alias(BUCKET)


@dataclass
class Parts:
    """What the manifest says of a fact table: part -> files and row counts."""

    data: dict[str, tuple[str, int]]
    index: dict[str, str]
    deletes: dict[str, tuple[str, int]]
    partials: dict[str, tuple[str, int]] = field(default_factory=dict)

    @classmethod
    def of(cls, entries: list[tuple], table: str) -> Parts:
        newest: dict[tuple[str, str], tuple] = {}
        kinds = (table, index_of(table), deletes_of(table), partials_of(table))
        for tbl, _, path, rows, seq, part in entries:
            if tbl in kinds and seq > newest.get((tbl, part), (-1,))[0]:
                newest[tbl, part] = (seq, path, rows)
        found = {t: {part: (path, rows) for (tbl, part), (_, path, rows) in newest.items()
                     if tbl == t and (rows or t == partials_of(table))}  # a partial may be empty
                 for t in kinds}
        index = {p: path for p, (path, _) in found[index_of(table)].items()}
        return cls(found[table], index, found[deletes_of(table)], found[partials_of(table)])

    def live(self, part: str) -> int:
        return self.data.get(part, ("", 0))[1] - self.deletes.get(part, ("", 0))[1]

    @property
    def shown(self) -> list[str]:
        return [p for p in self.data if self.live(p)]


def _read(spark: SparkSession, schema: StructType, base: str, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)


def read_index(spark: SparkSession, base: str, index: dict[str, str], buckets: list[int] | None = None) -> DataFrame:
    """(order_id, run_id, bucket) of some parts; ``buckets`` are the only ones opened."""
    rows = _read(spark, INDEX_ROW, base, list(index.values()))
    return rows if buckets is None else rows.where(F.col(BUCKET).isin(*buckets))


def read_deletes(spark: SparkSession, base: str, deletes: dict[str, tuple[str, int]]) -> DataFrame:
    return _read(spark, DELETE_ROW, base, [path for path, _ in deletes.values()])


def write_index(staged: DataFrame, base: str, run_id: str, buckets: int) -> str:
    """The run's order ids, a folder per bucket; returns the path of its part."""
    folder = f"{base}/version={run_id}-{uuid.uuid4().hex[:8]}"
    (staged.select(ORDER, F.lit(run_id).alias(RUN), bucket_of(buckets))
     .repartition(BUCKET).sortWithinPartitions(BUCKET, ORDER).write.option("compression", "zstd").partitionBy(RUN, BUCKET).parquet(folder))
    return f"{folder}/{RUN}={run_id}"


@dataclass
class Settled:
    """The outcome of ``settle``: part -> (path, rows) of the delete files that change.

    ``moved`` has the orders whose version in a part (run_id) is hidden now (_n 1) or shown again (-1).
    ``scratch`` are folders to drop once ``moved`` has been read.
    """

    deletes: dict[str, tuple[str, int]]
    opened: list[int]
    moved: DataFrame | None = None
    scratch: list[str] = field(default_factory=list)


def _buckets_at(spark: SparkSession, paths: list[str | None]) -> list[int]:
    """The buckets that parts of the index have, by their folders."""
    return sorted({int(n.split("=")[1]) for p in paths if p for n in child_names(spark, p) if n.startswith(f"{BUCKET}=")})


def _compare(versions: DataFrame, best: str) -> tuple[DataFrame, str]:
    """(order_id, _runs, _shown): the runs of an order's versions, and the one with the largest tuple; and a folder to drop.

    Tuples are compared by their first field alone, so that it is all that is shuffled; whole tuples only where
    versions of several runs tie for the largest first field.  An order has as many versions as runs brought it.
    """
    first = versions.schema[best].dataType.names[0]
    narrow = versions.select(ORDER, RUN, F.col(best)[first].alias("_k")).groupBy(ORDER).agg(
        F.max("_k").alias("_top"), F.collect_list(F.struct(RUN, "_k")).alias("_all"))
    narrow, path = materialize_at(narrow.select(
        ORDER, F.col("_all")[RUN].alias("_runs"),
        F.array_distinct(F.filter("_all", lambda v: v["_k"].eqNullSafe(F.col("_top")))[RUN]).alias("_best_runs")), "compared-versions")
    clear = narrow.where(F.size("_best_runs") == 1).select(ORDER, "_runs", F.col("_best_runs")[0].alias("_shown"))
    tied = narrow.where(F.size("_best_runs") > 1)
    if tied.isEmpty():
        return clear, path
    among = versions.join(tied.select(ORDER, F.explode("_best_runs").alias(RUN)), [ORDER, RUN], "left_semi")
    shown = among.groupBy(ORDER).agg(F.max(F.struct(best, RUN))[RUN].alias("_shown"))
    return clear.unionByName(tied.join(shown, ORDER).select(ORDER, "_runs", "_shown")), path


def settle(spark: SparkSession, staged: DataFrame, run_id: str, parts: Parts, index_base: str, deletes_base: str,
           read_parts, best: str, own_index: str | None) -> Settled:
    """Settle the orders of ``staged`` (order_id and ``best``; stored), and those that the run had before.

    ``read_parts(names)`` gives the rows (order_id, run_id, ``best``) of some parts; ``own_index`` is the index of
    ``staged`` (None without rows).
    """
    before = parts.index.get(run_id)
    others = {p: path for p, path in parts.index.items() if p != run_id}
    opened = _buckets_at(spark, [own_index, before])  # at most as many as there are buckets
    if not others and not before:  # no order is known yet
        return Settled({}, opened)
    touched, scratch = _read(spark, INDEX_ROW, index_base, [own_index] if own_index else []).select(ORDER, BUCKET), []
    if before:
        mine = touched
        gone = _read(spark, INDEX_ROW, index_base, [before]).select(ORDER, BUCKET).join(mine, [BUCKET, ORDER], "left_anti")
        touched, path = materialize_at(mine.unionByName(gone), "touched-orders")
        scratch.append(path)
    older, path = materialize_at(read_index(spark, index_base, others, opened)
                                 .join(touched, [BUCKET, ORDER], "left_semi").select(ORDER, RUN), "older-versions")
    scratch.append(path)
    hit = [r[0] for r in older.select(RUN).distinct().collect()]  # at most one value per run

    # All versions of the touched orders that have several, or lost the run's own.
    own = staged.select(ORDER, F.lit(run_id).alias(RUN), best)
    versions = read_parts(hit).join(older, [ORDER, RUN], "left_semi").unionByName(
        own.join(older.select(ORDER).distinct(), ORDER, "left_semi"))
    compared, path = _compare(versions, best)
    scratch.append(path)
    hidden = (compared.select(ORDER, "_shown", F.explode("_runs").alias(RUN)).where(F.col(RUN) != F.col("_shown"))
              .select(ORDER, RUN))
    hidden, path = materialize_at(hidden, "hidden-versions")
    scratch.append(path)

    # Parts whose hidden orders differ from what their delete files say of the touched orders.
    had = {p: d for p, d in parts.deletes.items() if p in (*hit, run_id)}
    old = read_deletes(spark, deletes_base, had)
    said = old.join(touched.select(ORDER), ORDER, "left_semi")
    changed = said.withColumn("_n", F.lit(-1)).unionByName(hidden.withColumn("_n", F.lit(1)))
    changed = changed.groupBy(ORDER, RUN).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    changed, path = materialize_at(changed, "changed-versions")
    scratch.append(path)
    names = [r[0] for r in changed.select(RUN).distinct().collect()]
    if not names:
        return Settled({}, opened, scratch=scratch)
    kept = old.join(touched.select(ORDER), ORDER, "left_anti").unionByName(hidden).where(F.col(RUN).isin(*names))
    folder = f"{deletes_base}/version={run_id}-{uuid.uuid4().hex[:8]}"
    kept.sortWithinPartitions(RUN, ORDER).write.option("compression", "zstd").partitionBy(RUN).parquet(folder)
    paths = {p: f"{folder}/{RUN}={p}" for p in names}
    written = {p: (path, 1) for p, path in paths.items() if path_exists(spark, path)}
    rows = {r[RUN]: r["count"] for r in read_deletes(spark, deletes_base, written).groupBy(RUN).count().collect()}
    return Settled({p: (path, rows.get(p, 0)) for p, path in paths.items()}, opened, changed, scratch)
