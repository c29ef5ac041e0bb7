"""Dense, stable surrogate keys (K1).

``monotonically_increasing_id`` depends on the physical plan and can overflow
INT, and a global ``row_number()`` window runs in one task.  Instead keys are
numbered the way ``zipWithIndex`` does it, in DataFrame form:

1. range-partition and sort the distinct new keys (distributed sort);
2. tag each row with its partition and position (``monotonically_increasing_id``
   packs both) and write it to the shared folder, so later reads see one fixed
   numbering (one pass; a re-run after executor loss reads the files);
3. count rows per partition (one row per partition), turn the counts into
   running offsets and broadcast them (their size is the partition count);
4. id = base + offset(partition) + position, written once more (small), so the
   result's row count is known from file metadata.

The result equals ``row_number() over (order by key) - 1 + base`` but no step
holds more than one partition.  When the materialised set of new keys is
proven small (at most ``SINGLE_TASK_KEYS`` rows, e.g. regions or payment
methods), that window itself is used: one task over a bounded set.  A persisted key map makes ids stable across
runs: only keys not yet in the map are numbered, after the map's current max.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake.config import drop_path, materialize, materialize_at, path_exists
from orderlake.operators.dedupe import distinct_values

_POS_BITS = 33  # monotonically_increasing_id: partition id << 33 | row position


# Up to this many new keys are numbered by one task (proven by the count of
# the materialised distinct set); beyond it the distributed path runs.
SINGLE_TASK_KEYS = 100_000


def dense_rank_distinct(keys: DataFrame, key_col: str, id_col: str, base: int = 0,
                        single_task_limit: int = SINGLE_TASK_KEYS) -> DataFrame:
    """Number distinct non-NULL ``key_col`` values ``base, base+1, ...`` in key order."""
    distinct, distinct_path = materialize_at(distinct_values(keys, [key_col]), "keys-distinct")
    n = distinct.count()  # from the files just written
    if n <= single_task_limit:
        # A proven-small set: one ordered window over at most SINGLE_TASK_KEYS rows.
        numbered = distinct.select(
            key_col, (F.lit(base) - 1 + F.row_number().over(Window.orderBy(key_col))).cast("long").alias(id_col))
        result = materialize(numbered, "keys-numbered")
        drop_path(keys.sparkSession, distinct_path)
        return result
    result = _zip_with_index(distinct, key_col, id_col, base)
    drop_path(keys.sparkSession, distinct_path)
    return result


def _zip_with_index(distinct: DataFrame, key_col: str, id_col: str, base: int) -> DataFrame:
    ordered, sorted_path = materialize_at(
        distinct.orderBy(key_col).withColumn("_mid", F.monotonically_increasing_id()), "keys-sorted")
    part = F.shiftright(F.col("_mid"), _POS_BITS)
    pos = F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    tagged = ordered.select(key_col, part.alias("_part"), pos.alias("_pos"))
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition of `ordered`: a bounded, tiny table.
    running = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_off"))
    numbered = tagged.join(F.broadcast(offsets), "_part").select(
        key_col, (F.lit(base) + F.col("_off") + F.col("_pos")).cast("long").alias(id_col))
    result = materialize(numbered, "keys-numbered")
    drop_path(ordered.sparkSession, sorted_path)  # the sorted keys are no longer read
    return result


def extend_key_map(key_map: DataFrame | None, keys: DataFrame, key_col: str, id_col: str) -> DataFrame:
    """New (key, id) pairs for keys absent from ``key_map``, numbered after its max id."""
    new_keys = distinct_values(keys, [key_col])
    base = 0
    if key_map is not None:
        new_keys = new_keys.join(key_map.select(key_col), key_col, "left_anti")
        top = key_map.agg(F.max(id_col)).first()[0]
        base = 0 if top is None else int(top) + 1
    return dense_rank_distinct(new_keys, key_col, id_col, base)


def _exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path)


def read_key_map(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if _exists(spark, path) else None


def update_key_map(spark: SparkSession, path: str, keys: DataFrame, key_col: str, id_col: str) -> DataFrame:
    """Persisted map: append ids for unseen keys, return the whole map.

    Rerunning with the same keys appends nothing, so the map and every id in it
    are unchanged (idempotent); earlier ids never move.
    """
    current = read_key_map(spark, path)
    added = extend_key_map(current, keys, key_col, id_col)
    added.write.mode("append").parquet(path)
    return spark.read.parquet(path)
