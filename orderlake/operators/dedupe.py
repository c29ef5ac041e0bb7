"""Keep one row per key (A11, A12), deterministically and skew-safely.

``dropDuplicates`` keeps an arbitrary survivor.  Here the survivor is the row
with the largest ordering tuple, computed as ``max(struct(order..., rest...))``
per key.  Every column is part of the tuple, so the choice is a total order and
does not depend on input order, partitioning or retries.  Because it is an
aggregate, Spark combines map-side before the shuffle: a key holding a third of
all rows sends one row per map task, not a third of the table to one reducer
(a window ``row_number`` would).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.config import BROADCAST_MAX_ROWS, drop_path, materialize_at

OrderSpec = list  # of column names or (name, Column) pairs


def _named(spec) -> tuple[str, Column]:
    if isinstance(spec, str):
        return spec, F.col(spec)
    return spec


BEST = "_best"


def ordering_tuple(df: DataFrame, keys: list[str], order: OrderSpec | None = None):
    """The per-row tuple (order..., other columns...) that "latest" maximises."""
    order = [_named(o) for o in (order or [])]
    derived = [(f"_ord{i}", c) for i, (_, c) in enumerate(order)]
    rest = [c for c in df.columns if c not in keys]
    return F.struct(*[c.alias(n) for n, c in derived], *[F.col(c) for c in rest]), rest


def latest_state(df: DataFrame, keys: list[str], order: OrderSpec | None = None) -> DataFrame:
    """(keys..., ``_best``): the winning tuple per key.

    ``max`` is associative, so states merge: the state of old rows merged with
    the state of new rows equals the state of all rows (``merge_states``).
    """
    tup, _ = ordering_tuple(df, keys, order)
    return df.groupBy(*keys).agg(F.max(tup).alias(BEST))


def latest_state_of_repeated(df: DataFrame, keys: list[str], order: OrderSpec | None = None,
                             max_marks: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``latest_state`` of a stored ``df``, in which only rows whose key may be there twice are shuffled.

    The keys' 64-bit marks are counted first, combined in the tasks.  A row whose mark is there once is its key's
    only one; the others are aggregated by their whole keys.  With more than ``max_marks`` repeated marks all rows are.
    """
    mark = F.xxhash64(*keys)
    repeated, path = materialize_at(
        df.groupBy(mark.alias("_mark")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_mark"), "repeated-marks")
    n = repeated.count()
    if not n or n > max_marks:
        drop_path(df.sparkSession, path)
        return latest_state(df, keys, order) if n else df.select(*keys, ordering_tuple(df, keys, order)[0].alias(BEST))
    marked, side = df.withColumn("_mark", mark), F.broadcast(repeated)
    alone = marked.join(side, "_mark", "left_anti").drop("_mark")
    several = latest_state(marked.join(side, "_mark", "left_semi").drop("_mark"), keys, order)
    return alone.select(*keys, ordering_tuple(alone, keys, order)[0].alias(BEST)).unionByName(several)


def merge_states(states: list[DataFrame], keys: list[str]) -> DataFrame:
    """Combine states of disjoint row sets into the state of their union."""
    from functools import reduce

    both = reduce(DataFrame.unionByName, [s.select(*keys, BEST) for s in states])
    return both.groupBy(*keys).agg(F.max(BEST).alias(BEST))


def unpack_state(state: DataFrame, keys: list[str], columns: list[str], keep_state: bool = False) -> DataFrame:
    """State -> rows with ``columns`` (keys taken from the key columns), and the state itself if asked."""
    rows = [F.col(c) if c in keys else F.col(f"{BEST}.{c}").alias(c) for c in columns]
    return state.select(*rows, *([BEST] if keep_state else []))


def latest_per_key(df: DataFrame, keys: list[str], order: OrderSpec | None = None) -> DataFrame:
    """One row per ``keys``: the one with the greatest (order..., other columns...).

    NULLs order lowest.  Output columns and order are those of ``df``.
    """
    return unpack_state(latest_state(df, keys, order), keys, df.columns)


def distinct_values(df: DataFrame, cols: list[str], drop_nulls: bool = True) -> DataFrame:
    """Distinct (cols) tuples; partial aggregation before the shuffle."""
    out = df.select(*cols)
    if drop_nulls:
        out = out.dropna(how="any", subset=cols)
    return out.distinct()
