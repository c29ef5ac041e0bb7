"""Join helpers (J1-J6): size-checked broadcast and referential checks.

A side is broadcast only when its row count is *known* to be under a bound:
either passed in (gold writes observe counts for free) or checked with a
``limit(n+1).count()`` that reads at most n+1 rows.  Beyond the bound a lookup
takes its hot names apart (``lookup_hot_apart``); any other join stays a shuffle
join, which AQE can still demote at runtime from measured sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.config import BROADCAST_MAX_ROWS, materialize

# A name with more than 1/HOT_SHARE of all rows is hot, so there are fewer than HOT_SHARE of them.
HOT_SHARE = 1000


def rows_at_most(df: DataFrame, n: int) -> bool:
    """True when ``df`` has at most n rows (reads at most n+1)."""
    return df.limit(n + 1).count() <= n


def maybe_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                    known_rows: int | None = None) -> DataFrame:
    """``broadcast(df)`` when its size is proven small, else ``df`` unchanged."""
    small = known_rows <= max_rows if known_rows is not None else rows_at_most(df, max_rows)
    return F.broadcast(df) if small else df


def lookup_key(df: DataFrame, dim: DataFrame, on_left: str, dim_name_col: str, dim_key_col: str,
               known_rows: int | None = None, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Attach ``dim_key_col`` by equality of ``on_left`` with ``dim_name_col``, whose values are unique.

    Left outer: a NULL or unknown name gives a NULL key, the row is kept.
    """
    side = dim.select(dim_name_col, dim_key_col)
    if not (known_rows <= max_rows if known_rows is not None else rows_at_most(side, max_rows)):
        return lookup_hot_apart(df, side, on_left, dim_name_col, dim_key_col)
    return df.join(F.broadcast(side), df[on_left] == side[dim_name_col], "left").drop(side[dim_name_col])


def lookup_hot_apart(df: DataFrame, dim: DataFrame, on_left: str, dim_name_col: str, dim_key_col: str) -> DataFrame:
    """``lookup_key`` with a dimension too large to broadcast.

    The rows are stored and their names counted, combined in the tasks.  Hot names meet the dimension first, and the
    fewer than HOT_SHARE rows that come out are broadcast to their rows, which stay where they are, as do rows
    without a name.  Only the others, none of whose names has over 1/HOT_SHARE of the rows, are shuffled.
    """
    rows = materialize(df, "lookup-rows")
    names = dim.select(F.col(dim_name_col).alias("_name"), F.col(dim_key_col).alias("_key"))
    named = F.col(on_left).isNotNull()
    total = rows.count()  # from the files' footers
    hot = (rows.where(named).groupBy(F.col(on_left).alias("_name")).agg(F.count(F.lit(1)).alias("_n"))
           .where(F.col("_n") * HOT_SHARE > total).select("_name"))
    hot = materialize(hot, "lookup-hot-names")
    known = names.join(F.broadcast(hot), "_name")
    hot = F.broadcast(materialize(hot.join(F.broadcast(known), "_name", "left"), "lookup-hot"))
    same = F.col(on_left) == F.col("_name")
    in_place = rows.join(hot, same, "left").where(F.col("_name").isNotNull() | ~named)
    shuffled = rows.where(named).join(hot.select("_name"), same, "left_anti").join(names, same, "left")
    return in_place.unionByName(shuffled).drop("_name").withColumnRenamed("_key", dim_key_col)


def orphans(fact: DataFrame, fk: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Fact rows whose non-NULL ``fk`` has no row in ``dim``."""
    keys = dim.select(F.col(dim_key).alias("_k")).distinct()
    return fact.where(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_k"), "left_anti")
