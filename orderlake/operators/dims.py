"""Dimension builders (M1-M5) over validated bronze rows.

Attribute dimensions keep, per key, the attributes of the latest order
(greatest order_date, then order_id, then the remaining columns), instead of an
arbitrary survivor.  NULL keys never form a dimension row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions.dates import calendar_columns, parse_order_date
from orderlake.operators.dedupe import BEST, distinct_values, latest_per_key, latest_state, merge_states
from orderlake.operators.keys import dense_rank_distinct

# Attribute dimensions: key -> attributes, in output order.
ATTRIBUTE_DIMS = {
    "dim_customer": ("customer_id", ["customer_age", "customer_gender"]),
    "dim_product": ("product_id", ["category"]),
}


def recency() -> list:
    """Ordering for "latest": parsed order_date, then order_id (then all other columns)."""
    return [("_d", parse_order_date("order_date")), "order_id"]


def _rows(bronze: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    cols = [key, "order_date", "order_id"] + [a for a in attrs if a not in (key, "order_date", "order_id")]
    return bronze.select(*cols).where(F.col(key).isNotNull())


def _latest(bronze: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    return latest_per_key(_rows(bronze, key, attrs), [key], recency()).select(key, *attrs)


def _typed(name: str, df: DataFrame) -> DataFrame:
    if name == "dim_customer":
        return df.withColumn("customer_age", F.col("customer_age").cast("int"))
    return df


def attribute_dim_with_state(name: str, bronze: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """M1/M2 incrementally: the dimension plus its hidden ``_best`` state column.

    ``previous`` is the published snapshot (with ``_best``); ``bronze`` holds
    only rows it has not seen.  Merging the two states equals a rebuild from all
    rows, but reads only the new rows and the dimension itself.
    """
    key, attrs = ATTRIBUTE_DIMS[name]
    state = latest_state(_rows(bronze, key, attrs), [key], recency())
    if previous is not None and BEST in previous.columns:
        state = merge_states([previous.select(key, BEST), state], [key])
    out = state.select(F.col(key), *[F.col(f"{BEST}.{a}").alias(a) for a in attrs], F.col(BEST))
    return _typed(name, out)


def dim_date_incremental(bronze: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """M3 incrementally: previously observed dates plus the new rows' dates."""
    new = build_dim_date(bronze, sort=False)
    if previous is None:
        return new
    return previous.select(*new.columns).unionByName(new).distinct()


def build_dim_customer(bronze: DataFrame) -> DataFrame:
    """M1: customer_id, customer_age (int), customer_gender."""
    return _latest(bronze, "customer_id", ["customer_age", "customer_gender"]).select(
        "customer_id", F.col("customer_age").cast("int").alias("customer_age"), "customer_gender")


def build_dim_product(bronze: DataFrame) -> DataFrame:
    """M2: product_id, category."""
    return _latest(bronze, "product_id", ["category"])


def build_dim_date(bronze: DataFrame, sort: bool = True) -> DataFrame:
    """M3: one row per observed valid order date (not a gap-free calendar)."""
    dates = distinct_values(bronze.select(parse_order_date("order_date").alias("d")), ["d"])
    out = dates.select(*calendar_columns(F.col("d")))
    return out.orderBy("date_key") if sort else out


def build_dim_region(bronze: DataFrame) -> DataFrame:
    """M4: region_id (dense, in name order), region_name."""
    names = bronze.select(F.col("region").alias("region_name"))
    return dense_rank_distinct(names, "region_name", "region_id").select("region_id", "region_name")


def build_dim_payment(bronze: DataFrame) -> DataFrame:
    """M5: payment_id (dense, in name order), payment_method."""
    return dense_rank_distinct(bronze.select("payment_method"), "payment_method", "payment_id").select(
        "payment_id", "payment_method")
