"""fact_sales (M6, P9, J1, J2, K3, F12-F14): one row per order.

Plan: one shuffle (the order_id dedupe, combined map-side), then two broadcast
lookups against dimensions whose row counts are proven small.  To be published, only
orders that may be there twice are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions.dates import date_key, parse_order_date
from orderlake.functions.values import returned_flag
from orderlake.operators.dedupe import BEST, latest_per_key, latest_state, latest_state_of_repeated, unpack_state
from orderlake.operators.dims import recency
from orderlake.operators.joins import lookup_key
from orderlake.schemas import GOLD_TABLES

def one_row_per_order(bronze: DataFrame) -> DataFrame:
    """A12 on order_id: the latest version of each order."""
    return latest_per_key(bronze.where(F.col("order_id").isNotNull()), ["order_id"], recency())


# How each declared column comes from the order (columns not named here are taken as they are).
DERIVED = {
    "date_key": lambda: date_key(parse_order_date("order_date")),
    "is_returned": lambda: returned_flag("returned"),
}


def build_fact_sales(bronze: DataFrame, dim_region: DataFrame, dim_payment: DataFrame,
                     region_rows: int | None = None, payment_rows: int | None = None,
                     dedupe: bool = True, keep_state: bool = False) -> DataFrame:
    """The declared columns; with ``keep_state`` also the tuple ``_best`` that made each row the latest (bronze is stored then)."""
    orders = bronze
    if dedupe:
        latest = latest_state_of_repeated if keep_state else latest_state
        state = latest(bronze.where(F.col("order_id").isNotNull()), ["order_id"], recency())
        orders = unpack_state(state, ["order_id"], bronze.columns, keep_state)
    with_region = lookup_key(orders, dim_region, "region", "region_name", "region_id", region_rows)
    full = lookup_key(with_region, dim_payment, "payment_method", "payment_method", "payment_id", payment_rows)
    columns = [(DERIVED[c.name]() if c.name in DERIVED else F.col(c.name)).cast(c.dtype).alias(c.name)
               for c in GOLD_TABLES["fact_sales"].columns]
    return full.select(*columns, *([BEST] if keep_state else []))
