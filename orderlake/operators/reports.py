"""The four published reports (Q1-Q4).

The fact is never shuffled to meet a dimension.  Q2 and Q4 aggregate it on
its foreign key first (partial aggregation, then a join of small tables).  Q3
joins its dimensions map-side when their sizes are proven small (broadcast);
otherwise it reduces the fact to (product, year, quarter) partials before the
product join.  Sums are exact (DECIMAL), cast to DOUBLE once; every ORDER BY
ends in a unique column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.config import BROADCAST_MAX_ROWS
from orderlake.functions.values import exact_avg, exact_sum_dec, percent_2dp
from orderlake.operators.joins import maybe_broadcast


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Q1 (A2 + U1): one (tbl, cnt) row per table, UNION ALL."""
    parts = [df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("tbl"), "cnt")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def revenue_by_region(fact: DataFrame, dim_region: DataFrame) -> DataFrame:
    """Q2: per region: orders, revenue, average profit margin; by revenue desc."""
    per_key = fact.where(F.col("region_id").isNotNull()).groupBy("region_id").agg(
        F.count("order_id").alias("n"),
        exact_sum_dec("total_amount").alias("rev"),
        exact_sum_dec("profit_margin").alias("pm_sum"),
        F.count("profit_margin").alias("pm_n"),
    )
    return name_regions(per_key, dim_region)


def name_regions(per_key: DataFrame, dim_region: DataFrame) -> DataFrame:
    """Q2 from sums by region_id: n, rev, pm_sum, pm_n."""
    joined = per_key.join(dim_region, "region_id")
    return (
        joined.groupBy("region_name").agg(
            F.sum("n").alias("total_orders"),
            F.sum("rev").cast("double").alias("total_revenue"),
            exact_avg(F.sum("pm_sum"), F.sum("pm_n")).alias("avg_profit_margin"),
        )
        .orderBy(F.desc("total_revenue"), "region_name")
    )


def revenue_by_category_quarter(fact: DataFrame, dim_product: DataFrame, dim_date: DataFrame,
                                product_rows: int | None = None, date_rows: int | None = None) -> DataFrame:
    """Q3: per category, year, quarter: orders and revenue.

    dim_date is bounded by the number of calendar days and always broadcast.
    dim_product is broadcast when its size is proven small; otherwise the fact
    is first reduced to (product, year, quarter) partials and only those meet
    dim_product in a shuffle join.
    """
    dates = maybe_broadcast(dim_date.select("date_key", "year", "quarter"), known_rows=date_rows)
    dated = fact.join(dates, "date_key")
    products = dim_product.select("product_id", "category")
    small = product_rows is not None and product_rows <= BROADCAST_MAX_ROWS
    if small:
        by_key = dated.join(F.broadcast(products), "product_id")
        partial = by_key.groupBy("category", "year", "quarter").agg(
            F.count("order_id").alias("n"), exact_sum_dec("total_amount").alias("rev"))
    else:
        pre = dated.groupBy("product_id", "year", "quarter").agg(
            F.count("order_id").alias("n"), exact_sum_dec("total_amount").alias("rev"))
        partial = pre.join(products, "product_id")
    return total_categories(partial)


def total_categories(partial: DataFrame) -> DataFrame:
    """Q3 from sums n, rev that carry category, year and quarter."""
    return (
        partial.groupBy("category", "year", "quarter").agg(
            F.sum("n").alias("orders"), F.sum("rev").cast("double").alias("revenue"))
        .orderBy("year", "quarter", F.desc("revenue"), "category")
    )


def return_rate_by_payment(fact: DataFrame, dim_payment: DataFrame) -> DataFrame:
    """Q4: per payment method: orders, returns, return rate % (2 dp); by rate desc."""
    per_key = fact.where(F.col("payment_id").isNotNull()).groupBy("payment_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_returned").alias("r"))
    return name_payments(per_key, dim_payment)


def name_payments(per_key: DataFrame, dim_payment: DataFrame) -> DataFrame:
    """Q4 from sums by payment_id: n, r."""
    joined = per_key.join(dim_payment, "payment_id")
    agg = joined.groupBy("payment_method").agg(
        F.sum("n").alias("total_orders"), F.sum("r").alias("returned_orders"))
    return (
        agg.select("payment_method", "total_orders", "returned_orders",
                   percent_2dp(F.col("returned_orders"), F.col("total_orders")).alias("return_rate_pct"))
        .orderBy(F.desc("return_rate_pct"), "payment_method")
    )
