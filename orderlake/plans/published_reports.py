"""The four reports over the published tables, from what the publishes stored (Q1-Q4).

Q1 is answered by the manifest alone.  Q2 to Q4 add up the partials of the fact's parts
(``orderlake.plans.partials``) and join the small sums to a dimension: the fact's files are opened only for
parts that have no partial.  The results are those of ``orderlake.operators.reports`` over the
opened tables, given that the fact's dates are days of ``dim_date`` (the gate's foreign-key check).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.operators import reports
from orderlake.plans import partials
from orderlake.plans.publish import (
    Warehouse, _current, manifest_entries, open_table, read_fact_parts,
)
from orderlake.plans.versions import Parts
from orderlake.schemas import DIMENSIONS

FACT = "fact_sales"


def sums(spark: SparkSession, wh: Warehouse, grain: str, entries: list[tuple] | None = None) -> DataFrame:
    """The published fact's measures by the keys of a grain; a null sum where no row has the measure."""
    entries = manifest_entries(spark, wh) if entries is None else entries
    parts = Parts.of(entries, FACT)
    with_one = [p for p in parts.shown if p in parts.partials]
    found = partials.read_partials(spark, wh.table_dir(partials.partials_of(FACT)), [parts.partials[p] for p in with_one])
    without = [p for p in parts.shown if p not in parts.partials]
    if without:
        rows = read_fact_parts(spark, wh, parts, without, FACT).withColumn(partials.SIGN, F.lit(1))
        found = found.unionByName(partials.aggregate(rows))
    keys = partials.KEYS[grain]
    known = [F.col(k).isNotNull() for k in keys]
    total = found.where(F.col(partials.GRAIN) == grain)
    for k in known:
        total = total.where(k)
    total = partials.add_up(total, keys)
    return total.withColumns({m: F.when(F.col(f"{m}_n") > 0, F.col(m)) for m in ("amount", "margin", "returned")})


def table_counts(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """Q1 from the manifest: rows written per dimension, rows shown per part of the fact."""
    entries = manifest_entries(spark, wh)
    current, parts = _current(entries), Parts.of(entries, FACT)
    counts = [(n, current[n][2]) for n in DIMENSIONS if n in current]
    if any(e[0] == FACT for e in entries):
        counts.append((FACT, sum(parts.live(p) for p in parts.shown)))
    return spark.createDataFrame(counts, "tbl string, cnt bigint")


def revenue_by_region(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """Q2."""
    entries = manifest_entries(spark, wh)
    per_key = sums(spark, wh, "region", entries).select(
        "region_id", F.col("orders").alias("n"), F.col("amount").alias("rev"), F.col("margin").alias("pm_sum"),
        F.col("margin_n").alias("pm_n"))
    return reports.name_regions(per_key, open_table(spark, wh, "dim_region", entries))


def revenue_by_category_quarter(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """Q3."""
    entries = manifest_entries(spark, wh)
    per_key = sums(spark, wh, "product", entries).select(
        *partials.KEYS["product"], F.col("orders").alias("n"), F.col("amount").alias("rev"))
    products = open_table(spark, wh, "dim_product", entries).select("product_id", "category")
    return reports.total_categories(per_key.join(products, "product_id"))


def return_rate_by_payment(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """Q4."""
    entries = manifest_entries(spark, wh)
    per_key = sums(spark, wh, "payment", entries).select("payment_id", "n", F.col("returned").alias("r"))
    return reports.name_payments(per_key, open_table(spark, wh, "dim_payment", entries))


REPORTS: dict[str, Callable[[SparkSession, Warehouse], DataFrame]] = {
    "table_counts": table_counts,
    "revenue_by_region": revenue_by_region,
    "revenue_by_category_quarter": revenue_by_category_quarter,
    "return_rate_by_payment": return_rate_by_payment,
}
