"""Partial aggregates of the published fact, kept per part (Q1-Q4 without reading the fact).

Beside the data, index and delete files of a part (``orderlake.plans.versions``) stands its **partial**: the
measures of its shown rows by region, by payment method and by product and quarter.  All of them are
counts and exact decimal sums, so partials of several parts add up, and rows can be taken out again.

A publish writes the partial of its own part from the rows that it stages.  Of every other part whose
shown rows change, it writes the old partial plus the rows shown again, minus the rows now hidden: only
these rows are read, whatever the size of the part.  The pointers go into the same commit as the
data, so a report never sees one without the other.

A group whose rows have all gone is left out.  A part without a partial (published before there were
any) is aggregated by its readers, and gets one when its run is published again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, LongType, StringType, StructField, StructType

from orderlake.functions.values import MEASURE_DECIMAL

RUN, GRAIN, SIGN = "run_id", "grain", "_sign"
KEYS = {"region": ["region_id"], "payment": ["payment_id"], "product": ["product_id", "year", "quarter"]}
ALL_KEYS = [c for keys in KEYS.values() for c in keys]
FACT_COLUMNS = ["order_id", "date_key", "product_id", "region_id", "payment_id", "total_amount", "profit_margin",
                "is_returned"]
_SUM = DecimalType(38, MEASURE_DECIMAL.scale)
_MEASURES = {"n": LongType(), "orders": LongType(), "amount": _SUM, "amount_n": LongType(), "margin": _SUM,
             "margin_n": LongType(), "returned": LongType(), "returned_n": LongType()}
MEASURES = list(_MEASURES)
PARTIAL = StructType([
    StructField("region_id", LongType()), StructField("payment_id", LongType()), StructField("product_id", StringType()),
    StructField("year", IntegerType()), StructField("quarter", IntegerType()),
    *[StructField(m, t) for m, t in _MEASURES.items()],
    StructField(RUN, StringType()), StructField(GRAIN, StringType())])


def partials_of(table: str) -> str:
    return f"{table}/partials"


def measured(rows: DataFrame) -> DataFrame:
    """Fact rows with ``run_id`` (their part) and ``_sign`` (-1 takes a row out) as partials of one row each, per grain.

    Amounts become decimals once, before a row is repeated for each grain.
    """
    month = F.col("date_key") / 100 % 100
    sign = F.when(F.col(SIGN) < 0, F.lit(-1)).otherwise(F.lit(1)).cast("long")

    def counted(column: str) -> Column:
        return F.when(F.col(column).isNotNull(), sign).otherwise(F.lit(0).cast("long"))

    def summed(column: str, dtype) -> Column:
        value = F.col(column).cast(dtype)
        return F.coalesce(F.when(F.col(SIGN) < 0, -value).otherwise(value), F.lit(0).cast(dtype)).cast(dtype)

    rows = rows.select(
        RUN, "region_id", "payment_id", "product_id", F.floor(F.col("date_key") / 10000).cast("int").alias("year"),
        F.ceil(F.floor(month) / 3).cast("int").alias("quarter"), sign.alias("n"), counted("order_id").alias("orders"),
        summed("total_amount", MEASURE_DECIMAL).alias("amount"), counted("total_amount").alias("amount_n"),
        summed("profit_margin", MEASURE_DECIMAL).alias("margin"), counted("profit_margin").alias("margin_n"),
        summed("is_returned", LongType()).alias("returned"), counted("is_returned").alias("returned_n"))
    types = {f.name: f.dataType for f in PARTIAL.fields}
    grains = F.array(*[F.struct(F.lit(grain).alias(GRAIN), *[(F.col(k) if k in keys else F.lit(None)).cast(types[k]).alias(k)
                                                             for k in ALL_KEYS]) for grain, keys in KEYS.items()])
    return rows.select(RUN, *MEASURES, F.explode(grains).alias("_k")).select(
        *[F.col(f"_k.{c}") for c in ALL_KEYS], *MEASURES, RUN, F.col(f"_k.{GRAIN}"))


def aggregate(rows: DataFrame) -> DataFrame:
    """The partials of fact rows with ``run_id`` (their part) and ``_sign`` (-1 takes a row out), in one pass."""
    return add_up(measured(rows), [RUN, GRAIN, *ALL_KEYS]).select(*PARTIAL.names)


def add_up(partials: DataFrame, keys: list[str]) -> DataFrame:
    """Partials with equal keys as one; groups without rows left out."""
    sums = [F.sum(m).cast(t).alias(m) for m, t in _MEASURES.items()]
    return partials.groupBy(*keys).agg(*sums).where("n <> 0")


def read_partials(spark: SparkSession, base: str, known: list[tuple[str, int]]) -> DataFrame:
    """Some parts' partials, given as (path, rows); an empty one has no files."""
    paths = [path for path, rows in known if rows]
    if not paths:
        return spark.createDataFrame([], PARTIAL)
    return spark.read.schema(PARTIAL).option("basePath", base).parquet(*paths).select(*PARTIAL.names)


def write_partials(spark: SparkSession, base: str, run_id: str, own: DataFrame, moved: DataFrame | None,
                   known: dict[str, tuple[str, int]]) -> dict[str, tuple[str, int]]:
    """The partials that a publish changes: part -> (path, rows).

    ``own`` are the shown rows of the run's part; ``moved`` the rows of other parts that are shown again
    (``_sign`` 1) or hidden now (-1).  ``known`` has the partials of those parts; a part without one gets none.
    """
    changed = measured(own.withColumns({RUN: F.lit(run_id), SIGN: F.lit(1)}))
    parts = [run_id]
    if moved is not None and known:
        parts += known
        changed = (changed.unionByName(measured(moved.where(F.col(RUN).isin(*known))))
                   .unionByName(read_partials(spark, base, list(known.values()))))
    folder = f"{base}/version={run_id}-{uuid.uuid4().hex[:8]}"
    (add_up(changed, [RUN, GRAIN, *ALL_KEYS]).sortWithinPartitions(RUN, GRAIN)
     .write.partitionBy(RUN, GRAIN).parquet(folder))
    written = spark.read.schema(PARTIAL).parquet(folder).groupBy(RUN).count().collect()  # a row per changed part
    rows = {r[RUN]: r["count"] for r in written}
    return {p: (f"{folder}/{RUN}={p}", rows.get(p, 0)) for p in parts}
