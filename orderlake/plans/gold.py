"""The gold star schema (M7): validate bronze, build five dimensions and the fact.

``star_schema`` builds each table on first access.  The key-numbered
dimensions are written to the shared folder by their numbering, so their row
counts come from file metadata and prove the fact's broadcast lookups small.
``orderlake.plans.publish.load_all`` (or ``write_table``) writes them, one job
per table with the row count observed by the write.  The daily, incremental
variant is ``orderlake.plans.daily_run.incremental_gold``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.config import scratch_path
from orderlake.functions.dates import parse_order_date
from orderlake.operators import dims
from orderlake.operators.fact import build_fact_sales
from orderlake.operators.keys import update_key_map
from orderlake.schemas import GOLD_TABLES, SALES_COLUMNS


# Bronze name of a gold column that is declared with a length or a domain, where it differs.
BRONZE_NAMES = {"region_name": "region"}


def declared_rules() -> list[tuple[Column, str]]:
    """(condition, reason) of bronze rows that break a declared length or domain."""
    rules = {}
    for table in GOLD_TABLES.values():
        for c in table.columns:
            name = BRONZE_NAMES.get(c.name, c.name)
            if name not in SALES_COLUMNS:
                continue
            if c.max_len is not None:
                rules[f"{name} longer than {c.max_len}"] = F.length(name) > c.max_len
            if c.domain is not None:
                low, high = c.domain
                rules[f"{name} outside {low} to {high}"] = (F.col(name) < low) | (F.col(name) > high)
    return [(condition, reason) for reason, condition in rules.items()]


VALID = "_valid"


def _tagged(bronze: DataFrame) -> DataFrame:
    """Bronze with ``_valid`` and the reason of the rows that aren't fit for gold."""
    reason = (
        F.when(F.col("order_id").isNull(), "null order_id")
        .when(F.col("customer_id").isNull(), "null customer_id")
        .when(F.col("product_id").isNull(), "null product_id")
        .when(parse_order_date("order_date").isNull(), "bad order_date")
    )
    for condition, text in declared_rules():
        reason = reason.when(condition, text)
    return bronze.withColumn("reject_reason", reason).withColumn(VALID, F.col("reject_reason").isNull())


def split_valid(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows fit for gold, and the rest with a reason: NOT NULL keys, parsable date, declared lengths and domains."""
    tagged = _tagged(bronze)
    return tagged.where(VALID).drop(VALID, "reject_reason"), tagged.where(~F.col(VALID)).drop(VALID)


def stored_valid(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``split_valid`` in one pass over bronze, whose two results are stored apart.

    The rules read every declared column once; after that each table reads its own columns only.
    """
    tagged = _tagged(bronze)
    path = scratch_path(bronze.sparkSession, "valid")
    tagged.write.option("compression", "zstd").partitionBy(VALID).parquet(path)
    rows = bronze.sparkSession.read.schema(tagged.schema).parquet(path)
    return rows.where(VALID).drop(VALID, "reject_reason"), rows.where(~F.col(VALID)).drop(VALID)


class StarSchema:
    """Gold frames built on first access (a query needing one dimension builds only it)."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]], rejected: DataFrame):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}
        self.rejected = rejected
        self.known_rows: dict[str, int] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    @property
    def tables(self) -> dict[str, DataFrame]:
        return {n: self[n] for n in self._builders}

    def materialized(self, name: str) -> DataFrame:
        """The table written once to the shared folder; its row count becomes known
        (observed by the write), which is what proves a broadcast small."""
        if name not in self.known_rows:
            from orderlake.plans.publish import write_table

            df = self[name]
            path = scratch_path(df.sparkSession, name)
            self.known_rows[name] = write_table(df, path)
            self._built[name] = df.sparkSession.read.parquet(path)
        return self._built[name]


def star_schema(bronze: DataFrame, validate: bool = True, sort_dates: bool = False,
                key_maps: dict[str, str] | None = None, fact_input: DataFrame | None = None,
                dedupe: bool = True, store: bool = True) -> StarSchema:
    """Lazy gold frames from bronze rows (SALES schema).

    ``store`` validates bronze in one pass that stores its rows (``stored_valid``); without it, each
    table tests the rules on its own scan, which pays for a single table only.

    ``key_maps`` (dim name -> path) makes region/payment ids stable across runs
    through persisted key maps; ``fact_input`` restricts the fact to some bronze
    rows (an incremental run's new batches) while dimensions see all of bronze.
    """
    if validate:
        good, bad = (stored_valid if store else split_valid)(bronze)
    else:
        good, bad = bronze, bronze.where(F.lit(False)).withColumn("reject_reason", F.lit(None).cast("string"))
    spark = bronze.sparkSession

    def region() -> DataFrame:
        if key_maps:
            return update_key_map(spark, key_maps["dim_region"], good.select(F.col("region").alias("region_name")),
                                  "region_name", "region_id").select("region_id", "region_name")
        return dims.build_dim_region(good)

    def payment() -> DataFrame:
        if key_maps:
            return update_key_map(spark, key_maps["dim_payment"], good.select("payment_method"),
                                  "payment_method", "payment_id").select("payment_id", "payment_method")
        return dims.build_dim_payment(good)

    fact_rows = good if fact_input is None else (split_valid(fact_input)[0] if validate else fact_input)
    star: StarSchema

    def fact() -> DataFrame:
        # The key dimensions are materialised by their numbering: their row
        # counts come from file metadata and prove the broadcast is small.
        r, p = star["dim_region"], star["dim_payment"]
        star.known_rows.update(dim_region=r.count(), dim_payment=p.count())
        return build_fact_sales(fact_rows, r, p, star.known_rows["dim_region"],
                                star.known_rows["dim_payment"], dedupe=dedupe)

    star = StarSchema({
        "dim_customer": lambda: dims.build_dim_customer(good),
        "dim_product": lambda: dims.build_dim_product(good),
        "dim_date": lambda: dims.build_dim_date(good, sort=sort_dates),
        "dim_region": region,
        "dim_payment": payment,
        "fact_sales": fact,
    }, bad)
    return star
