"""Declared schemas: the bronze sales record and the gold star schema.

The gold registry is the single source for DDL, publish order and the data
quality checks: keys (PRIMARY KEY), NOT NULL columns, foreign keys, value
domains and VARCHAR lengths.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# The bronze sales record, field names and types in order.
SALES_FIELDS = [
    ("order_id", StringType()),
    ("customer_id", StringType()),
    ("product_id", StringType()),
    ("category", StringType()),
    ("price", DoubleType()),
    ("discount", DoubleType()),
    ("quantity", IntegerType()),
    ("payment_method", StringType()),
    ("order_date", StringType()),
    ("delivery_time_days", IntegerType()),
    ("region", StringType()),
    ("returned", StringType()),
    ("total_amount", DoubleType()),
    ("shipping_cost", DoubleType()),
    ("profit_margin", DoubleType()),
    ("customer_age", IntegerType()),
    ("customer_gender", StringType()),
]

SALES = StructType([StructField(n, t, True) for n, t in SALES_FIELDS])
SALES_COLUMNS = [n for n, _ in SALES_FIELDS]
CORRUPT_COL = "_corrupt"
SALES_WITH_CORRUPT = StructType(SALES.fields + [StructField(CORRUPT_COL, StringType(), True)])


@dataclass(frozen=True)
class Column:
    name: str
    dtype: object
    nullable: bool = True
    max_len: int | None = None  # VARCHAR(n)
    domain: tuple | None = None  # inclusive (low, high) or a set of values
    comment: str | None = None


@dataclass(frozen=True)
class GoldTable:
    name: str
    kind: str  # "dimension" | "fact"
    columns: tuple[Column, ...]
    key: tuple[str, ...]
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)  # col -> (table, col)
    comment: str = ""

    @property
    def schema(self) -> StructType:
        return StructType([StructField(c.name, c.dtype, True) for c in self.columns])

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def not_null(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]


_S, _I, _L, _D = StringType(), IntegerType(), LongType(), DoubleType()

# Gold tables as declared by the warehouse DDL.
GOLD_TABLES: dict[str, GoldTable] = {
    t.name: t
    for t in [
        GoldTable(
            "dim_customer", "dimension",
            (Column("customer_id", _S, False, 20), Column("customer_age", _I),
             Column("customer_gender", _S, True, 10)),
            key=("customer_id",), comment="customers",
        ),
        GoldTable(
            "dim_product", "dimension",
            (Column("product_id", _S, False, 20), Column("category", _S, True, 50)),
            key=("product_id",), comment="products and categories",
        ),
        GoldTable(
            "dim_date", "dimension",
            (Column("date_key", _I, False), Column("full_date", DateType(), False),
             Column("year", _I, False), Column("quarter", _I, False, domain=(1, 4)),
             Column("month", _I, False, domain=(1, 12)), Column("month_name", _S, False, 15),
             Column("day", _I, False, domain=(1, 31)), Column("day_name", _S, False, 10),
             Column("week_of_year", _I, False), Column("is_weekend", BooleanType(), False)),
            key=("date_key",), comment="calendar derived from order_date",
        ),
        GoldTable(
            "dim_region", "dimension",
            (Column("region_id", _L, False), Column("region_name", _S, False, 50)),
            key=("region_id",), comment="regions",
        ),
        GoldTable(
            "dim_payment", "dimension",
            (Column("payment_id", _L, False), Column("payment_method", _S, False, 50)),
            key=("payment_id",), comment="payment methods",
        ),
        GoldTable(
            "fact_sales", "fact",
            (Column("order_id", _S, False, 20), Column("customer_id", _S, False, 20),
             Column("product_id", _S, False, 20), Column("date_key", _I, False),
             Column("region_id", _L), Column("payment_id", _L), Column("quantity", _I),
             Column("price", _D), Column("discount", _D, domain=(0.0, 1.0)),
             Column("total_amount", _D), Column("shipping_cost", _D), Column("profit_margin", _D),
             Column("delivery_time_days", _I), Column("is_returned", _I, domain=(0, 1))),
            key=("order_id",),
            foreign_keys={
                "customer_id": ("dim_customer", "customer_id"),
                "product_id": ("dim_product", "product_id"),
                "date_key": ("dim_date", "date_key"),
                "region_id": ("dim_region", "region_id"),
                "payment_id": ("dim_payment", "payment_id"),
            },
            comment="one row per order",
        ),
    ]
}

DIMENSIONS = [n for n, t in GOLD_TABLES.items() if t.kind == "dimension"]
FACTS = [n for n, t in GOLD_TABLES.items() if t.kind == "fact"]
