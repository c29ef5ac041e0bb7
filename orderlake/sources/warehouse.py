"""Warehouse connector read / write.

The engine never hard-codes a warehouse: ``Connector`` carries a Spark data
source format and caller-supplied options (credentials come from the caller's
secret store, never from this code).  With no format the session catalog is
the warehouse: queries run as Spark SQL and writes become catalog tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Connector:
    format: str | None = None               # e.g. "jdbc" or a warehouse's Spark connector
    options: dict[str, str] = field(default_factory=dict)


def read_query(spark: SparkSession, conn: Connector, query: str) -> DataFrame:
    """Run ``query`` where the data lives (pushed down whole) and read the result."""
    if conn.format is None:
        return spark.sql(query)
    return spark.read.format(conn.format).options(**conn.options).option("query", query).load()


def write_table(df: DataFrame, conn: Connector, table: str, mode: str = "overwrite") -> None:
    """Write ``df`` to ``table`` (a staging table for the swap, or an append target)."""
    if conn.format is None:
        df.write.mode(mode).saveAsTable(table)
        return
    df.write.format(conn.format).options(**conn.options).option("dbtable", table).mode(mode).save()
