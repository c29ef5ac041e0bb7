"""User-level schema declaration (D1-D7) from the gold registry.

Types, NOT NULL, VARCHAR lengths and comments come from ``orderlake.schemas``.
PRIMARY KEY / FOREIGN KEY / value domains are not enforced by Parquet tables;
they are enforced by the quality checks (``orderlake.operators.quality``),
which read the same registry.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from orderlake.schemas import GOLD_TABLES, GoldTable


def _type_sql(c) -> str:
    if c.max_len is not None:
        return f"VARCHAR({c.max_len})"
    return c.dtype.simpleString().upper()


def create_table_sql(t: GoldTable, database: str, location: str) -> str:
    cols = ",\n  ".join(f"{c.name} {_type_sql(c)}{'' if c.nullable else ' NOT NULL'}" for c in t.columns)
    # The fact has one partition per run that brought rows; publishing points it to its current files.
    run, parted = (",\n  run_id STRING", "PARTITIONED BY (run_id)\n") if t.kind == "fact" else ("", "")
    return (f"CREATE TABLE IF NOT EXISTS {database}.{t.name} (\n  {cols}{run}\n) USING parquet\n"
            f"{parted}LOCATION '{location}'")


def ddl_statements(database: str, root: str) -> list[str]:
    """Database, six tables, comments — in execution order."""
    stmts = [f"CREATE DATABASE IF NOT EXISTS {database}"]
    for t in GOLD_TABLES.values():
        stmts.append(create_table_sql(t, database, f"{root}/declared/{t.name}"))
        stmts.append(f"COMMENT ON TABLE {database}.{t.name} IS '{t.comment}'")
    return stmts


def declare_gold(spark: SparkSession, database: str, root: str) -> None:
    """Run the DDL, then make ``database`` current (USE)."""
    for s in ddl_statements(database, root):
        spark.sql(s)
    spark.catalog.setCurrentDatabase(database)
