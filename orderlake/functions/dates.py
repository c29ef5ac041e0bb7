"""Order-date functions.

``order_date`` arrives as text.  Under ANSI mode ``to_date`` raises on bad text,
so parsing uses ``try_to_date``: an unparsable or impossible date is NULL and the
row is quarantined by the gold build instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ORDER_DATE_FORMAT = "yyyy-MM-dd"


def parse_order_date(c: Column | str) -> Column:
    """``yyyy-MM-dd`` text -> DATE, NULL when malformed (never raises)."""
    return F.try_to_date(F.col(c) if isinstance(c, str) else c, ORDER_DATE_FORMAT)


def date_key(d: Column) -> Column:
    """F2/K3: DATE -> YYYYMMDD integer (arithmetic, no string round trip)."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_columns(d: Column) -> list[Column]:
    """The ten dim_date columns for a DATE column."""
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        # Sunday=1 .. Saturday=7; a NULL date is not a weekend.
        F.coalesce(F.dayofweek(d).isin(1, 7), F.lit(False)).alias("is_weekend"),
    ]
