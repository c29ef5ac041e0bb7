"""Value functions: flags, NaN normalisation and exact aggregates.

Sums of double measures go through DECIMAL(28,10), ten decimals of each measure: the
sum is exact and does not depend on row order, partition count or AQE, and it is cast
back to DOUBLE once at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MEASURE_DECIMAL = DecimalType(28, 10)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def returned_flag(c: Column | str) -> Column:
    """'Yes' -> 1, anything else (including NULL and 'yes') -> 0."""
    return F.when(_c(c) == "Yes", 1).otherwise(0).cast("int")


def nan_to_null(c: Column | str) -> Column:
    """F16: NaN -> NULL for a double column."""
    col = _c(c)
    return F.when(F.isnan(col), F.lit(None)).otherwise(col)


def exact_sum_dec(c: Column | str) -> Column:
    """Exact DECIMAL sum of a double measure (re-aggregable)."""
    return F.sum(_c(c).cast(MEASURE_DECIMAL))


def exact_avg(sum_dec: Column, n: Column) -> Column:
    """Exact sum / non-null count, as DOUBLE."""
    return sum_dec.cast("double") / n


def percent_2dp(part: Column, whole: Column) -> Column:
    """part*100/whole rounded half-up to 2 decimals, as DOUBLE.

    Hundredths of a percent in whole numbers, so a tie rounds up exactly.
    """
    part, whole = part.cast("bigint"), whole.cast("bigint")
    return F.call_function("div", part * 20_000 + whole, whole * 2) / F.lit(100.0)
