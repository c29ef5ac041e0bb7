"""Scalar column functions (F1-F20), all built from pyspark.sql.functions."""

from orderlake.functions.codec import decode_events, encode_events
from orderlake.functions.dates import calendar_columns, date_key, parse_order_date
from orderlake.functions.names import qualified_name, upper_ident
from orderlake.functions.values import (
    exact_avg,
    exact_sum_dec,
    nan_to_null,
    percent_2dp,
    returned_flag,
)

__all__ = [
    "calendar_columns", "date_key", "decode_events", "encode_events", "exact_avg",
    "exact_sum_dec", "nan_to_null", "parse_order_date", "percent_2dp",
    "qualified_name", "returned_flag", "upper_ident",
]
