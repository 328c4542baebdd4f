"""Column expressions: everything here is built-in Spark SQL, evaluated in the JVM."""

from .numbers import is_number_text, normalize_percent, percent_text, safe_ratio, text_to_double, zero_fill
from .status import classify_response, decide
from .text import json_columns, json_string, mime_type, tag_string
from .time import epoch_micros, now_utc, order_key, parse_iso_utc, stamped_key, time_stamp, utc_ntz

__all__ = [
    "classify_response",
    "decide",
    "epoch_micros",
    "is_number_text",
    "json_columns",
    "json_string",
    "mime_type",
    "normalize_percent",
    "now_utc",
    "order_key",
    "parse_iso_utc",
    "percent_text",
    "safe_ratio",
    "stamped_key",
    "tag_string",
    "text_to_double",
    "time_stamp",
    "utc_ntz",
    "zero_fill",
]
