"""Scalar Column helpers: strings, dates and numbers."""

from clickpath.functions.dates import (
    after,
    before,
    date_hour,
    date_hour_text,
    format_date,
    format_date_key,
    format_time,
    format_time_minute,
    hour_text,
    minus,
    parse_date_key,
    parse_time,
    seconds_between,
    today,
    truncate_to_second,
    yesterday,
)
from clickpath.functions.numbers import format_double, int_div, ratio
from clickpath.functions.strings import (
    id_list,
    is_empty,
    is_not_empty,
    kv_get,
    kv_set,
    pad_two,
    trim_comma,
)

__all__ = [
    "after",
    "before",
    "date_hour",
    "date_hour_text",
    "format_date",
    "format_date_key",
    "format_double",
    "format_time",
    "format_time_minute",
    "hour_text",
    "id_list",
    "int_div",
    "is_empty",
    "is_not_empty",
    "kv_get",
    "kv_set",
    "minus",
    "pad_two",
    "parse_date_key",
    "parse_time",
    "ratio",
    "seconds_between",
    "today",
    "trim_comma",
    "truncate_to_second",
    "yesterday",
]
