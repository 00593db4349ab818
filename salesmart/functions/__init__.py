"""Column expressions. All are built from Spark's own functions; there are no UDFs."""

from salesmart.functions.dates import (
    calendar_columns,
    cast_date_iso,
    fill_snapshot_date,
    parse_date_br,
    parse_snapshot_date,
)
from salesmart.functions.keys import surrogate_key
from salesmart.functions.numbers import blank_to_zero, parse_number_br, parse_number_us
from salesmart.functions.text import (
    NOT_INFORMED,
    NOT_INFORMED_TITLE,
    clean_string,
    null_to_token,
    whitespace_to_token,
)

__all__ = [
    "NOT_INFORMED",
    "NOT_INFORMED_TITLE",
    "blank_to_zero",
    "calendar_columns",
    "cast_date_iso",
    "clean_string",
    "fill_snapshot_date",
    "null_to_token",
    "parse_date_br",
    "parse_number_br",
    "parse_number_us",
    "parse_snapshot_date",
    "surrogate_key",
    "whitespace_to_token",
]
