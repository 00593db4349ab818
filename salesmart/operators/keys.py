"""Calendar columns and surrogate keys of the stage.

The names of the key columns, and which columns each key is made of, are the output
contract. `sep` goes between the parts; it is empty by default, as existing keys have it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions import calendar_columns, surrogate_key
from salesmart.functions.keys import concat_key

CALENDAR = ["_year", "_month", "_quarter", "_weekofyear"]


def key_of(*names: str, sep: str = "", hashed: bool = True) -> Column:
    """The key made of some columns; the text that would be hashed where it is not `hashed` yet."""
    make = surrogate_key if hashed else concat_key
    return make(*[F.col(name) for name in names], sep=sep)


def with_calendar(df: DataFrame, date: str = "invoice_date") -> DataFrame:
    return df.withColumns(calendar_columns(F.col(date)))


def narrow_keys(sep: str = "", hashed: bool = True) -> dict[str, Column]:
    return {
        "DW_VENDAS": key_of("customerkey", "invoice_date", "sales_price", sep=sep, hashed=hashed),
        "DW_CLIENTES": key_of("customerkey", "customer", sep=sep, hashed=hashed),
        "DW_TEMPO": key_of("invoice_date", sep=sep, hashed=hashed),
        "DW_LOCALIDADE": key_of("customerkey", "address_number", sep=sep, hashed=hashed),
    }


def wide_keys(sep: str = "") -> dict[str, Column]:
    return {
        "DW_CLIENTES": key_of("customerkey", "customer", sep=sep),
        "DW_TEMPO": key_of("invoice_date", *CALENDAR, sep=sep),
        "DW_VENDAS": key_of(
            "customerkey", "invoice_number", "datekey", "line_number", sep=sep
        ),
        "DW_LOCALIDADE": key_of("customerkey", "address_number", sep=sep),
    }


def with_narrow_keys(df: DataFrame, sep: str = "") -> DataFrame:
    """Keys of the narrow stage: dates typed, text not cleaned yet."""
    return df.withColumns(narrow_keys(sep))


def with_wide_keys(df: DataFrame, sep: str = "") -> DataFrame:
    """Keys of the wide stage: all columns cleaned, calendar columns present."""
    return df.withColumns(wide_keys(sep))
