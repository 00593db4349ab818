"""The two stages with keys, worked out on the side of the join where it is cheapest.

Cleaning a customer column and hashing a customer key depend on the customer row alone.
They are done once per customer, below the join, not once per sale above it. Sales without
a customer get, above the join, what cleaning makes of NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions import (
    NOT_INFORMED,
    NOT_INFORMED_TITLE,
    clean_string,
    null_to_token,
    parse_date_br,
    surrogate_key,
)
from salesmart.operators.conform import NARROW_TEXT, conform_column, conform_narrow_text
from salesmart.operators.joins import (
    NARROW,
    Ways,
    all_lookups,
    join_customer,
    narrow_lookups,
    sales_columns,
)
from salesmart.operators.keys import CALENDAR, key_of, narrow_keys, wide_keys, with_calendar
from salesmart.operators.skew import AUTO
from salesmart.schemas import STAGE, VENDAS

CUSTOMER_KEYS = ["DW_CLIENTES", "DW_LOCALIDADE"]


def _is_sales_column(name: str) -> bool:
    return name in VENDAS.names or name == "data_foto"


def conformed_customers(customers: DataFrame, sep: str = "") -> DataFrame:
    """Customer columns of the wide stage cleaned, with the customer's keys.

    The customer key itself stays as it arrived: rows are joined by the raw value.
    """
    cleaned = [
        conform_column(f)
        for f in STAGE
        if not _is_sales_column(f.name) and f.name in customers.columns
    ]
    rows = customers.select("customerkey", *cleaned)
    key = clean_string(F.col("customerkey"))
    return rows.withColumns(
        {
            "DW_CLIENTES": surrogate_key(key, F.col("customer"), sep=sep),
            "DW_LOCALIDADE": surrogate_key(key, F.col("address_number"), sep=sep),
        }
    )


def conformed_stage(
    vendas: DataFrame,
    clientes: DataFrame,
    endereco: DataFrame,
    divisao: DataFrame,
    regiao: DataFrame,
    how: Ways = AUTO,
) -> DataFrame:
    """The wide stage cleaned and typed: `conform_stage(stage_join(...))`, row for row."""
    return wide_stage(vendas, clientes, endereco, divisao, regiao, how=how).select(*STAGE.names)


def wide_stage(
    vendas: DataFrame,
    clientes: DataFrame,
    endereco: DataFrame,
    divisao: DataFrame,
    regiao: DataFrame,
    sep: str = "",
    how: Ways = AUTO,
    dense: bool = True,
) -> DataFrame:
    """The wide stage cleaned and typed, with calendar columns and keys. Callers that want few
    columns do better with sales that are not `dense`."""
    lookups = all_lookups(clientes, endereco, divisao, regiao)
    ways = lookups.ways(how)
    customers = conformed_customers(lookups.rows(ways), sep)
    sales = sales_columns(vendas).select(
        "customerkey",
        *[
            conform_column(f)
            for f in STAGE
            if _is_sales_column(f.name) and f.name != "customerkey"
        ],
    )
    key = clean_string(F.col("customerkey"))
    no_customer = surrogate_key(key, F.lit(NOT_INFORMED), sep=sep)
    filled = {
        f.name: null_to_token(F.col(f.name), NOT_INFORMED)
        for f in STAGE
        if not _is_sales_column(f.name)
    }
    filled |= {name: F.coalesce(F.col(name), no_customer) for name in CUSTOMER_KEYS}
    filled |= {"customerkey": key}
    stage = with_calendar(join_customer(sales, customers, lookups, ways, dense=dense).withColumns(filled))
    sales_keys = {k: v for k, v in wide_keys(sep).items() if k not in CUSTOMER_KEYS}
    return stage.withColumns(sales_keys).select(*STAGE.names, *CALENDAR, *wide_keys(sep))


def narrow_customers(
    customers: DataFrame, sep: str = "", token: str = NOT_INFORMED_TITLE, hashed: bool = True
) -> DataFrame:
    """Customer columns of the narrow stage cleaned, with keys made of the raw values.

    Customers without an address column get the customer key alone.
    """
    has_address = "address_number" in customers.columns
    names = CUSTOMER_KEYS if has_address else ["DW_CLIENTES"]
    keys = {name: narrow_keys(sep, hashed)[name] for name in names}
    cleaned = {
        c: conform_narrow_text(F.col(c), token) for c in NARROW_TEXT if c in customers.columns
    }
    return customers.withColumns(keys).withColumns(cleaned)


def narrow_stage(
    vendas: DataFrame,
    clientes: DataFrame,
    endereco: DataFrame,
    divisao: DataFrame,
    regiao: DataFrame,
    sep: str = "",
    token: str = NOT_INFORMED_TITLE,
    how: Ways = AUTO,
    hashed: bool = True,
) -> DataFrame:
    """The narrow stage with typed invoice date, calendar columns, keys, and clean text.

    Keys that are not `hashed` are the texts that a hash is made of."""
    lookups = narrow_lookups(clientes, endereco, divisao, regiao)
    ways = lookups.ways(how)
    customers = narrow_customers(lookups.rows(ways).drop("division", "region_code"), sep, token, hashed)
    sales = sales_columns(vendas)
    sales = sales.select(*[c for c in NARROW if _is_sales_column(c)]).withColumn(
        "invoice_date", parse_date_br(F.col("invoice_date"))
    )
    joined = join_customer(sales, customers, lookups, ways)
    filled = {c: null_to_token(F.col(c), token) for c in NARROW_TEXT}
    filled |= {c: F.coalesce(F.col(c), key_of("customerkey", sep=sep, hashed=hashed)) for c in CUSTOMER_KEYS}
    sales_keys = {k: v for k, v in narrow_keys(sep, hashed).items() if k not in CUSTOMER_KEYS}
    stage = with_calendar(joined.withColumns(filled)).withColumns(sales_keys)
    return stage.select(*NARROW, *CALENDAR, *narrow_keys(sep))
