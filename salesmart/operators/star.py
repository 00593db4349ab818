"""Dimensions and the sales fact.

A DISTINCT over customer columns of the stage needs each sold customer once, and one over
the calendar each date once. So repeats are removed from the sales before anything is
joined, parsed or hashed. The result is that of DISTINCT over the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions import (
    NOT_INFORMED,
    NOT_INFORMED_TITLE,
    calendar_columns,
    clean_string,
    null_to_token,
    parse_date_br,
    parse_number_br,
    surrogate_key,
)
from salesmart.functions.keys import concat_key
from salesmart.operators.joins import Lookups, Ways, all_lookups, join_customer, narrow_lookups, sold_keys
from salesmart.operators.keys import key_of, narrow_keys
from salesmart.operators.skew import AUTO, SALTED, key_counts
from salesmart.operators.stage import conformed_customers, narrow_customers
from salesmart.schemas import MEASURES

# The columns of the wide customer dimension.
WIDE_CUSTOMER = [
    "DW_CLIENTES",
    "customerkey",
    "customer",
    "line_of_business",
    "business_family",
    "business_unit",
    "customer_type",
    "region_name",
    "regional_sales_mgr",
    "search_type",
    "phone",
    "division_name",
]


def dim_tempo(vendas: DataFrame, sep: str = "", texts: DataFrame | None = None) -> DataFrame:
    """Each invoice date with its parts; text that is no date counts as NULL. `texts` has the
    distinct texts, where they are known."""
    texts = vendas.select("invoice_date").distinct() if texts is None else texts
    dates = texts.select(parse_date_br(F.col("invoice_date")).alias("invoice_date")).distinct()
    parts = calendar_columns(F.col("invoice_date"))
    return dates.select(
        key_of("invoice_date", sep=sep).alias("DW_TEMPO"),
        "invoice_date",
        *[parts[name].alias(name) for name in ("_year", "_month", "_quarter")],
    )


def dim_clientes(
    vendas: DataFrame,
    clientes: DataFrame,
    sep: str = "",
    token: str = NOT_INFORMED_TITLE,
    how: Ways = AUTO,
    sold: DataFrame | None = None,
) -> DataFrame:
    """Each sold customer with its name. `sold` has the sold keys, where they are known."""
    lookups = Lookups(clientes.select("customerkey", "customer"))
    customers = narrow_customers(lookups.rows(), sep, token)
    found = _sold_customers(vendas, sold, customers, lookups, how)
    named = _no_customer(found, ["customer"], token, sep)
    return named.select("DW_CLIENTES", "customerkey", "customer").distinct()


def dim_localidade(
    vendas: DataFrame,
    clientes: DataFrame,
    endereco: DataFrame,
    sep: str = "",
    token: str = NOT_INFORMED_TITLE,
    how: Ways = AUTO,
    sold: DataFrame | None = None,
) -> DataFrame:
    """Each sold customer's place."""
    place = ["address_number", "city", "state", "country"]
    own = clientes.select("customerkey", "address_number", "customer")
    lookups = Lookups(own, address_number=endereco.select(*place))
    ways = lookups.ways(how)
    customers = narrow_customers(lookups.rows(ways), sep, token)
    found = _sold_customers(vendas, sold, customers, lookups, ways)
    return _no_customer(found, place, token, sep).select("DW_LOCALIDADE", *place).distinct()


def _sold_customers(
    vendas: DataFrame, sold: DataFrame | None, customers: DataFrame, lookups: Lookups, how: Ways
) -> DataFrame:
    """One row per sold key and customer: what a DISTINCT over customer columns needs."""
    sold = sold_keys(vendas) if sold is None else sold
    return join_customer(sold, customers, lookups, how, unique_sales=True)


def _no_customer(sold: DataFrame, names: list[str], token: str, sep: str) -> DataFrame:
    """Give sold keys without a customer the token and the keys they have in the stage."""
    alone = key_of("customerkey", sep=sep)
    keys = {c: F.coalesce(F.col(c), alone) for c in sold.columns if c.startswith("DW_")}
    return sold.withColumns({c: null_to_token(F.col(c), token) for c in names} | keys)


def _no_customer_wide(sold: DataFrame, sep: str) -> DataFrame:
    """The same for the wide stage, where the key is cleaned before it is hashed."""
    key = clean_string(F.col("customerkey"))
    alone = surrogate_key(key, F.lit(NOT_INFORMED), sep=sep)
    filled = {
        c: F.coalesce(F.col(c), alone)
        if c.startswith("DW_")
        else null_to_token(F.col(c), NOT_INFORMED)
        for c in sold.columns
    }
    return sold.withColumns(filled | {"customerkey": key})


def dim_cliente_division(
    vendas: DataFrame,
    clientes: DataFrame,
    divisao: DataFrame,
    sep: str = "",
    how: Ways = AUTO,
    sold: DataFrame | None = None,
) -> DataFrame:
    """Each sold customer with its division, text cleaned before the key is made."""
    own = clientes.select("customerkey", "customer", "address_number", "division")
    lookups = Lookups(own, division=divisao)
    ways = lookups.ways(how)
    customers = conformed_customers(lookups.rows(ways), sep)
    found = _sold_customers(vendas, sold, customers, lookups, ways)
    return _no_customer_wide(found, sep).select(
        "DW_CLIENTES", "customerkey", "customer", "division_name"
    ).distinct()


def dim_clientes_wide(
    vendas: DataFrame,
    clientes: DataFrame,
    endereco: DataFrame,
    divisao: DataFrame,
    regiao: DataFrame,
    sep: str = "",
    distinct: bool = False,
    how: Ways = AUTO,
    sold: DataFrame | None = None,
) -> DataFrame:
    """Twelve customer columns, one row per sale; with `distinct`, one per sold customer."""
    lookups = all_lookups(
        clientes,
        endereco.select("address_number"),
        divisao.select("division", "division_name"),
        regiao.select("region_code", "region_name"),
    )
    ways = lookups.ways(how)
    customers = conformed_customers(lookups.rows(ways), sep).select(*WIDE_CUSTOMER)
    if distinct:
        found = _sold_customers(vendas, sold, customers, lookups, ways)
        return _no_customer_wide(found, sep).select(*WIDE_CUSTOMER).distinct()
    every = join_customer(vendas.select("customerkey"), customers, lookups, ways)
    return _no_customer_wide(every, sep).select(*WIDE_CUSTOMER)


def dim_row_count(
    vendas: DataFrame,
    clientes: DataFrame,
    endereco: DataFrame,
    divisao: DataFrame,
    regiao: DataFrame,
) -> DataFrame:
    """The number of rows of the wide customer dimension.

    Rows are counted per key on both sides before the join, customers by their matches in the
    lookups, so nothing is multiplied out and both sides have each key once.
    """
    sales = key_counts(vendas, "customerkey").withColumnRenamed("_rows", "sales")
    lookups = all_lookups(clientes, endereco, divisao, regiao)
    matches = lookups.counts("customerkey").withColumnRenamed("_rows", "matches")
    joined = sales.join(matches, "customerkey", "left")
    return joined.agg(
        F.coalesce(
            F.sum(F.col("sales") * F.coalesce("matches", F.lit(1))), F.lit(0)
        ).alias("row_count")
    )


def ft_vendas(vendas: DataFrame, sep: str = "", measures=parse_number_br) -> DataFrame:
    """The sales fact: its key and six measures, without repeats.

    All of it comes from the sales, and repeats that lookups could make are removed anyway,
    so nothing is joined. Rows are told apart by the text the key is made of, which is
    shorter than its hash; the hash is made of what is left.

    `measures` turns text into numbers; None keeps the text.
    """
    parts = [F.col("customerkey"), parse_date_br(F.col("invoice_date")), F.col("sales_price")]
    return (
        vendas.select(
            concat_key(*parts, sep=sep).alias("_key"),
            *[(measures(F.col(c)) if measures else F.col(c)).alias(c) for c in MEASURES],
        )
        .distinct()
        .select(F.sha2("_key", 256).alias("DW_VENDAS"), *MEASURES)
    )


def ft_vendas_with_keys(
    vendas: DataFrame,
    clientes: DataFrame,
    endereco: DataFrame,
    divisao: DataFrame,
    regiao: DataFrame,
    sep: str = "",
    measures=parse_number_br,
    how: Ways = AUTO,
) -> DataFrame:
    """The sales fact with the keys of its dimensions, so that it can be joined to them.

    Rows are told apart by the texts of the keys, and by the date itself where that is all of a key:
    four hashes would be most of what is shuffled. Customers whose keys are the same are taken once, so
    repeated addresses make no rows. Beyond a broadcast of the customers rows are dealt out in the
    order of the customers, not by a hash of the row: as neighbours the keys of a customer take next to
    nothing in a shuffle and in columnar files, and a customer with many sales is cut into ranges.
    """
    lookups = narrow_lookups(clientes, endereco, divisao, regiao)
    ways = lookups.ways(how)
    alone = ["DW_CLIENTES", "DW_LOCALIDADE"]
    customers = narrow_customers(lookups.rows(ways), sep, hashed=False).select("customerkey", *alone).distinct()
    sales = vendas.select("customerkey", parse_date_br(F.col("invoice_date")).alias("invoice_date"), *MEASURES)
    joined = join_customer(sales, customers, lookups, ways, dense=True)
    texts = {name: F.coalesce(F.col(name), key_of("customerkey", sep=sep, hashed=False)) for name in alone}
    texts["DW_VENDAS"] = narrow_keys(sep, hashed=False)["DW_VENDAS"]
    typed = [(measures(F.col(c)) if measures else F.col(c)).alias(c) for c in MEASURES]
    rows = joined.withColumns(texts).select("DW_VENDAS", "DW_CLIENTES", "invoice_date", "DW_LOCALIDADE", *typed)
    if ways["customerkey"] == SALTED:
        rows = rows.repartitionByRange("DW_CLIENTES", "DW_VENDAS")
    hashed = {c: F.sha2(c, 256) for c in ("DW_VENDAS", "DW_CLIENTES", "DW_LOCALIDADE")}
    hashed["DW_TEMPO"] = key_of("invoice_date", sep=sep)
    keys = ["DW_VENDAS", "DW_CLIENTES", "DW_TEMPO", "DW_LOCALIDADE"]
    return rows.distinct().select(*[hashed[c].alias(c) for c in keys], *MEASURES)


def preview(df: DataFrame, *order_by: str, n: int = 5) -> DataFrame:
    """The first rows by a unique order."""
    return df.orderBy(*order_by).limit(n)
