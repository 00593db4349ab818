"""Declared columns of the five sales entities and of the wide stage, in contract order.

Text as it arrives is described by the column names alone: every raw and staged
column is a string. The types below hold after cleaning.
"""

from __future__ import annotations

from pyspark.sql import types as T

SNAPSHOT = "dt_foto"

# Entity names, column names, their order and types are the data contract.
REGIAO = T.StructType(
    [
        T.StructField("region_code", T.StringType()),
        T.StructField("region_name", T.StringType()),
        T.StructField("dt_foto", T.DateType()),
    ]
)

DIVISAO = T.StructType(
    [
        T.StructField("division", T.StringType()),
        T.StructField("division_name", T.StringType()),
        T.StructField("dt_foto", T.DateType()),
    ]
)

ENDERECO = T.StructType(
    [
        T.StructField("address_number", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("customer_address_1", T.StringType()),
        T.StructField("customer_address_2", T.StringType()),
        T.StructField("customer_address_3", T.StringType()),
        T.StructField("customer_address_4", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("zip_code", T.StringType()),
        T.StructField("dt_foto", T.DateType()),
    ]
)

CLIENTES = T.StructType(
    [
        T.StructField("address_number", T.StringType()),
        T.StructField("business_family", T.StringType()),
        T.StructField("business_unit", T.StringType()),
        T.StructField("customer", T.StringType()),
        T.StructField("customerkey", T.StringType()),
        T.StructField("customer_type", T.StringType()),
        T.StructField("division", T.StringType()),
        T.StructField("line_of_business", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("region_code", T.StringType()),
        T.StructField("regional_sales_mgr", T.StringType()),
        T.StructField("search_type", T.StringType()),
        T.StructField("dt_foto", T.DateType()),
    ]
)

VENDAS = T.StructType(
    [
        T.StructField("actual_delivery_date", T.DateType()),
        T.StructField("customerkey", T.StringType()),
        T.StructField("datekey", T.DateType()),
        T.StructField("discount_amount", T.DoubleType()),
        T.StructField("invoice_date", T.DateType()),
        T.StructField("invoice_number", T.StringType()),
        T.StructField("item_class", T.StringType()),
        T.StructField("item_number", T.StringType()),
        T.StructField("item", T.StringType()),
        T.StructField("line_number", T.StringType()),
        T.StructField("list_price", T.DoubleType()),
        T.StructField("order_number", T.StringType()),
        T.StructField("promised_delivery_date", T.DateType()),
        T.StructField("sales_amount", T.DoubleType()),
        T.StructField("sales_amount_based_on_list_price", T.DoubleType()),
        T.StructField("sales_cost_amount", T.DoubleType()),
        T.StructField("sales_margin_amount", T.DoubleType()),
        T.StructField("sales_price", T.DoubleType()),
        T.StructField("sales_quantity", T.DoubleType()),
        T.StructField("sales_rep", T.DoubleType()),
        T.StructField("u_m", T.StringType()),
        T.StructField("dt_foto", T.DateType()),
    ]
)

ENTITIES = {
    "clientes": CLIENTES,
    "divisao": DIVISAO,
    "endereco": ENDERECO,
    "regiao": REGIAO,
    "vendas": VENDAS,
}

# The columns that entities are joined by.
JOIN_KEYS = {
    "clientes": ["customerkey", "address_number", "division", "region_code"],
    "divisao": ["division"],
    "endereco": ["address_number"],
    "regiao": ["region_code"],
    "vendas": ["customerkey"],
}

# The measures of the sales fact.
MEASURES = [
    "list_price",
    "sales_amount",
    "sales_amount_based_on_list_price",
    "sales_cost_amount",
    "sales_margin_amount",
    "sales_price",
]


def data_columns(schema: T.StructType) -> list[str]:
    """Column names without the snapshot date, which is added at load."""
    return [name for name in schema.names if name != SNAPSHOT]


def staged_schema(schema: T.StructType) -> T.StructType:
    """The same columns as text, with the snapshot date last, as the partitions hold them."""
    names = [*data_columns(schema), SNAPSHOT]
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def columns_of_type(schema: T.StructType, kind: type[T.DataType]) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, kind)]


# The wide stage. The snapshot date of the sales rows is data_foto here.
STAGE = T.StructType(
    [
        T.StructField("actual_delivery_date", T.DateType()),
        T.StructField("customerkey", T.StringType()),
        T.StructField("datekey", T.DateType()),
        T.StructField("discount_amount", T.DoubleType()),
        T.StructField("invoice_date", T.DateType()),
        T.StructField("invoice_number", T.StringType()),
        T.StructField("item_class", T.StringType()),
        T.StructField("item_number", T.StringType()),
        T.StructField("item", T.StringType()),
        T.StructField("line_number", T.StringType()),
        T.StructField("list_price", T.DoubleType()),
        T.StructField("order_number", T.StringType()),
        T.StructField("promised_delivery_date", T.DateType()),
        T.StructField("sales_amount", T.DoubleType()),
        T.StructField("sales_amount_based_on_list_price", T.DoubleType()),
        T.StructField("sales_cost_amount", T.DoubleType()),
        T.StructField("sales_margin_amount", T.DoubleType()),
        T.StructField("sales_price", T.DoubleType()),
        T.StructField("sales_quantity", T.DoubleType()),
        T.StructField("sales_rep", T.DoubleType()),
        T.StructField("u_m", T.StringType()),
        T.StructField("data_foto", T.DateType()),
        T.StructField("address_number", T.StringType()),
        T.StructField("business_family", T.StringType()),
        T.StructField("business_unit", T.StringType()),
        T.StructField("customer", T.StringType()),
        T.StructField("customer_type", T.StringType()),
        T.StructField("division", T.StringType()),
        T.StructField("line_of_business", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("region_code", T.StringType()),
        T.StructField("regional_sales_mgr", T.StringType()),
        T.StructField("search_type", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("customer_address_1", T.StringType()),
        T.StructField("customer_address_2", T.StringType()),
        T.StructField("customer_address_3", T.StringType()),
        T.StructField("customer_address_4", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("zip_code", T.StringType()),
        T.StructField("division_name", T.StringType()),
        T.StructField("region_name", T.StringType()),
    ]
)
