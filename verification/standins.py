"""The five entities, as dirty text, made of the test tables.

The expressions are plain SQL that Spark and DuckDB both read, so both engines start from
the same text. The dirt: NULL, empty and blank text, blank runs, control characters, text that
is no number or no date, sales without a customer, customers without an address, and repeated
lookup keys. Every row of the test tables is there; a lookup that lacks a key has another in its
place. In the skewed variant a third of the sales have one customer and a third none, and some
addresses are there many times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT_TEXT = "20240101"


def _text(x: str) -> str:
    return f"cast({x} as string)"


def _whole(x: str) -> str:
    return f"cast({x} as bigint)"


def _date_br(ts: str) -> str:
    """A timestamp as dd/MM/yyyy."""
    day = f"lpad({_text(f'day({ts})')}, 2, '0')"
    month = f"lpad({_text(f'month({ts})')}, 2, '0')"
    return f"concat({day}, '/', {month}, '/', {_text(f'year({ts})')})"


def _number(cents: str, group: str, mark: str) -> str:
    """Whole cents as text, with a sign for thousands and a decimal mark."""
    units = _whole(f"floor(abs({cents}) / 100)")
    thousands = _whole(f"floor(abs({cents}) / 100000)")
    return (
        f"concat(case when {cents} < 0 then '-' else '' end, "
        f"case when {units} >= 1000 then concat({_text(thousands)}, '{group}', "
        f"lpad({_text(f'{units} % 1000')}, 3, '0')) else {_text(units)} end, "
        f"'{mark}', lpad({_text(f'abs({cents}) % 100')}, 2, '0'))"
    )


def _number_br(cents: str) -> str:
    return _number(cents, ".", ",")


def _either(selector: str, cases: list[str], otherwise: str) -> str:
    branches = " ".join(f"when {i} then {value}" for i, value in enumerate(cases))
    return f"case {selector} {branches} else {otherwise} end"


_PRICE = _whole("round(l_extendedprice * 100)")
_PERCENT = _whole("round(l_discount * 100)")
_NET = _whole(f"floor({_PRICE} * (100 - {_PERCENT}) / 100)")
_PART = _text("l_partkey")
_ORDERED = _date_br("o_orderdate")
_SHIPPED = _date_br("l_shipdate")

VENDAS = {
    "actual_delivery_date": _either("l_suppkey % 7", ["null", "''"], _SHIPPED),
    "customerkey": _either("o_custkey % 50", ["null", "''"], _text("o_custkey")),
    "datekey": _SHIPPED,
    "discount_amount": _either(
        "l_partkey % 13", ["''", "null"], _number_br(_whole(f"floor({_PRICE} * {_PERCENT} / 100)"))
    ),
    "invoice_date": _either(
        "l_suppkey % 20",
        [
            "null",
            "''",
            "'31/02/2020'",
            "'2020-01-01'",
            f"concat({_text('day(o_orderdate)')}, '/', {_text('month(o_orderdate)')}, '/', "
            f"{_text('year(o_orderdate)')})",
        ],
        _ORDERED,
    ),
    "invoice_number": _text("l_orderkey"),
    "item_class": "l_returnflag",
    "item_number": _PART,
    "item": _either(
        "l_partkey % 19",
        [
            "''",
            "'    '",
            "null",
            f"concat('Item  ', {_PART}, '   x  y')",
            f"concat('  Item ', {_PART})",
            f"concat(' Item ', {_PART})",
            f"concat('Item', chr(9), ' ', {_PART}, chr(9), ' z ')",
            f"concat('Item', chr(1), {_PART})",
        ],
        f"concat('Item ', {_PART})",
    ),
    "line_number": _text("l_linenumber"),
    "list_price": _either(
        "l_partkey % 23",
        [
            "''",
            "null",
            "'n/d'",
            f"concat('  ', {_number_br(_PRICE)}, ' ')",
            "'12d'",
            _number(_PRICE, ",", "."),
            "'   '",
            f"concat('\u00a0', {_number_br(_PRICE)}, '\u00a0')",
            f"concat({_number_br(_PRICE)}, '\u2009 ')",
        ],
        _number_br(_PRICE),
    ),
    "order_number": _text("o_orderkey"),
    "promised_delivery_date": _either(
        "l_suppkey % 5", [_text("cast(l_shipdate as date)"), "'20200101'"], _SHIPPED
    ),
    "sales_amount": _number_br(_NET),
    "sales_amount_based_on_list_price": _number_br(_PRICE),
    "sales_cost_amount": _number_br(_whole(f"floor({_PRICE} * 60 / 100)")),
    "sales_margin_amount": _number_br(f"({_NET} - {_whole(f'floor({_PRICE} * 95 / 100)')})"),
    "sales_price": _number_br(_whole(f"floor({_NET} / {_whole('l_quantity')})")),
    "sales_quantity": _text(_whole("l_quantity")),
    "sales_rep": _text("l_suppkey"),
    "u_m": _either("l_suppkey % 9", ["''", "null", "'  '"], "l_linestatus"),
    "dt_foto": _either("l_partkey % 10", ["null", "'2024-01-01'"], f"'{SNAPSHOT_TEXT}'"),
}

# A number from the same rows in the other notation, for the parser of that notation.
PRICE_US = _either(
    "l_partkey % 23", ["''", "null", "'n/d'"], _number(_PRICE, ",", ".")
)

_NATION = _text("c_nationkey")
_REGION = _text("c_nationkey % 5")

CLIENTES = {
    "address_number": _either(
        "c_custkey % 31", ["null", "''", "'A  B'"], f"concat('A', {_text('c_custkey')})"
    ),
    "business_family": "concat('Family ', c_mktsegment)",
    "business_unit": _either("c_custkey % 6", ["''", "null"], f"concat('U', {_NATION})"),
    "customer": _either(
        "c_custkey % 17",
        [
            "''",
            "'   '",
            "concat(c_name, '  x   y')",
            "null",
            "concat(' ', c_name)",
            "concat('   ', c_name)",
        ],
        "concat(c_name, case when copy = 1 then ' II' else '' end)",
    ),
    "customerkey": f"case when c_custkey = 51 then '' when c_custkey % 10 = 0 "
    f"then concat('X', {_text('c_custkey')}) else {_text('c_custkey')} end",
    "customer_type": "case when c_acctbal < 0 then 'debtor' else 'creditor' end",
    "division": "case when c_custkey % 23 = 0 then null else c_mktsegment end",
    "line_of_business": "concat(c_mktsegment, '   line')",
    "phone": f"concat('+', {_text('c_nationkey')}, '  ', {_text('c_custkey')})",
    "region_code": f"case when c_custkey % 37 = 0 then '99' else {_REGION} end",
    "regional_sales_mgr": f"concat('Manager ', {_REGION})",
    "search_type": "case when c_custkey % 3 = 0 then '' else 'C' end",
    "dt_foto": f"'{SNAPSHOT_TEXT}'",
}

ENDERECO = {
    "address_number": f"concat(case when c_custkey % 7 = 0 then 'X' else 'A' end, {_text('c_custkey')})",
    "city": _either(
        "c_custkey % 12",
        ["''", "null", f"concat('City  ', {_NATION})"],
        f"concat('City ', {_NATION})",
    ),
    "country": f"concat('Country ', {_NATION})",
    "customer_address_1": f"concat('Street ', {_text('c_custkey')}, '  no. 1')",
    "customer_address_2": "case when copy = 1 then 'second' else '' end",
    "customer_address_3": "null",
    "customer_address_4": "'   '",
    "state": f"concat('State   ', {_REGION}, '  ', {_NATION})",
    "zip_code": f"lpad({_text('c_custkey')}, 8, '0')",
    "dt_foto": f"'{SNAPSHOT_TEXT}'",
}

DIVISAO = {
    "division": "case when c_mktsegment = 'FURNITURE' then 'X' else c_mktsegment end",
    "division_name": "case when c_mktsegment = 'BUILDING' and c_custkey % 2 = 0 "
    "then concat(c_mktsegment, '  (new)') else c_mktsegment end",
    "dt_foto": f"'{SNAPSHOT_TEXT}'",
}

REGIAO = {
    "region_code": f"case when {_REGION} = '4' then 'X' else {_REGION} end",
    "region_name": f"case when {_REGION} = '1' then '  Region 1' "
    f"else concat('Region  ', {_REGION}) end",
    "dt_foto": f"'{SNAPSHOT_TEXT}'",
}

# What several columns of the sales are made of, each of those before it: Spark works it out once a row.
SHARED = {
    "_price": _PRICE,
    "_net": _NET,
    "_ordered": _ORDERED,
    "_shipped": _SHIPPED,
    "_price_br": _number_br(_PRICE),
}

# Fixed conditions: which lookup rows are there more than once, as (condition, times).
CUSTOMER_COPIES = [("c_custkey % 40 = 3", 2)]
ADDRESS_COPIES = [("c_custkey % 45 = 4", 2)]

# The skewed variant: the customer and the addresses that have many rows.
SKEWED_VENDAS = VENDAS | {
    "customerkey": _either("o_custkey % 3", ["'8'", "null"], _text("o_custkey"))
}
SKEWED_ADDRESS_COPIES = [("c_custkey = 8", 3), ("c_custkey = 9", 40), *ADDRESS_COPIES]


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(
        *[f"cast({value} as string) as {name}" for name, value in columns.items()]
    )


def _copies(copies: list[tuple[str, int]], series: str) -> str:
    """The numbers of a row's copies as an array, by the engine's function for a series."""
    cases = " ".join(f"when {where} then {series}(0, {times} - 1)" for where, times in copies)
    return f"case {cases} else {series}(0, 0) end"


def _select_sales(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The same with the shared parts as columns of their own below."""
    made: dict[str, str] = {}
    for name, value in SHARED.items():
        df = df.selectExpr("*", f"{_with_names(value, made)} as {name}")
        made[name] = _with_names(value, made)
    return _select(df, {name: _with_names(value, made) for name, value in columns.items()})


def _with_names(value: str, made: dict[str, str]) -> str:
    for name, part in made.items():
        value = value.replace(part, name)
    return value


class Standins:
    """The entities as DataFrames of text, read from the parquet files of one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, skewed: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir
        self.skewed = skewed
        self.tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A table, opened once: opening reads a file footer for the schema."""
        if name not in self.tables:
            self.tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self.tables[name]

    def sales_rows(self) -> DataFrame:
        """Sold lines with their order."""
        lines, orders = self.table("lineitem"), self.table("orders")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    def _customer_copies(self, copies: list[tuple[str, int]]) -> DataFrame:
        return self.table("customer").selectExpr("*", f"explode({_copies(copies, 'sequence')}) as copy")

    @property
    def vendas(self) -> DataFrame:
        return _select_sales(self.sales_rows(), SKEWED_VENDAS if self.skewed else VENDAS)

    @property
    def clientes(self) -> DataFrame:
        return _select(self._customer_copies(CUSTOMER_COPIES), CLIENTES)

    @property
    def endereco(self) -> DataFrame:
        copies = SKEWED_ADDRESS_COPIES if self.skewed else ADDRESS_COPIES
        return _select(self._customer_copies(copies), ENDERECO)

    @property
    def divisao(self) -> DataFrame:
        return _select(self.table("customer"), DIVISAO).distinct()

    @property
    def regiao(self) -> DataFrame:
        return _select(self.table("customer"), REGIAO).distinct()

    def entity(self, name: str) -> DataFrame:
        return getattr(self, name)

    @property
    def all(self) -> dict[str, DataFrame]:
        return {
            name: self.entity(name)
            for name in ("vendas", "clientes", "endereco", "divisao", "regiao")
        }


def _sql(columns: dict[str, str], source: str, distinct: bool = False) -> str:
    items = ", ".join(f"cast({value} as string) as {name}" for name, value in columns.items())
    return f"select {'distinct ' if distinct else ''}{items} from {source}"


SALES_ROWS = "lineitem join orders on o_orderkey = l_orderkey"


def _sql_copies(copies: list[tuple[str, int]]) -> str:
    return f"(select *, unnest({_copies(copies, 'generate_series')}) as copy from customer) as copied"


def standin_sql(skewed: bool = False) -> dict[str, str]:
    """The same entities for DuckDB, as the bodies of common table expressions."""
    return {
        "vendas": _sql(SKEWED_VENDAS if skewed else VENDAS, SALES_ROWS),
        "clientes": _sql(CLIENTES, _sql_copies(CUSTOMER_COPIES)),
        "endereco": _sql(ENDERECO, _sql_copies(SKEWED_ADDRESS_COPIES if skewed else ADDRESS_COPIES)),
        "divisao": _sql(DIVISAO, "customer", distinct=True),
        "regiao": _sql(REGIAO, "customer", distinct=True),
    }
