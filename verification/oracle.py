"""The same queries in SQL for DuckDB, written the plain way.

Joins are the chain as it reads, every stage is joined and cleaned in full, and DISTINCT is
taken over it. None of the rewriting done for Spark is repeated here, and the column lists,
types and tokens are written out, so that a slip in the library's own shows.
"""

from __future__ import annotations

from verification.standins import PRICE_US, SALES_ROWS, standin_sql

# Columns in contract order; text unless listed as a number or a date.
REGIAO = ["region_code", "region_name"]
DIVISAO = ["division", "division_name"]
ENDERECO = [
    "address_number",
    "city",
    "country",
    "customer_address_1",
    "customer_address_2",
    "customer_address_3",
    "customer_address_4",
    "state",
    "zip_code",
]
CLIENTES = [
    "address_number",
    "business_family",
    "business_unit",
    "customer",
    "customerkey",
    "customer_type",
    "division",
    "line_of_business",
    "phone",
    "region_code",
    "regional_sales_mgr",
    "search_type",
]
VENDAS = [
    "actual_delivery_date",
    "customerkey",
    "datekey",
    "discount_amount",
    "invoice_date",
    "invoice_number",
    "item_class",
    "item_number",
    "item",
    "line_number",
    "list_price",
    "order_number",
    "promised_delivery_date",
    "sales_amount",
    "sales_amount_based_on_list_price",
    "sales_cost_amount",
    "sales_margin_amount",
    "sales_price",
    "sales_quantity",
    "sales_rep",
    "u_m",
]
ENTITIES = {
    "clientes": CLIENTES,
    "divisao": DIVISAO,
    "endereco": ENDERECO,
    "regiao": REGIAO,
    "vendas": VENDAS,
}
# The wide stage by source: tv sales, tc customers, te addresses, td divisions, tr regions.
STAGE = [
    *[f"tv.{name}" for name in VENDAS],
    "tv.dt_foto as data_foto",
    "tc.address_number",
    "tc.business_family",
    "tc.business_unit",
    "tc.customer",
    "tc.customer_type",
    "tc.division",
    "tc.line_of_business",
    "tc.phone",
    "tc.region_code",
    "tc.regional_sales_mgr",
    "tc.search_type",
    "te.city",
    "te.country",
    "te.customer_address_1",
    "te.customer_address_2",
    "te.customer_address_3",
    "te.customer_address_4",
    "te.state",
    "te.zip_code",
    "td.division_name",
    "tr.region_name",
]
NARROW = [
    "tv.customerkey",
    "tv.discount_amount",
    "tv.invoice_date",
    "tv.list_price",
    "tv.sales_amount",
    "tv.sales_amount_based_on_list_price",
    "tv.sales_cost_amount",
    "tv.sales_margin_amount",
    "tv.sales_price",
    "tv.sales_quantity",
    "tv.dt_foto as data_foto",
    "tc.address_number",
    "tc.customer",
    "te.city",
    "te.country",
    "te.state",
]
NUMBERS = [
    "discount_amount",
    "list_price",
    "sales_amount",
    "sales_amount_based_on_list_price",
    "sales_cost_amount",
    "sales_margin_amount",
    "sales_price",
    "sales_quantity",
    "sales_rep",
]
DATES = ["actual_delivery_date", "datekey", "invoice_date", "promised_delivery_date"]
MEASURES = [
    "list_price",
    "sales_amount",
    "sales_amount_based_on_list_price",
    "sales_cost_amount",
    "sales_margin_amount",
    "sales_price",
]
NARROW_TEXT = ["address_number", "city", "state", "country", "customer"]
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
NOT_INFORMED = "Não informado"
NOT_INFORMED_TITLE = "Não Informado"
BLANKS = (
    "chr(32), chr(9), chr(10), chr(11), chr(12), chr(13), chr(28), chr(29), chr(30), chr(31), "
    "chr(133), chr(160), chr(5760), chr(8192), chr(8193), chr(8194), chr(8195), chr(8196), "
    "chr(8197), chr(8198), chr(8199), chr(8200), chr(8201), chr(8202), chr(8232), chr(8233), "
    "chr(8239), chr(8287), chr(12288)"
)

SALE = "invoice_number, line_number, item_number"
LOADED = "'20240101'"


def names(columns: list[str]) -> list[str]:
    """Columns by the names they have in the result."""
    return [c.rsplit(" as ", 1)[-1].rsplit(".", 1)[-1] for c in columns]


def with_entities(body: str, skewed: bool = False, **more: str) -> str:
    """A query over the stand-in entities and further named queries."""
    named = {**standin_sql(skewed), **more}
    return "with " + ", ".join(f"{n} as ({sql})" for n, sql in named.items()) + " " + body


def clean_string(c: str) -> str:
    return (
        f"case when {c} is null or {c} = '' or regexp_matches({c}, '^\\s{{2,}}') "
        f"then '{NOT_INFORMED}' "
        f"else replace({c}, regexp_extract({c}, '\\s{{2,}}', 0), ' ') end"
    )


def blank_to_zero(c: str) -> str:
    return f"case when {c} is null or {c} = '' then '0.0' else {c} end"


def number_br(c: str) -> str:
    text = f"trim({blank_to_zero(c)}, concat({BLANKS}))"
    return f"try_cast(replace(replace({text}, '.', ''), ',', '.') as double)"


def date_br(c: str) -> str:
    return f"cast(try_strptime({c}, '%d/%m/%Y') as date)"


def snapshot_date(c: str) -> str:
    return f"cast(try_strptime({c}, '%Y%m%d') as date)"


def iso_date(c: str) -> str:
    return f"try_cast({c} as date)"


def narrow_text(c: str) -> str:
    token = f"'{NOT_INFORMED_TITLE}'"
    return f"coalesce(regexp_replace({c}, '\\s{{2,}}', {token}, 'g'), {token})"


def key(*parts: str) -> str:
    return f"sha256(concat_ws('', {', '.join(parts)}))"


def calendar(c: str) -> dict[str, str]:
    return {
        "_year": f"cast(year({c}) as integer)",
        "_month": f"cast(month({c}) as integer)",
        "_quarter": f"cast(quarter({c}) as integer)",
        "_weekofyear": f"cast(weekofyear({c}) as integer)",
    }


def items(columns: dict[str, str]) -> str:
    return ", ".join(f"{value} as {name}" for name, value in columns.items())


def conform_items(columns: list[str], dates=date_br) -> dict[str, str]:
    made = {}
    for name in columns:
        if name in NUMBERS:
            made[name] = number_br(name)
        elif name == "data_foto":
            made[name] = snapshot_date(name)
        else:
            made[name] = dates(name) if name in DATES else clean_string(name)
    return made


def entity_items(entity: str, iso: bool = False) -> dict[str, str]:
    made = conform_items(ENTITIES[entity], iso_date if iso else date_br)
    filled = "coalesce(dt_foto, '2024-01-01')"
    made["dt_foto"] = (
        iso_date(filled) if iso else f"coalesce({snapshot_date(filled)}, {iso_date(filled)})"
    )
    return made


JOINS = (
    "vendas tv left join clientes tc on tc.customerkey = tv.customerkey "
    "left join endereco te on te.address_number = tc.address_number "
    "left join divisao td on td.division = tc.division "
    "left join regiao tr on tr.region_code = tc.region_code"
)
RAW_STAGE = f"select {', '.join(STAGE)} from {JOINS}"
RAW_NARROW = f"select {', '.join(NARROW)} from {JOINS}"

WIDE = {
    "raw_stage": RAW_STAGE,
    "clean_stage": f"select {items(conform_items(names(STAGE)))} from raw_stage",
    "dated_stage": f"select *, {items(calendar('invoice_date'))} from clean_stage",
    "stage": "select *, "
    + items(
        {
            "DW_CLIENTES": key("customerkey", "customer"),
            "DW_TEMPO": key("invoice_date", "_year", "_month", "_quarter", "_weekofyear"),
            "DW_VENDAS": key("customerkey", "invoice_number", "datekey", "line_number"),
            "DW_LOCALIDADE": key("customerkey", "address_number"),
        }
    )
    + " from dated_stage",
}

_NARROW_CALENDAR = {k: v for k, v in calendar("invoice_date").items() if k != "_weekofyear"}
NARROW_STAGE = {
    "raw_stage": RAW_NARROW,
    "typed_stage": f"select * replace ({date_br('invoice_date')} as invoice_date) from raw_stage",
    "keyed_stage": "select *, "
    + items(
        {
            **_NARROW_CALENDAR,
            "DW_VENDAS": key("customerkey", "invoice_date", "sales_price"),
            "DW_CLIENTES": key("customerkey", "customer"),
            "DW_TEMPO": key("invoice_date"),
            "DW_LOCALIDADE": key("customerkey", "address_number"),
        }
    )
    + " from typed_stage",
    "stage": "select * replace ("
    + items({c: narrow_text(c) for c in NARROW_TEXT})
    + ") from keyed_stage",
}

MEASURE_ITEMS = items({c: number_br(c) for c in MEASURES})
KEY_PARTS = ["customerkey", "invoice_date", "month(invoice_date)", "u_m"]


def _from(entity: str, columns: str) -> str:
    return with_entities(f"select {columns} from {entity}")


def _text_items(entity: str) -> str:
    return ", ".join(ENTITIES[entity])


def _gold_items(entity: str) -> str:
    """Cleaned values as CSV keeps them: the writer trims text."""
    made = entity_items(entity)
    for name in ENTITIES[entity]:
        if name not in NUMBERS and name not in DATES:
            made[name] = f"trim({made[name]})"
    # A loaded row has the day it was loaded for.
    made["dt_foto"] = "date '2024-01-01'"
    return items(made)


def _rejects(columns: list[str], parse) -> str:
    counts = {n: f"count_if({n} is not null and {parse(n)} is null)" for n in columns}
    return _from("vendas", items({n: f"cast({c} as bigint)" for n, c in counts.items()}))


PARSED = [name for name in VENDAS if name in DATES or name in NUMBERS]


def _is_bad(name: str) -> str:
    return f"({name} is not null and {date_br(name) if name in DATES else number_br(name)} is null)"


BAD_COLUMNS = "concat_ws(',', " + ", ".join(f"case when {_is_bad(n)} then '{n}' end" for n in PARSED) + ")"


def _reject_rows(day: str) -> str:
    return with_entities(
        "select * from judged where bad_columns <> ''",
        judged=f"select {', '.join(VENDAS)}, {day} as dt_foto, {BAD_COLUMNS} as bad_columns from vendas",
    )


def _joined(columns: str, joins: str) -> str:
    sale = "tv.invoice_number, tv.line_number, tv.item_number, tv.customerkey"
    return with_entities(
        f"select {sale}, {columns} from vendas tv "
        f"left join clientes tc on tc.customerkey = tv.customerkey {joins}"
    )


def _names(prefix: str, columns: list[str], *without: str) -> str:
    return ", ".join(f"{prefix}.{n}" for n in columns if n not in without)


def _blank_rows() -> str:
    """The blank lines of the raw sales as a text table has them."""
    columns = ", ".join(["line", *["null"] * (len(VENDAS) - 1)])
    return f"select {columns} from vendas, (values (' '), ('  ')) as blanks(line) where cast(item_number as bigint) % 29 = 0"


KEYS_NARROW = (
    "select customerkey, invoice_date, sales_price, "
    "DW_VENDAS, DW_CLIENTES, DW_TEMPO, DW_LOCALIDADE from stage"
)
DIM_LOCALIDADE = "select distinct DW_LOCALIDADE, address_number, city, state, country from stage"
FACT_WITH_KEYS = (
    f"select distinct DW_VENDAS, DW_CLIENTES, DW_TEMPO, DW_LOCALIDADE, {MEASURE_ITEMS} from stage"
)


def _loaded(body: str, text: list[str], stage: dict[str, str], skewed: bool = False) -> str:
    """A star table of the job from files: snapshots have one day, and CSV trims text."""
    trimmed = ", ".join(f"trim({c}) as {c}" for c in text)
    replaced = f"select *{f' replace ({trimmed})' if text else ''} from star"
    day = {"vendas": "select * replace ('20240101' as dt_foto) from raw_vendas"}
    entities = standin_sql(skewed)
    named = {"raw_vendas": entities.pop("vendas"), **day, **entities, **stage, "star": body}
    return "with " + ", ".join(f"{n} as ({sql})" for n, sql in named.items()) + " " + replaced


ORACLE_SQL: dict[str, str] = {
    "scan_raw": _from("vendas", _text_items("vendas")),
    "scan_raw_blank_lines": with_entities(
        f"select {', '.join(VENDAS)} from vendas union all {_blank_rows()}"
    ),
    "raw_reject_count": _from(
        "vendas",
        "cast(2 * count_if(cast(item_number as bigint) % 29 = 0) as bigint) as blank_lines, "
        "cast(count_if(cast(item_number as bigint) % 31 = 0) as bigint) as wide_lines, "
        "cast(count_if(u_m is null and cast(item_number as bigint) % 2 = 0 "
        "and cast(item_number as bigint) % 31 <> 0) as bigint) as short_lines",
    ),
    "schema_from_header": _from("clientes", f"{_text_items('clientes')}, 'clientes' as entity"),
    "normalise_columns": _from("vendas", ", ".join([*VENDAS, "dt_foto"])),
    "snapshot_stamp": _from("vendas", f"{SALE}, customerkey, {LOADED} as dt_foto"),
    "stage_load": with_entities(
        f"select {_text_items('clientes')}, day as dt_foto from clientes "
        f"cross join (values ({LOADED}), ('20240102')) as days(day)"
    ),
    "load_by_header": _from("clientes", f"{_text_items('clientes')}, {LOADED} as dt_foto"),
    "register_table": _from("endereco", f"{_text_items('endereco')}, {LOADED} as dt_foto"),
    "register_raw_table": _from("vendas", _text_items("vendas")),
    "scan_staged": _from("vendas", f"{_text_items('vendas')}, {LOADED} as dt_foto"),
    "gold_sink": _from(
        "clientes", ", ".join(f"trim({n}) as {n}" for n in [*CLIENTES, "dt_foto"])
    ),
    "gold_sink_keep_blanks": _from("clientes", ", ".join([*CLIENTES, "dt_foto"])),
    **{f"export_{e}": _from(e, _gold_items(e)) for e in ENTITIES},
    "export_reject_count": _from("vendas", items({n: f"cast(count_if({_is_bad(n)}) as bigint)" for n in PARSED})),
    "export_rejects": _reject_rows(LOADED),
    "clean_string": _from("vendas", f"{SALE}, {clean_string('item')} as item"),
    "blank_to_zero": _from("vendas", f"{SALE}, {blank_to_zero('list_price')} as list_price"),
    "parse_number_br": _from("vendas", f"{SALE}, {number_br('list_price')} as list_price"),
    "parse_number_us": (
        "select l_orderkey, l_linenumber, l_partkey, "
        f"try_cast(replace(trim({PRICE_US}), ',', '') as float) as price from {SALES_ROWS}"
    ),
    "parse_date_br": _from("vendas", f"{SALE}, {date_br('invoice_date')} as invoice_date"),
    "cast_date_iso": _from(
        "vendas", f"{SALE}, {iso_date('promised_delivery_date')} as promised_delivery_date"
    ),
    "date_reject_count": _rejects(DATES, date_br),
    "number_reject_count": _rejects(NUMBERS, number_br),
    "reject_rows": _reject_rows("dt_foto"),
    "fill_snapshot_date": _from(
        "vendas", f"{SALE}, coalesce(dt_foto, '2024-01-01') as dt_foto"
    ),
    "whitespace_to_token": _from(
        "vendas",
        f"{SALE}, regexp_replace(item, '\\s{{2,}}', '{NOT_INFORMED_TITLE}', 'g') as item",
    ),
    "null_to_token": _from("vendas", f"{SALE}, coalesce(item, '{NOT_INFORMED_TITLE}') as item"),
    "calendar_parts": with_entities(
        f"select *, {items(calendar('invoice_date'))} from dated",
        dated=f"select {SALE}, {date_br('invoice_date')} as invoice_date from vendas",
    ),
    "concat_key": with_entities(
        f"select {SALE}, concat_ws('', {', '.join(KEY_PARTS)}) as key from dated",
        dated=f"select * replace ({date_br('invoice_date')} as invoice_date) from vendas",
    ),
    "surrogate_key": with_entities(
        f"select {SALE}, {key(*KEY_PARTS)} as key from dated",
        dated=f"select * replace ({date_br('invoice_date')} as invoice_date) from vendas",
    ),
    "join_customer": _joined(_names("tc", CLIENTES, "customerkey"), ""),
    "join_address": _joined(
        "tc.customer, tc.address_number, " + _names("te", ENDERECO, "address_number"),
        "left join endereco te on te.address_number = tc.address_number",
    ),
    "join_division": _joined(
        "tc.customer, tc.division, td.division_name",
        "left join divisao td on td.division = tc.division",
    ),
    "join_region": _joined(
        "tc.customer, tc.region_code, tr.region_name",
        "left join regiao tr on tr.region_code = tc.region_code",
    ),
    "stage_join": with_entities(RAW_STAGE),
    "stage_join_sql": with_entities(RAW_STAGE),
    "stage_view": with_entities(
        "select division_name, region_name, count(*) as sales, count(distinct customerkey) as customers "
        "from raw_stage group by division_name, region_name",
        raw_stage=RAW_STAGE,
    ),
    "stage_join_narrow": with_entities(RAW_NARROW),
    **{f"conform_{e}": _from(e, items(entity_items(e))) for e in ENTITIES},
    "conform_vendas_iso": _from("vendas", items(entity_items("vendas", iso=True))),
    "conform_stage": with_entities("select * from clean_stage", **WIDE),
    "conform_narrow": with_entities(f"select {', '.join(names(NARROW))} from stage", **NARROW_STAGE),
    "keys_narrow": with_entities(KEYS_NARROW, **NARROW_STAGE),
    "keys_wide": with_entities("select * from stage", **WIDE),
    "dim_tempo": with_entities(
        "select distinct DW_TEMPO, invoice_date, _year, _month, _quarter from stage",
        **NARROW_STAGE,
    ),
    "dim_clientes": with_entities(
        "select distinct DW_CLIENTES, customerkey, customer from stage", **NARROW_STAGE
    ),
    "dim_localidade": with_entities(DIM_LOCALIDADE, **NARROW_STAGE),
    "dim_cliente_division": with_entities(
        "select distinct DW_CLIENTES, customerkey, customer, division_name from stage", **WIDE
    ),
    "dim_clientes_wide": with_entities(f"select {', '.join(WIDE_CUSTOMER)} from stage", **WIDE),
    "dim_clientes_wide_distinct": with_entities(
        f"select distinct {', '.join(WIDE_CUSTOMER)} from stage", **WIDE
    ),
    "dim_row_count": with_entities("select count(*) as row_count from stage", **WIDE),
    "ft_vendas": with_entities(
        f"select distinct DW_VENDAS, {MEASURE_ITEMS} from stage", **NARROW_STAGE
    ),
    "ft_vendas_text": with_entities(
        f"select distinct DW_VENDAS, {', '.join(MEASURES)} from stage", **NARROW_STAGE
    ),
    "ft_vendas_with_keys": with_entities(FACT_WITH_KEYS, **NARROW_STAGE),
    "stage_join_salted": with_entities(RAW_STAGE, skewed=True),
    "stage_join_bucketed": with_entities(RAW_STAGE, skewed=True),
    "keys_wide_from_snapshots": _loaded("select * from stage", [], WIDE, skewed=True),
    "keys_wide_salted": with_entities("select * from stage", skewed=True, **WIDE),
    "keys_narrow_salted": with_entities(KEYS_NARROW, skewed=True, **NARROW_STAGE),
    "dim_localidade_salted": with_entities(DIM_LOCALIDADE, skewed=True, **NARROW_STAGE),
    "dim_row_count_salted": with_entities(
        "select count(*) as row_count from stage", skewed=True, **WIDE
    ),
    "ft_vendas_with_keys_salted": with_entities(FACT_WITH_KEYS, skewed=True, **NARROW_STAGE),
    "star_from_snapshots_dim_tempo": _loaded(
        "select distinct DW_TEMPO, invoice_date, _year, _month, _quarter from stage", ["DW_TEMPO"], NARROW_STAGE
    ),
    "star_from_snapshots_dim_clientes": _loaded(
        "select distinct DW_CLIENTES, customerkey, customer from stage", ["customerkey", "customer"], NARROW_STAGE
    ),
    "star_from_snapshots_dim_localidade": _loaded(
        DIM_LOCALIDADE, ["address_number", "city", "state", "country"], NARROW_STAGE
    ),
    "star_from_snapshots_ft_vendas": _loaded(
        f"select distinct DW_VENDAS, {MEASURE_ITEMS} from stage", ["DW_VENDAS"], NARROW_STAGE
    ),
    "star_from_snapshots_dim_clientes_wide": _loaded(
        f"select {', '.join(WIDE_CUSTOMER)} from stage", WIDE_CUSTOMER, WIDE
    ),
    "star_from_snapshots_dim_cliente_division": _loaded(
        "select distinct DW_CLIENTES, customerkey, customer, division_name from stage",
        ["DW_CLIENTES", "customerkey", "customer", "division_name"],
        WIDE,
    ),
    "preview": with_entities("select * from clientes order by customerkey, customer limit 5"),
}
