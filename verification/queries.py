"""One query per operator, over whole tables. Each takes the session and a table folder."""

from __future__ import annotations

import datetime as dt
import uuid
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart import functions as fn
from salesmart.functions.keys import concat_key
from salesmart.operators import conform, joins, keys, stage, star
from salesmart.operators.skew import SALTED
from salesmart.plans import buckets, views
from salesmart.plans.export import export_entity
from salesmart.plans.load import load_entity
from salesmart.plans.star import scan_entities, star_job, ways_to_join
from salesmart.schemas import ENTITIES, STAGE, data_columns
from salesmart.sources import catalog, gold, raw, snapshots
from verification.scratch import scratch_dir
from verification.standins import PRICE_US, Standins

Query = Callable[[SparkSession, str], DataFrame]

# A fixed day of run, so that results do not depend on when a query is run.
RUN_DATE = dt.date(2024, 1, 2)

# How the whole jobs keep their gold; `gold_sink` has it as plain text.
GOLD_CODEC = "gzip"

SALE = ["invoice_number", "line_number", "item_number"]


def write_raw(df: DataFrame, path: str, odd_lines: bool = False) -> None:
    r"""Text as the raw files have it: `;`, a header per file, \N for NULL, no quotes; compressed.

    With `odd_lines` some lines of the sales have more fields than the header, some lack a
    last field that is NULL, and some are followed by a blank line.
    """
    fields = [F.coalesce(F.col(c), F.lit(raw.NULL_MARK)) for c in df.columns]
    line = F.concat_ws(raw.SEPARATOR, *fields)
    if odd_lines:
        part = F.col("item_number").cast("bigint")
        short = F.concat_ws(raw.SEPARATOR, *fields[:-1])
        wide = F.concat(line, F.lit(f"{raw.SEPARATOR}more{raw.SEPARATOR}"))
        line = F.when(part % 31 == 0, wide).when(F.col("u_m").isNull() & (part % 2 == 0), short).otherwise(line)
        blank = F.when(part % 29 == 0, F.array(line, F.lit(" "), F.lit("  "))).otherwise(F.array(line))
        line = F.explode(blank)
    writer = df.select(line.alias(raw.SEPARATOR.join(df.columns))).write
    (
        writer.option("header", True)
        .option("sep", "\u0002")
        .option("quote", "\u0000")
        .option("compression", "lz4")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def _raw_files(spark: SparkSession, sf_dir: str, entity: str, skewed: bool = False) -> str:
    path = f"{scratch_dir(spark)}/{entity}"
    df = Standins(spark, sf_dir, skewed).entity(entity)
    write_raw(df.select(*data_columns(ENTITIES[entity])), path, odd_lines=entity == "vendas")
    return path


def _load(spark: SparkSession, sf_dir: str, entity: str, path: str, skewed: bool = False) -> None:
    """Raw files of an entity loaded as the snapshot of the day before RUN_DATE. The raw files, which
    nothing reads once their load is published, are emptied."""
    source = _raw_files(spark, sf_dir, entity, skewed)
    load_entity(spark, entity, source, path, RUN_DATE)
    spark.range(0).select(F.lit("").alias("nothing")).write.mode("overwrite").text(source)


def _staged(spark: SparkSession, sf_dir: str, entity: str) -> str:
    """The snapshot of an entity by itself."""
    path = f"{scratch_dir(spark)}/{entity}"
    _load(spark, sf_dir, entity, path)
    return path


# Sources and sinks


def scan_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = data_columns(ENTITIES["vendas"])
    return raw.scan_raw(spark, _raw_files(spark, sf_dir, "vendas"), columns)


def scan_raw_blank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = data_columns(ENTITIES["vendas"])
    return raw.scan_raw(spark, _raw_files(spark, sf_dir, "vendas"), columns, blank_lines=True)


def raw_reject_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.raw_reject_counts(spark, _raw_files(spark, sf_dir, "vendas"))


def _display_names(df: DataFrame) -> DataFrame:
    """Column names as a person writes them, such as `Customer Type` or `U/M`."""
    return df.toDF(*[c.title().replace("_", " ").replace("U M", "U/M") for c in df.columns])


def schema_from_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark)}/CLIENTES.csv"
    clientes = Standins(spark, sf_dir).clientes.select(*data_columns(ENTITIES["clientes"]))
    write_raw(_display_names(clientes), path)
    names = raw.schema_from_header(spark, path)
    raw.check_columns(names, data_columns(ENTITIES["clientes"]), path)
    return raw.scan_raw(spark, path, names).withColumn("entity", F.lit(raw.entity_name(path)))


def normalise_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.normalise_columns(_display_names(Standins(spark, sf_dir).vendas))


def snapshot_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = Standins(spark, sf_dir).vendas.select(*SALE, "customerkey")
    return snapshots.stamp_snapshot(sales, RUN_DATE)


def stage_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three days loaded, one of them twice and one again with nothing in it."""
    path = f"{scratch_dir(spark)}/clientes"
    source = _raw_files(spark, sf_dir, "clientes")
    day = dt.timedelta(days=1)
    for run_date in (RUN_DATE, RUN_DATE + day, RUN_DATE + 2 * day, RUN_DATE):
        load_entity(spark, "clientes", source, path, run_date)
    nothing = f"{scratch_dir(spark)}/clientes"
    none = Standins(spark, sf_dir).clientes.select(*data_columns(ENTITIES["clientes"])).limit(0)
    write_raw(none, nothing)
    load_entity(spark, "clientes", nothing, path, RUN_DATE + 2 * day)
    return snapshots.scan_staged(spark, path, ENTITIES["clientes"], snapshots.ALL)


def load_by_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in files of which some have their columns in reverse order, and one more."""
    names = data_columns(ENTITIES["clientes"])
    rows = Standins(spark, sf_dir).clientes.select(*names)
    odd = F.crc32(F.coalesce("customer", F.lit(""))) % 2 == 1
    paths = [f"{scratch_dir(spark)}/{part}" for part in ("even", "odd")]
    write_raw(rows.where(~odd), paths[0])
    write_raw(_display_names(rows.where(odd).select(*names[::-1], F.lit("x").alias("more"))), paths[1])
    staged = f"{scratch_dir(spark)}/clientes"
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        load_entity(spark, "clientes", paths, staged, RUN_DATE)
    return snapshots.scan_staged(spark, staged, ENTITIES["clientes"])


def register_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark)
    table = catalog.register_table(
        spark,
        "salesmart_stage",
        "endereco",
        ENTITIES["endereco"],
        f"{folder}/endereco",
        f"{folder}/database",
    )
    catalog.load_table(Standins(spark, sf_dir).endereco, table, RUN_DATE)
    return catalog.scan_table(spark, table)


def register_raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _raw_files(spark, sf_dir, "vendas")
    columns = raw.schema_from_header(spark, path)
    table = catalog.register_raw_table(
        spark, "salesmart_raw", "vendas", columns, path, f"{scratch_dir(spark)}/database"
    )
    return catalog.scan_raw_table(spark, table)


def scan_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _staged(spark, sf_dir, "vendas")
    return snapshots.scan_staged(spark, path, ENTITIES["vendas"])


def _gold(keep_blanks: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{scratch_dir(spark)}/clientes"
        rows = Standins(spark, sf_dir).clientes
        gold.write_gold(rows, path, keep_blanks=keep_blanks)
        return gold.read_gold(spark, path, rows.schema)

    return query


def _export(entity: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{scratch_dir(spark)}/{entity}"
        export_entity(spark, entity, _staged(spark, sf_dir, entity), path, RUN_DATE, compression=GOLD_CODEC)
        return gold.read_gold(spark, path, ENTITIES[entity])

    return query


def export_reject_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the export itself has counted while it wrote the sales."""
    path = f"{scratch_dir(spark)}/vendas"
    done = export_entity(spark, "vendas", _staged(spark, sf_dir, "vendas"), path, RUN_DATE, compression=GOLD_CODEC)
    return spark.createDataFrame([tuple(done.rejects.values())], ", ".join(f"{n} long" for n in done.rejects))


def export_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the export has put aside, read back."""
    folder = scratch_dir(spark)
    staged = _staged(spark, sf_dir, "vendas")
    options = {"rejects_path": f"{folder}/rejects", "compression": GOLD_CODEC}
    export_entity(spark, "vendas", staged, f"{folder}/vendas", RUN_DATE, **options)
    names = [*ENTITIES["vendas"].names, conform.BAD_COLUMNS]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*snapshots.staged_schema(ENTITIES["vendas"]).names, conform.BAD_COLUMNS]])
    return gold.read_gold(spark, f"{folder}/rejects", schema).select(*names)


def _star_from_snapshots(name: str, wide: bool = False) -> Query:
    """One star table by the whole job: raw text, snapshots, star, gold, and back."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch_dir(spark)
        for entity in ENTITIES:
            _load(spark, sf_dir, entity, f"{folder}/stage/{entity}")
        tables = {"narrow": not wide, "wide": wide, "wanted": lambda x: x == name}
        star_job(spark, f"{folder}/stage", f"{folder}/gold", **tables, compression=GOLD_CODEC)
        header = spark.read.option("header", True).option("sep", raw.SEPARATOR).csv(gold.gold_folder(spark, f"{folder}/gold/{name}"))
        kinds = {f.name: f.dataType for f in STAGE if name == "ft_vendas" or f.name == "invoice_date"}
        kinds |= {c: T.IntegerType() for c in keys.CALENDAR}
        schema = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in header.columns])
        return gold.read_gold(spark, f"{folder}/gold/{name}", schema)

    return query


# Scalar functions


def _sales_column(name: str, **columns) -> Query:
    """Functions over one sales column, beside the sale they belong to."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return Standins(spark, sf_dir).vendas.select(
            *SALE, *[f(F.col(name)).alias(alias) for alias, f in columns.items()]
        )

    return query


def parse_number_us(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Standins(spark, sf_dir).sales_rows()
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        fn.parse_number_us(F.expr(PRICE_US)).alias("price"),
    )


def fill_snapshot_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = Standins(spark, sf_dir).vendas
    return sales.select(
        *SALE, fn.fill_snapshot_date(F.col("dt_foto"), RUN_DATE).alias("dt_foto")
    )


def date_reject_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.date_reject_counts(Standins(spark, sf_dir).vendas, ENTITIES["vendas"])


def number_reject_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.number_reject_counts(Standins(spark, sf_dir).vendas, ENTITIES["vendas"])


def reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.reject_rows(Standins(spark, sf_dir).vendas, ENTITIES["vendas"])


def calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = Standins(spark, sf_dir).vendas
    dated = sales.select(*SALE, fn.parse_date_br(F.col("invoice_date")).alias("invoice_date"))
    return keys.with_calendar(dated)


def concat_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = Standins(spark, sf_dir).vendas
    date = fn.parse_date_br(F.col("invoice_date"))
    parts = [F.col("customerkey"), date, F.month(date), F.col("u_m")]
    return sales.select(*SALE, concat_key(*parts).alias("key"))


def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = Standins(spark, sf_dir).vendas
    date = fn.parse_date_br(F.col("invoice_date"))
    parts = [F.col("customerkey"), date, F.month(date), F.col("u_m")]
    return sales.select(*SALE, fn.surrogate_key(*parts).alias("key"))


# Joins


def join_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Standins(spark, sf_dir)
    return joins.join_customer(s.vendas.select(*SALE, "customerkey"), s.clientes, joins.Lookups(s.clientes))


def _lookup(key: str, entity: str) -> Query:
    """Sales with the columns of one lookup of their customers."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        s = Standins(spark, sf_dir)
        clientes = s.clientes.select("customerkey", "customer", key)
        lookups = joins.Lookups(clientes, **{key: s.entity(entity)})
        ways = lookups.ways()
        sales = s.vendas.select(*SALE, "customerkey")
        return joins.join_customer(sales, lookups.rows(ways), lookups, ways)

    return query


def stage_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.stage_join(**Standins(spark, sf_dir).all)


def stage_join_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stage by SQL text over views of the entities."""
    with views.session_views(spark, Standins(spark, sf_dir).all, prefix=f"v{uuid.uuid4().hex}_") as names:
        return spark.sql(views.stage_sql(names))


def stage_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question in SQL to the view of the stage."""
    with views.session_views(spark, Standins(spark, sf_dir).all, prefix=f"v{uuid.uuid4().hex}_") as names:
        return spark.sql(
            f"select division_name, region_name, count(*) as sales, count(distinct customerkey) as customers "
            f"from {names[views.STAGE_VIEW]} group by division_name, region_name"
        )


def stage_join_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stage of the skewed tables, sales and customers kept in buckets."""
    tables, name = Standins(spark, sf_dir, skewed=True).all, f"b{uuid.uuid4().hex}"
    kept = buckets.write_buckets(spark, tables, "salesmart_buckets", name, scratch_dir(spark), 16)
    lookups = {entity: tables[entity] for entity in ("endereco", "divisao", "regiao")}
    return buckets.stage_join_bucketed(spark, kept, lookups, SALTED)


def keys_wide_from_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The skewed tables loaded as a day; how to join them is decided by what the loads tell."""
    folder = scratch_dir(spark)
    for entity in ENTITIES:
        _load(spark, sf_dir, entity, f"{folder}/{entity}", skewed=True)
    tables = scan_entities(spark, folder)
    return stage.wide_stage(**tables, how=ways_to_join(tables, SALTED))


def stage_join_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.stage_join_narrow(**Standins(spark, sf_dir).all)


# Cleaning, keys, star


def _conform(entity: str, iso_dates: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = Standins(spark, sf_dir).entity(entity)
        return conform.conform_entity(df, ENTITIES[entity], RUN_DATE, iso_dates)

    return query


def conform_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage.conformed_stage(**Standins(spark, sf_dir).all)


def conform_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage.narrow_stage(**Standins(spark, sf_dir).all).select(*joins.NARROW)


NARROW_KEYS = ["DW_VENDAS", "DW_CLIENTES", "DW_TEMPO", "DW_LOCALIDADE"]


def keys_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = stage.narrow_stage(**Standins(spark, sf_dir).all)
    return narrow.select("customerkey", "invoice_date", "sales_price", *NARROW_KEYS)


def keys_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage.wide_stage(**Standins(spark, sf_dir).all)


def dim_tempo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_tempo(Standins(spark, sf_dir).vendas)


def dim_clientes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Standins(spark, sf_dir)
    return star.dim_clientes(s.vendas, s.clientes)


def dim_localidade(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Standins(spark, sf_dir)
    return star.dim_localidade(s.vendas, s.clientes, s.endereco)


def dim_cliente_division(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Standins(spark, sf_dir)
    return star.dim_cliente_division(s.vendas, s.clientes, s.divisao)


def dim_clientes_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_clientes_wide(**Standins(spark, sf_dir).all)


def dim_clientes_wide_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_clientes_wide(**Standins(spark, sf_dir).all, distinct=True)


def dim_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_row_count(**Standins(spark, sf_dir).all)


def ft_vendas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.ft_vendas(Standins(spark, sf_dir).vendas)


def ft_vendas_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.ft_vendas(Standins(spark, sf_dir).vendas, measures=None)


def ft_vendas_with_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.ft_vendas_with_keys(**Standins(spark, sf_dir).all)


# The way to join that large lookups take, over skewed stand-ins


def _salted(operator, *tables: str, columns: list[str] | None = None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        made = Standins(spark, sf_dir, skewed=True).all
        df = operator(**{name: made[name] for name in tables or made}, how=SALTED)
        return df.select(*columns) if columns else df

    return query


def dim_row_count_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """It joins no row, so it has one way only; here it runs over the skewed tables."""
    return star.dim_row_count(**Standins(spark, sf_dir, skewed=True).all)


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    clientes = Standins(spark, sf_dir).clientes
    return star.preview(clientes, "customerkey", "customer")


QUERIES: dict[str, Query] = {
    "scan_raw": scan_raw,
    "scan_raw_blank_lines": scan_raw_blank_lines,
    "raw_reject_count": raw_reject_count,
    "schema_from_header": schema_from_header,
    "normalise_columns": normalise_columns,
    "snapshot_stamp": snapshot_stamp,
    "stage_load": stage_load,
    "load_by_header": load_by_header,
    "register_table": register_table,
    "register_raw_table": register_raw_table,
    "scan_staged": scan_staged,
    "gold_sink": _gold(keep_blanks=False),
    "gold_sink_keep_blanks": _gold(keep_blanks=True),
    **{f"export_{entity}": _export(entity) for entity in ENTITIES},
    "export_reject_count": export_reject_count,
    "export_rejects": export_rejects,
    "clean_string": _sales_column("item", item=fn.clean_string),
    "blank_to_zero": _sales_column("list_price", list_price=fn.blank_to_zero),
    "parse_number_br": _sales_column("list_price", list_price=fn.parse_number_br),
    "parse_number_us": parse_number_us,
    "parse_date_br": _sales_column("invoice_date", invoice_date=fn.parse_date_br),
    "cast_date_iso": _sales_column(
        "promised_delivery_date", promised_delivery_date=fn.cast_date_iso
    ),
    "date_reject_count": date_reject_count,
    "number_reject_count": number_reject_count,
    "reject_rows": reject_rows,
    "fill_snapshot_date": fill_snapshot_date,
    "whitespace_to_token": _sales_column("item", item=fn.whitespace_to_token),
    "null_to_token": _sales_column("item", item=fn.null_to_token),
    "calendar_parts": calendar_parts,
    "concat_key": concat_key_query,
    "surrogate_key": surrogate_key,
    "join_customer": join_customer,
    "join_address": _lookup("address_number", "endereco"),
    "join_division": _lookup("division", "divisao"),
    "join_region": _lookup("region_code", "regiao"),
    "stage_join": stage_join,
    "stage_join_sql": stage_join_sql,
    "stage_view": stage_view,
    "stage_join_narrow": stage_join_narrow,
    **{f"conform_{entity}": _conform(entity) for entity in ENTITIES},
    "conform_vendas_iso": _conform("vendas", iso_dates=True),
    "conform_stage": conform_stage,
    "conform_narrow": conform_narrow,
    "keys_narrow": keys_narrow,
    "keys_wide": keys_wide,
    "dim_tempo": dim_tempo,
    "dim_clientes": dim_clientes,
    "dim_localidade": dim_localidade,
    "dim_cliente_division": dim_cliente_division,
    "dim_clientes_wide": dim_clientes_wide,
    "dim_clientes_wide_distinct": dim_clientes_wide_distinct,
    "dim_row_count": dim_row_count,
    "ft_vendas": ft_vendas,
    "ft_vendas_text": ft_vendas_text,
    "ft_vendas_with_keys": ft_vendas_with_keys,
    "preview": preview,
    "stage_join_salted": _salted(joins.stage_join),
    "stage_join_bucketed": stage_join_bucketed,
    "keys_wide_from_snapshots": keys_wide_from_snapshots,
    "keys_wide_salted": _salted(stage.wide_stage),
    "keys_narrow_salted": _salted(
        stage.narrow_stage, columns=["customerkey", "invoice_date", "sales_price", *NARROW_KEYS]
    ),
    "dim_localidade_salted": _salted(star.dim_localidade, "vendas", "clientes", "endereco"),
    "dim_row_count_salted": dim_row_count_salted,
    "ft_vendas_with_keys_salted": _salted(star.ft_vendas_with_keys),
    **{
        f"star_from_snapshots_{name}": _star_from_snapshots(name)
        for name in ("dim_tempo", "dim_clientes", "dim_localidade", "ft_vendas")
    },
    **{
        f"star_from_snapshots_{name}": _star_from_snapshots(name, wide=True)
        for name in ("dim_clientes_wide", "dim_cliente_division")
    },
}
