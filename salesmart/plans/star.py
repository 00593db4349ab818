"""Snapshots to the star schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from salesmart.operators import star
from salesmart.operators.joins import Ways, all_lookups, distinct_columns, of_column
from salesmart.operators.skew import AUTO
from salesmart.schemas import ENTITIES
from salesmart.session import prepare
from salesmart.sources.gold import write_gold
from salesmart.sources.published import Load, newest, published
from salesmart.sources.snapshots import ALL, LATEST, common_day, scan_loads, scan_staged

Tables = dict[str, DataFrame]


class Entities(Tables):
    """The five entities of a day, and what is known of their loads."""

    def __init__(self, tables: Tables, loads: Mapping[str, Load]):
        super().__init__(tables)
        self.loads = dict(loads)


def scan_entities(spark: SparkSession, stage_dir: str, dt_foto: str = LATEST) -> Tables:
    """All five entities of one snapshot day; by default the newest that all of them have."""
    paths = {entity: f"{stage_dir}/{entity}" for entity in ENTITIES}
    if dt_foto == ALL:
        return {entity: scan_staged(spark, paths[entity], schema, ALL) for entity, schema in ENTITIES.items()}
    days = {entity: newest(published(spark, path)) for entity, path in paths.items()}
    day = common_day(days) if dt_foto == LATEST else dt_foto
    missing = [entity for entity in ENTITIES if day not in days[entity]]
    if missing:
        raise FileNotFoundError(f"{day} is not loaded for {', '.join(missing)}")
    loads = {entity: days[entity][day] for entity in ENTITIES}
    tables = {
        entity: scan_loads(spark, paths[entity], schema, [loads[entity]])
        for entity, schema in ENTITIES.items()
    }
    return Entities(tables, loads)


def ways_to_join(tables: Tables, how: Ways = AUTO) -> Ways:
    """How to join, decided once for all tables of a run: what fits with all columns fits with few.

    For the entities of a scanned day the loads say what there is to know.
    """
    lookups = all_lookups(*[tables[e] for e in ("clientes", "endereco", "divisao", "regiao")])
    if isinstance(tables, Entities) and isinstance(how, str):
        return lookups.decided(tables.loads, how)
    return lookups.ways(how)


def narrow_star(
    tables: Tables,
    sep: str = "",
    how: Ways = AUTO,
    sold: DataFrame | None = None,
    dates: DataFrame | None = None,
) -> Tables:
    """Time, customer and place dimensions and the sales fact.

    Each table is planned from the few columns it needs. There is no joined stage to keep:
    the scans are columnar, and the dimensions drop repeats before anything is shuffled, so
    reading a column twice costs less than writing and reading back the whole joined stage.
    """
    sales, customers = tables["vendas"], tables["clientes"]
    ways = ways_to_join(tables, how)
    shared = {"how": ways, "sold": sold}
    return {
        "dim_tempo": star.dim_tempo(sales, sep, dates),
        "dim_clientes": star.dim_clientes(sales, customers, sep, **shared),
        "dim_localidade": star.dim_localidade(sales, customers, tables["endereco"], sep, **shared),
        "ft_vendas": star.ft_vendas(sales, sep),
    }


def wide_star(
    tables: Tables,
    sep: str = "",
    distinct: bool = False,
    how: Ways = AUTO,
    sold: DataFrame | None = None,
) -> Tables:
    """The wide customer dimension, and each sold customer with its division."""
    shared = {"how": ways_to_join(tables, how), "sold": sold}
    return {
        "dim_clientes_wide": star.dim_clientes_wide(**tables, sep=sep, distinct=distinct, **shared),
        "dim_cliente_division": star.dim_cliente_division(
            tables["vendas"], tables["clientes"], tables["divisao"], sep, **shared
        ),
    }


def write_star(tables: Tables, gold_dir: str, compression: str | None = None) -> None:
    for name, df in tables.items():
        write_gold(df, f"{gold_dir}/{name}", compression=compression)


def star_job(
    spark: SparkSession,
    stage_dir: str,
    gold_dir: str,
    dt_foto: str = LATEST,
    sep: str = "",
    how: Ways = AUTO,
    narrow: bool = True,
    wide: bool = False,
    wanted: Callable[[str], bool] = lambda name: True,
    compression: str | None = None,
) -> list[str]:
    """Write the star of one snapshot day, as plain text or compressed as asked; the names of the
    tables written.

    The sold customer keys and the invoice dates are worked out once, from one scan of the sales,
    and shared by the dimensions; the ways to join are decided once. The fact, which needs other
    columns of every sale, scans those.
    """
    tables = scan_entities(prepare(spark), stage_dir, dt_foto)
    ways = ways_to_join(tables, how)
    values = distinct_columns(tables["vendas"], "customerkey", "invoice_date").persist()
    sold, dates = of_column(values, "customerkey"), of_column(values, "invoice_date")
    try:
        made = narrow_star(tables, sep, ways, sold, dates) if narrow else {}
        made |= wide_star(tables, sep, how=ways, sold=sold) if wide else {}
        made = {name: df for name, df in made.items() if wanted(name)}
        write_star(made, gold_dir, compression)
    finally:
        values.unpersist()
    return list(made)
