"""Entities and the stage as views, for queries in SQL text."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators.joins import LOOKUPS, NARROW, Ways, stage_join, stage_join_narrow
from salesmart.operators.skew import AUTO, fits_broadcast
from salesmart.schemas import ENTITIES, SNAPSHOT, STAGE

STAGE_VIEW = "stage"
NARROW_VIEW = "stage_narrow"


def is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).isTemporary


def _marked(entity: str, df: DataFrame) -> DataFrame:
    """What sales are joined to, marked for a broadcast where it fits, measured however much it reads."""
    return F.broadcast(df) if entity != "vendas" and fits_broadcast(df, measure_up_to=sys.maxsize) else df


@contextmanager
def session_views(
    spark: SparkSession, tables: Mapping[str, DataFrame], prefix: str = "", how: Ways = AUTO, replace: bool = False
) -> Iterator[dict[str, str]]:
    """Views of the entities, of the wide stage (`stage`) and of the narrow one (`stage_narrow`),
    values as they arrived; their names by what they hold.

    The stage views are the library's own joins, so SQL over them is planned as they are: what a
    query does not use is not joined or read where that changes no row. Entities that fit a
    broadcast are marked for it, as the planner takes a DISTINCT for as large as what it reads and
    would move the sales for each of them. They are dropped at the end; results made within stay
    usable. A view of the session with such a name is not replaced unless asked.
    """
    views = {entity: _marked(entity, df) for entity, df in tables.items()}
    views[STAGE_VIEW] = stage_join(**tables, how=how, dense=False)
    views[NARROW_VIEW] = stage_join_narrow(**tables, how=how)
    names = {view: f"{prefix}{view}" for view in views}
    taken = [name for name in names.values() if is_view(spark, name)]
    if taken and not replace:
        raise ValueError(f"there are views named {', '.join(taken)}")
    made = []
    try:
        for view, df in views.items():
            df.createOrReplaceTempView(names[view])
            made.append(names[view])
        yield names
    finally:
        for name in made:
            spark.catalog.dropTempView(name)


def stage_sql(names: Mapping[str, str], columns: list[str] | None = None) -> str:
    """The stage as SQL text over views of the entities: the chain of left joins as it reads."""
    held = {"vendas": "sales", "clientes": "customers", **{entity: entity for entity in LOOKUPS.values()}}

    def source(name: str) -> str:
        if name == "data_foto":
            return f"{held['vendas']}.{SNAPSHOT} AS {name}"
        return f"{held[next(entity for entity in held if name in ENTITIES[entity].names)]}.{name}"

    chain = [f"{names['vendas']} AS {held['vendas']}"]
    chain += [f"{names['clientes']} AS {held['clientes']} ON {held['clientes']}.customerkey = {held['vendas']}.customerkey"]
    chain += [f"{names[e]} AS {held[e]} ON {held[e]}.{key} = {held['clientes']}.{key}" for key, e in LOOKUPS.items()]
    selected = ", ".join(source(name) for name in columns or STAGE.names)
    return f"SELECT {selected} FROM {' LEFT JOIN '.join(chain)}"


def narrow_stage_sql(names: Mapping[str, str]) -> str:
    return stage_sql(names, NARROW)
