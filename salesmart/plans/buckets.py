"""Sales and customers kept in buckets of the customer key, so that joining them moves no sale.

For customers beyond a broadcast, a day's sales and customers are written once as tables in equal
buckets by `customerkey`; every later join of the two reads bucket by bucket. A key with more
sales than an even bucket has would make its bucket the slow one, and sales without a key would
all lie in one. Both are kept apart, in files as they come, and meet the few customers with such
a key by broadcast, or salted where those are many.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators.joins import SPREAD_BY, all_lookups, heavy_by_load, sales_columns
from salesmart.operators.skew import BROADCAST, SALTED, Heavy, broadcast_limit, heavy_keys, key_counts, left_join, measured_bytes
from salesmart.plans.star import Entities, Tables, ways_to_join
from salesmart.schemas import SNAPSHOT, STAGE

KEY = "customerkey"


@dataclass(frozen=True)
class Bucketed:
    """Tables of one day: sales and customers in buckets, and the sales kept apart."""

    sales: str
    apart: str
    customers: str
    heavy: list[str]


def _is_apart(heavy: list[str]) -> Column:
    return F.col(KEY).isNull() | F.col(KEY).isin(heavy) if heavy else F.col(KEY).isNull()


def write_buckets(spark: SparkSession, tables: Tables, database: str, name: str, path: str, buckets: int) -> Bucketed:
    """Write the sales and customers of `tables` as such tables below a path, registered in a
    database; tables of the same name are replaced.

    Which keys are heavy was counted when the day was loaded; only tables that come without
    their loads are counted here.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    found: Heavy | None = None
    if isinstance(tables, Entities):
        found = heavy_by_load(tables.loads["vendas"], KEY, buckets)
    if found is None:
        found = heavy_keys(key_counts(tables["vendas"], KEY), KEY, buckets)
    heavy = [value for value, _ in found if value is not None]
    made = Bucketed(f"{database}.{name}_vendas", f"{database}.{name}_vendas_apart", f"{database}.{name}_clientes", heavy)
    apart = _is_apart(heavy)
    _save(tables["vendas"].where(~apart), made.sales, f"{path}/vendas", buckets)
    _save(tables["vendas"].where(apart), made.apart, f"{path}/vendas_apart")
    _save(tables["clientes"], made.customers, f"{path}/clientes", buckets)
    return made


def _save(df: DataFrame, table: str, path: str, buckets: int | None = None) -> None:
    """One sorted file for each bucket: rows are dealt out as the buckets are before they are written."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    if buckets is None:
        writer = df.write
    else:
        writer = df.repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(KEY)
    writer.format("orc").option("path", path).mode("overwrite").saveAsTable(table)


def stage_join_bucketed(spark: SparkSession, buckets: Bucketed, lookups: Mapping[str, DataFrame], how: str) -> DataFrame:
    """The wide stage, values as they arrived: the rows of `stage_join`.

    `lookups` has endereco, divisao and regiao. Lookups that are broadcast leave the customers in
    their buckets, so neither customers nor sales move; other lookups move customers alone.
    """
    clientes = spark.table(buckets.customers)
    entities = {"clientes": clientes, "vendas": spark.table(buckets.sales), **lookups}
    ways = ways_to_join(entities, how)
    customers = all_lookups(clientes, *[lookups[e] for e in ("endereco", "divisao", "regiao")]).rows(ways).drop(SNAPSHOT)
    sales, apart = sales_columns(spark.table(buckets.sales)), sales_columns(spark.table(buckets.apart))
    if ways[KEY] == BROADCAST:
        return sales.union(apart).join(F.broadcast(customers), KEY, "left").select(*STAGE.names)
    met = sales.join(customers.hint("merge"), KEY, "left")
    few = customers.where(F.col(KEY).isin(buckets.heavy)) if buckets.heavy else customers.where("false")
    # The planner takes the few for as many as all customers, so they are measured.
    if measured_bytes(few) <= broadcast_limit(few):
        rest = left_join(apart, few, KEY, how=BROADCAST)
    else:
        counts = [key_counts(df, KEY) for df in (apart, few)]
        rest = left_join(apart, few, KEY, how=SALTED, left_counts=counts[0], right_counts=counts[1], spread_by=SPREAD_BY)
    return met.select(*STAGE.names).union(rest.select(*STAGE.names))
