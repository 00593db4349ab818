"""The joins of the star: sales to customers, customers to their lookups.

Read as written the joins are a chain that starts at the sales rows: customers, then
addresses, divisions and regions by columns that came with the customer. The last three
keys are customer columns, and an equality never holds for NULL, so the chain may be
bracketed the other way: look everything up on the customer side, then join once to the
sales. The rows are the same, repeated keys and missing matches included, but the sales
are shuffled once at most, and sales without a customer do not pile up under a NULL key.

How often a key occurs on either side of a join follows from counts of the base tables alone:
a customer row is there once for each match in the lookups joined before. So keys are counted
in the base tables, and the rows of `clientes` are weighted by their matches.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.operators.dense import PACKED, packed, texts_of, unpacked
from salesmart.operators.skew import (
    AUTO,
    BROADCAST,
    ROWS,
    SALTED,
    Heavy,
    broadcast_limit,
    heavy_keys,
    key_counts,
    salted_left_join,
    shuffle_partitions,
    way_to_join,
)
from salesmart.schemas import SNAPSHOT, STAGE
from salesmart.sources.published import FREQUENT, Load

# The sixteen columns of the narrow stage, in contract order.
NARROW = [
    "customerkey",
    "discount_amount",
    "invoice_date",
    "list_price",
    "sales_amount",
    "sales_amount_based_on_list_price",
    "sales_cost_amount",
    "sales_margin_amount",
    "sales_price",
    "sales_quantity",
    "data_foto",
    "address_number",
    "customer",
    "city",
    "country",
    "state",
]

# A way for all joins, or one for each key as `Lookups.ways` gives them.
Ways = str | Mapping[str, str]

# Which entity is looked up by which key of the customers.
LOOKUPS = {"address_number": "endereco", "division": "divisao", "region_code": "regiao"}

# What two hashed keys add to a customer row, in bytes with their words.
CLEANING_ADDS = 150

# The keys of the lookups, in the order in which customers are joined to them.
LOOKUP_KEYS = tuple(LOOKUPS)

# Columns that tell the rows of one key apart, where a side has them.
SPREAD_BY = ("invoice_number", "line_number", "invoice_date", "customerkey", "customer", "zip_code")


class Decided(dict[str, str]):
    """A way for each join, and the heavy keys of its sides as far as they are known already."""

    def __init__(self, ways: Mapping[str, str], heavy: Mapping[str, tuple[Heavy, Heavy | None]]):
        super().__init__(ways)
        self.heavy = dict(heavy)


def known_heavy(how: Ways, key: str) -> tuple[Heavy | None, Heavy | None]:
    return how.heavy.get(key, (None, None)) if isinstance(how, Decided) else (None, None)


def heavy_by_load(load: Load, key: str, partitions: int) -> Heavy | None:
    """What `heavy_keys` finds in a load's rows, from its entry; None if that lists too few keys."""
    frequent, even = load.frequent.get(key), max(load.rows / partitions, 1)
    if frequent is None or (len(frequent) >= FREQUENT and frequent[-1][1] > even):
        return None
    return [(value, math.ceil(rows / even)) for value, rows in frequent if rows > even]


def sales_columns(vendas: DataFrame) -> DataFrame:
    """Sales with their snapshot date under its stage name."""
    return vendas.withColumnRenamed(SNAPSHOT, "data_foto")


class Lookups:
    """Customers with the lookups they are joined to, and the counts of their keys."""

    def __init__(self, clientes: DataFrame, **lookups: DataFrame):
        """`lookups` by key: address_number, division, region_code; any may be left out."""
        self.clientes = clientes
        self.tables = {key: lookups[key] for key in LOOKUP_KEYS if key in lookups}
        self._heavy: dict[str, tuple[Heavy, Heavy]] = {}

    def ways(self, how: Ways = AUTO) -> Mapping[str, str]:
        """How to join each lookup, and the sales to the customers (`customerkey`).

        Under AUTO that measures the raw rows, one job for each side whose size the planner
        does not know. A run of several tables asks once and hands the answer down.
        """
        if not isinstance(how, str):
            return how
        found = {key: way_to_join(table.drop(SNAPSHOT), how) for key, table in self.tables.items()}
        return found | {"customerkey": way_to_join(self.rows(found), how, CLEANING_ADDS)}

    def decided(self, loads: Mapping[str, Load], how: str = AUTO) -> Decided:
        """The same by what is known of the loads of all five entities, and the heavy keys.

        Sizes and frequent keys were counted when the day was loaded, so nothing is counted here,
        but for two cases: customers that may or may not fit once they are joined to their lookups
        are measured, and where a lookup repeats keys, the heavy keys of the joined customers are
        left to be counted.
        """
        limit, partitions = broadcast_limit(self.clientes), shuffle_partitions(self.clientes)
        customers, most = loads["clientes"], {key: loads[LOOKUPS[key]].most(key) for key in self.tables}
        ways, heavy = {}, {}
        for key in self.tables:
            size = loads[LOOKUPS[key]].text_bytes()
            ways[key] = how if how != AUTO else BROADCAST if size <= limit else SALTED
        repeats = math.prod(max(1, n) for n in most.values())
        added = sum(sum(loads[LOOKUPS[k]].widest.values()) + 8 * len(loads[LOOKUPS[k]].widest) for k in self.tables)
        largest = repeats * (customers.text_bytes() + customers.rows * (added + CLEANING_ADDS))
        if how != AUTO:
            ways["customerkey"] = how
        elif largest <= limit:
            ways["customerkey"] = BROADCAST
        elif customers.text_bytes() > limit:
            ways["customerkey"] = SALTED
        else:
            ways["customerkey"] = way_to_join(self.rows(ways), how, CLEANING_ADDS)
        for key in self.tables:
            sides = heavy_by_load(customers, key, partitions), heavy_by_load(loads[LOOKUPS[key]], key, partitions)
            if None not in sides:
                heavy[key] = sides
            if most[key] > 1:
                break  # from here on customers are there once for each match
        whole = heavy_by_load(customers, "customerkey", partitions) if repeats == 1 else None
        heavy["customerkey"] = heavy_by_load(loads["vendas"], "customerkey", partitions), whole
        return Decided(ways, heavy)

    def rows(self, how: Ways = AUTO) -> DataFrame:
        """Every customer with the columns of its lookups."""
        found = self.clientes
        for key, table in self.tables.items():
            right = table.drop(SNAPSHOT)
            if way_to_join(right, how if isinstance(how, str) else how[key]) == SALTED:
                left, heavy = known_heavy(how, key)
                sides = self.heavy(key) if left is None or heavy is None else (left, heavy)
                found = salted_left_join(found, right, key, *sides, SPREAD_BY)
            else:
                found = found.join(F.broadcast(right), key, "left")
        return found

    def heavy(self, key: str) -> tuple[Heavy, Heavy]:
        """Heavy keys where a lookup is joined, on the left and on the right. For
        `customerkey`, where the customers are on the right, the left is not known here."""
        if not self._heavy:
            self._heavy = self._count_heavy()
        return self._heavy[key]

    def _count_heavy(self) -> dict[str, tuple[Heavy, Heavy]]:
        """One job for each side of each join, over the keys of the base tables."""
        partitions = shuffle_partitions(self.clientes)
        weighted = self.weighted().persist()
        try:
            found, weight = {}, F.lit(1)
            for key, table in self.tables.items():
                left = heavy_keys(key_counts(weighted, key, weight), key, partitions)
                found[key] = left, heavy_keys(key_counts(table, key), key, partitions)
                weight = weight * F.col(f"_{key}")
            customers = key_counts(weighted, "customerkey", weight)
            found["customerkey"] = [], heavy_keys(customers, "customerkey", partitions)
        finally:
            weighted.unpersist()
        return found

    def counts(self, key: str) -> DataFrame:
        """Rows for each `key` once all lookups are joined."""
        weight: Column = F.lit(1)
        for joined in self.tables:
            weight = weight * F.col(f"_{joined}")
        return key_counts(self.weighted(), key, weight)

    def weighted(self) -> DataFrame:
        """The keys of `clientes`, and for each lookup the number of rows it makes of a row.

        Only keys that a lookup has more than once matter, so those alone are joined, and a
        lookup without any costs one aggregation.
        """
        df = self.clientes.select(*dict.fromkeys(["customerkey", *self.tables]))
        for key, table in self.tables.items():
            repeated = key_counts(table, key).where(F.col(ROWS) > 1)
            df = df.join(repeated.withColumnRenamed(ROWS, f"_{key}"), key, "left")
        return df.withColumns({f"_{key}": F.coalesce(f"_{key}", F.lit(1)) for key in self.tables}) if self.tables else df


def all_lookups(clientes: DataFrame, endereco: DataFrame, divisao: DataFrame, regiao: DataFrame) -> Lookups:
    return Lookups(clientes, address_number=endereco, division=divisao, region_code=regiao)


def narrow_lookups(clientes: DataFrame, endereco: DataFrame, divisao: DataFrame, regiao: DataFrame) -> Lookups:
    """The lookups of the narrow stage.

    No division or region column is kept, but a lookup with a repeated key still repeats
    rows, so both stay joined, by their keys alone.
    """
    return all_lookups(
        clientes.select("customerkey", "address_number", "customer", "division", "region_code"),
        endereco.select("address_number", "city", "country", "state"),
        divisao.select("division"),
        regiao.select("region_code"),
    )


def join_customer(
    vendas: DataFrame,
    customers: DataFrame,
    lookups: Lookups,
    how: Ways = AUTO,
    unique_sales: bool = False,
    dense: bool = False,
) -> DataFrame:
    """Sales with their customers, which stem from `lookups`.

    Sales that have each key once are never salted. A way that is not decided yet is decided
    by the raw customers, so that their cleaning is not worked out for it. `dense` sales are
    shuffled with their text in one column, for callers that want all of their columns.
    """
    right = customers.drop(SNAPSHOT)
    if lookups.ways(how)["customerkey"] != SALTED:
        return vendas.join(F.broadcast(right), "customerkey", "left")
    heavy, heavy_customers = known_heavy(how, "customerkey")
    if unique_sales:
        heavy = []
    elif heavy is None:
        counts = key_counts(vendas, "customerkey")
        heavy = heavy_keys(counts, "customerkey", shuffle_partitions(vendas))
    if heavy_customers is None:
        heavy_customers = lookups.heavy("customerkey")[1]
    texts = texts_of(vendas, "customerkey") if dense else []
    if len(texts) < 2:
        return salted_left_join(vendas, right, "customerkey", heavy, heavy_customers, SPREAD_BY)
    joined = salted_left_join(packed(vendas, texts), right, "customerkey", heavy, heavy_customers, (*SPREAD_BY, PACKED))
    return unpacked(joined, texts)


def join_address(clientes: DataFrame, endereco: DataFrame, how: Ways = AUTO) -> DataFrame:
    return Lookups(clientes, address_number=endereco).rows(how)


def join_division(clientes: DataFrame, divisao: DataFrame, how: Ways = AUTO) -> DataFrame:
    return Lookups(clientes, division=divisao).rows(how)


def join_region(clientes: DataFrame, regiao: DataFrame, how: Ways = AUTO) -> DataFrame:
    return Lookups(clientes, region_code=regiao).rows(how)


def customers_with_lookups(
    clientes: DataFrame, endereco: DataFrame, divisao: DataFrame, regiao: DataFrame, how: Ways = AUTO
) -> DataFrame:
    """Every customer with address, division and region."""
    return all_lookups(clientes, endereco, divisao, regiao).rows(how)


def stage_join(
    vendas: DataFrame,
    clientes: DataFrame,
    endereco: DataFrame,
    divisao: DataFrame,
    regiao: DataFrame,
    how: Ways = AUTO,
    dense: bool = True,
) -> DataFrame:
    """The wide stage, 43 columns, values as they arrived. Callers that want few of them do better
    with sales that are not `dense`."""
    lookups = all_lookups(clientes, endereco, divisao, regiao)
    ways = lookups.ways(how)
    return join_customer(sales_columns(vendas), lookups.rows(ways), lookups, ways, dense=dense).select(*STAGE.names)


def stage_join_narrow(
    vendas: DataFrame,
    clientes: DataFrame,
    endereco: DataFrame,
    divisao: DataFrame,
    regiao: DataFrame,
    how: Ways = AUTO,
) -> DataFrame:
    """The narrow stage, 16 columns, values as they arrived."""
    lookups = narrow_lookups(clientes, endereco, divisao, regiao)
    ways = lookups.ways(how)
    return join_customer(sales_columns(vendas), lookups.rows(ways), lookups, ways).select(*NARROW)


def distinct_columns(df: DataFrame, *names: str) -> DataFrame:
    """The distinct values of each of the columns, from one scan: rows with `_column`, the name of
    the column that a value belongs to, and the value in that column. `of_column` takes them apart.

    Repeats are removed within each task before anything is shuffled.
    """
    sets = df.groupingSets([[F.col(n)] for n in names], *[F.col(n) for n in names])
    # A set's number has a 0 in the place of its column, the last column's place being the lowest.
    every = 2 ** len(names) - 1
    numbers = {every - 2**i: name for i, name in enumerate(reversed(names))}
    which = reduce(
        lambda case, item: case.when(F.col("_set") == item[0], item[1]), numbers.items(), F.when(F.lit(False), "")
    )
    return sets.agg(F.grouping_id().alias("_set")).select(which.alias("_column"), *names)


def of_column(values: DataFrame, name: str) -> DataFrame:
    """One column's values of `distinct_columns`."""
    return values.where(F.col("_column") == name).select(name)


def sold_keys(vendas: DataFrame) -> DataFrame:
    """Each customer key found in the sales, once.

    Repeats of a key are removed within each task first, so however often a key was sold it is
    shuffled once per task.
    """
    return vendas.select("customerkey").distinct()
