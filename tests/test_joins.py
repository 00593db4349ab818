"""Joins under skew, and the stages against the plain chain of joins."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from salesmart.operators import conform, dense, joins, keys, stage, star
from salesmart.operators.skew import (
    BROADCAST,
    SALTED,
    broadcast_limit,
    fits_broadcast,
    heavy_keys,
    key_counts,
    left_join,
    measured_bytes,
    way_to_join,
)
from salesmart.operators.skew import salted_left_join as salted_join
from salesmart.schemas import STAGE
from verification.standins import Standins

SF_DIR = "/root/testdata/sf0.001"


def salted_left_join(left, right, key, partitions, spread_by=()):
    heavy = [heavy_keys(key_counts(df, key), key, partitions) for df in (left, right)]
    return salted_join(left, right, key, *heavy, spread_by)


def same_rows(a, b):
    b = b.select(*a.columns)
    assert a.dtypes == b.dtypes
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture
def no_broadcast(spark):
    limit = "autoBroadcastJoinThreshold"
    names = [f"spark.sql.{limit}", f"spark.sql.adaptive.{limit}"]
    kept = {name: spark.conf.get(name, None) for name in names}
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name, value in kept.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the sales under one key, a third under NULL; the rest spread out."""
    key = (
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None)
        .otherwise((F.col("id") % 500).cast("string"))
    )
    left = spark.range(6000).select(key.alias("key"), F.col("id").alias("sale"))
    # Keys 0 to 249 once, 'hot' twice, and a third of the rows under a key sold once.
    right = spark.range(251).select(F.col("id").cast("string").alias("key"), F.col("id").alias("r"))
    twice = spark.range(2).select(F.lit("hot").alias("key"), F.col("id").alias("r"))
    pile = spark.range(120).select(F.lit("8").alias("key"), (F.col("id") + 1000).alias("r"))
    return left, right.union(twice).union(pile)


def test_heavy_keys_are_few_and_get_enough_salts(spark, skewed):
    left, right = skewed
    assert dict(heavy_keys(key_counts(left, "key"), "key", 16)) == {"hot": 6, None: 6}
    assert {k for k, _ in heavy_keys(key_counts(right, "key"), "key", 16)} == {"8"}
    even = spark.range(1000).select((F.col("id") % 10).alias("key"))
    assert heavy_keys(key_counts(even, "key"), "key", 10) == []


@pytest.mark.parametrize("partitions", [2, 16, 64])
def test_salted_join_gives_the_rows_of_the_plain_join(skewed, partitions):
    left, right = skewed
    same_rows(salted_left_join(left, right, "key", partitions), left.join(right, "key", "left"))


def test_salted_join_with_one_key_heavy_on_both_sides(spark, skewed):
    left, right = skewed
    hot = spark.range(90).select(F.lit("hot").alias("key"), (F.col("id") + 5000).alias("r"))
    right = right.union(hot)
    assert {k for k, _ in heavy_keys(key_counts(right, "key"), "key", 16)} == {"8", "hot"}
    same_rows(salted_left_join(left, right, "key", 16), left.join(right, "key", "left"))


def test_a_side_with_each_key_once_needs_no_salts(spark, skewed):
    left, right = skewed
    keys = left.select("key").distinct()
    heavy = heavy_keys(key_counts(right, "key"), "key", 16)
    same_rows(salted_join(keys, right, "key", [], heavy), keys.join(right, "key", "left"))
    once = right.groupBy("key").agg(F.min("r").alias("r"))
    joined = salted_join(left, once, "key", heavy_keys(key_counts(left, "key"), "key", 16), [])
    same_rows(joined, left.join(once, "key", "left"))
    plan = left_join(keys, once, "key", how=SALTED)._jdf.queryExecution().optimizedPlan().toString()
    assert "salt" not in plan
    with pytest.raises(ValueError):
        way_to_join(right, "shuffled")


def test_salted_join_with_an_empty_side(skewed):
    left, right = skewed
    none = right.where("false")
    same_rows(salted_left_join(left, none, "key", 8), left.join(none, "key", "left"))
    nothing = left.where("false")
    assert salted_left_join(nothing, right, "key", 8).count() == 0


def test_broadcast_limit_reads_the_setting(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    kept = spark.conf.get(name)
    try:
        for text, limit in (("-1", -1), ("1000", 1000), ("10MB", 10 * 2**20), ("3k", 3072), ("7b", 7)):
            spark.conf.set(name, text)
            assert broadcast_limit(spark.range(1)) == limit
    finally:
        spark.conf.set(name, kept)


def test_left_join_broadcasts_by_size_only(spark, skewed, tmp_path):
    left, right = skewed
    right.write.parquet(str(tmp_path / "right"))
    stored = spark.read.parquet(str(tmp_path / "right"))
    assert "BroadcastHashJoin" in left_join(left, stored, "key")._jdf.queryExecution().toString()
    joined = stored.join(stored.withColumnRenamed("r", "r2"), "key")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        size = measured_bytes(joined)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(size))
        assert fits_broadcast(joined)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(size - 1))
        assert not fits_broadcast(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_a_third_of_equal_rows_is_spread(spark, no_broadcast):
    """Rows that are copies of each other, under one key: no partition gets them all."""
    rest = (F.col("id") % 1000).cast("string")
    left = spark.range(0, 60000, numPartitions=24).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(rest).alias("key")
    )
    right = spark.range(1000).select(F.col("id").cast("string").alias("key"), "id")
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:

        def largest(df):
            sizes = df.groupBy(F.spark_partition_id().alias("p")).count()
            return sizes.agg(F.max("count")).first()[0]

        assert largest(left.join(right, "key", "left")) > 20000
        salted = salted_left_join(left, right, "key", 64)
        assert largest(salted) < 16000
        assert salted.count() == 60000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)


@pytest.fixture(scope="module")
def tables(spark):
    return {name: df.persist() for name, df in Standins(spark, SF_DIR).all.items()}


def chain(t):
    """The stage as it reads: one left join after the other, from the sales on."""
    sales = t["vendas"].withColumnRenamed("dt_foto", "data_foto")
    return (
        sales.join(t["clientes"].drop("dt_foto"), "customerkey", "left")
        .join(t["endereco"].drop("dt_foto"), "address_number", "left")
        .join(t["divisao"].drop("dt_foto"), "division", "left")
        .join(t["regiao"].drop("dt_foto"), "region_code", "left")
    )


def test_stage_join_is_the_chain(tables):
    same_rows(joins.stage_join(**tables), chain(tables).select(*STAGE.names))
    same_rows(joins.stage_join_narrow(**tables), chain(tables).select(*joins.NARROW))


def test_stage_join_without_broadcast_is_the_chain(tables, no_broadcast):
    df = joins.stage_join(**tables)
    assert "SortMergeJoin" in df._jdf.queryExecution().toString()
    same_rows(df, chain(tables).select(*STAGE.names))


@pytest.fixture(scope="module")
def skewed_tables(spark):
    return {name: df.persist() for name, df in Standins(spark, SF_DIR, skewed=True).all.items()}


def test_ways_give_the_same_rows_under_skew(skewed_tables):
    expected = chain(skewed_tables).select(*STAGE.names)
    for how in (SALTED, BROADCAST):
        same_rows(joins.stage_join(**skewed_tables, how=how), expected)


def test_weights_are_the_rows_that_lookups_make(skewed_tables):
    t = {name: skewed_tables[name] for name in ("clientes", "endereco", "divisao", "regiao")}
    lookups = joins.all_lookups(**t)
    for key in ("customerkey", *joins.LOOKUP_KEYS):
        same_rows(lookups.counts(key), key_counts(lookups.rows(), key))
    found = {r[0]: r[1] for r in lookups.counts("customerkey").collect()}
    assert found["8"] % 3 == 0 and found["9"] % 40 == 0


def jobs_of(spark, name, build):
    """The DataFrame that build makes, and how many jobs making it ran."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        df = build()
        return df, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_plans_beyond_broadcast_stay_small(spark, no_broadcast):
    """No more scans and exchanges than the plain chain of joins has."""
    t = Standins(spark, SF_DIR).all
    made = {
        "count": (lambda: star.dim_row_count(**t), 0),
        "clients": (lambda: star.dim_clientes(t["vendas"], t["clientes"]), 1),
        "wide": (lambda: stage.wide_stage(**t), 8),
    }
    plain = size_of_plan(chain(t))
    for name, (build, counting) in made.items():
        df, jobs = jobs_of(spark, name, build)
        # A job that counts has a stage for the counts of each table, some of them reused.
        assert jobs <= 4 * counting, (name, jobs)
        assert all(a <= b for a, b in zip(size_of_plan(df), plain, strict=True)), (name, size_of_plan(df))


def size_of_plan(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("FileScan"), plan.count("Exchange hashpartitioning")


def test_stages_are_the_operators_in_order(tables):
    raw = joins.stage_join(**tables)
    cleaned = keys.with_calendar(conform.conform_stage(raw))
    same_rows(stage.wide_stage(**tables), keys.with_wide_keys(cleaned))
    same_rows(stage.wide_stage(**tables, sep="|"), keys.with_wide_keys(cleaned, "|"))

    narrow = joins.stage_join_narrow(**tables)
    dated = narrow.withColumn("invoice_date", stage.parse_date_br(F.col("invoice_date")))
    keyed = keys.with_narrow_keys(keys.with_calendar(dated), "|")
    same_rows(stage.narrow_stage(**tables, sep="|"), conform.conform_narrow(keyed))


def test_star_is_distinct_over_the_stage(tables):
    t = tables
    narrow = stage.narrow_stage(**t, sep="|", token="?")
    wide = stage.wide_stage(**t, sep="|")
    place = ["DW_LOCALIDADE", "address_number", "city", "state", "country"]
    same_rows(
        star.dim_localidade(t["vendas"], t["clientes"], t["endereco"], "|", "?"),
        narrow.select(*place).distinct(),
    )
    same_rows(
        star.dim_clientes(t["vendas"], t["clientes"], "|", "?"),
        narrow.select("DW_CLIENTES", "customerkey", "customer").distinct(),
    )
    same_rows(
        star.dim_cliente_division(t["vendas"], t["clientes"], t["divisao"], "|"),
        wide.select("DW_CLIENTES", "customerkey", "customer", "division_name").distinct(),
    )
    same_rows(
        star.dim_clientes_wide(**t, sep="|", distinct=True),
        wide.select(*star.WIDE_CUSTOMER).distinct(),
    )
    assert star.dim_row_count(**t).first()[0] == wide.count()


def test_fact_keys_lead_to_the_dimensions(tables):
    t = tables
    fact = star.ft_vendas_with_keys(**t)
    time = star.dim_tempo(t["vendas"])
    place = star.dim_localidade(t["vendas"], t["clientes"], t["endereco"])
    customer = star.dim_clientes(t["vendas"], t["clientes"])
    assert fact.join(time, "DW_TEMPO", "left_anti").isEmpty()
    assert fact.join(place, "DW_LOCALIDADE", "left_anti").isEmpty()
    assert fact.join(customer, "DW_CLIENTES", "left_anti").isEmpty()
    same_rows(
        fact.select("DW_VENDAS", *star.MEASURES).distinct(), star.ft_vendas(t["vendas"])
    )


def test_packed_texts_come_out_as_they_were(spark):
    texts = ["", "x", None, "a\x1fb", "\x1e", "\x1en", "\x1ex", "\x1exn\x1f", "é ", "\x00", "  "]
    rows = [(i, a, b, None if i % 2 else 1.5) for i, (a, b) in enumerate((a, b) for a in texts for b in texts)]
    df = spark.createDataFrame(rows, "i int, a string, b string, n double")
    # Bytes that are no UTF-8, alone and next to others that would complete them.
    odd = df.limit(1).select("i", F.unhex(F.lit("C3")).cast("string").alias("a"), F.unhex(F.lit("A9FF")).cast("string").alias("b"), "n")
    df = df.union(odd)
    names = dense.texts_of(df)
    back = dense.unpacked(dense.packed(df, names), names)
    assert names == ["a", "b"] and dense.packed(df, names).columns == ["i", "n", dense.PACKED]
    hexed = [F.hex("a").alias("a"), F.hex("b").alias("b"), "i", "n"]
    same_rows(back.select(*hexed), df.select(*hexed))


def test_sales_of_the_stage_are_shuffled_as_one_text(spark, no_broadcast):
    """Where customers are no broadcast, no text of the sales but the key is a column of the shuffle;
    views, of which a query may want few columns, move those alone."""
    t = Standins(spark, SF_DIR, skewed=True).all
    sales = {"item", "invoice_number", "u_m"}

    def shuffled(df):
        plan = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        inputs = re.findall(r"^\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]", plan, re.M)
        return [{re.sub(r"#.*", "", c.strip()) for c in columns.split(",")} for columns in inputs]

    for df in (joins.stage_join(**t), stage.wide_stage(**t)):
        assert not any(columns & sales for columns in shuffled(df))
        assert [columns for columns in shuffled(df) if dense.PACKED in columns]
    few = shuffled(joins.stage_join(**t, dense=False).select("item", "city"))
    assert [columns & sales for columns in few if columns & sales] == [{"item"}]


def test_rows_of_the_fact_with_keys_lie_by_customer(spark, skewed_tables, no_broadcast):
    """Beyond a broadcast they are dealt out in the order of customers, and are those of the plain way.
    Keys that are missing in two ways, and keys that run into each other, give one row where all is equal."""
    by_size = star.ft_vendas_with_keys(**skewed_tables, how=BROADCAST)
    dealt = star.ft_vendas_with_keys(**skewed_tables, how=SALTED)
    assert "rangepartitioning(DW_CLIENTES" in dealt._jdf.queryExecution().toString()
    same_rows(dealt, by_size)

    def table(columns, rows):
        return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))

    sale = dict.fromkeys(star.MEASURES, "1") | {"invoice_date": None, "dt_foto": "20240101"}
    sales = [(None, "1"), ("", "1"), ("1", "0005"), ("10", "005"), ("a", "2"), ("a", "2")]
    vendas = table([*sale, "customerkey"], [(*(sale | {"sales_price": p}).values(), k) for k, p in sales])
    clientes = table(
        ["customerkey", "address_number", "customer", "division", "region_code", "dt_foto"],
        [("1", "02", "0x", "d", "r", "t"), ("10", "2", "x", "d", "r", "t"), ("a", "9", "y", None, None, "t"), (None, "9", "z", "d", "r", "t")],
    )
    endereco = table(["address_number", "city", "country", "state", "dt_foto"], [("9", str(i), "c", "s", "t") for i in range(40)])
    divisao, regiao = table(["division", "dt_foto"], [("d", "t")] * 2), table(["region_code", "dt_foto"], [("r", "t")])
    entities = {"vendas": vendas, "clientes": clientes, "endereco": endereco, "divisao": divisao, "regiao": regiao}
    few = [star.ft_vendas_with_keys(**entities, how=how) for how in (SALTED, BROADCAST)]
    same_rows(*few)
    assert few[0].count() == 3 and few[0].distinct().count() == 3
