"""Joins decided by what loads tell, sales in buckets, views, rejects, one scan for the dimensions."""

from __future__ import annotations

import re
import uuid

import pytest
from pyspark.sql import functions as F

from salesmart.operators import conform, joins, skew, stage
from salesmart.operators.joins import Decided, distinct_columns, heavy_by_load, of_column
from salesmart.operators.skew import BROADCAST, SALTED, heavy_keys, key_counts, salted_left_join
from salesmart.plans import buckets, star, views
from salesmart.plans.export import export_entity
from salesmart.schemas import ENTITIES, JOIN_KEYS, STAGE
from salesmart.sources import published, snapshots
from salesmart.sources.gold import read_gold
from tests.test_joins import no_broadcast, same_rows  # noqa: F401
from tests.test_plans import RUN, physical_plan
from verification.standins import Standins

SF_DIR = "/root/testdata/sf0.001"
LIMIT = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture(scope="module")
def stage_dir(spark, tmp_path_factory):
    """The skewed tables loaded as a day."""
    folder = str(tmp_path_factory.mktemp("loaded"))
    for entity, df in Standins(spark, SF_DIR, skewed=True).all.items():
        snapshots.write_snapshot(df.repartition(4), f"{folder}/{entity}", RUN, JOIN_KEYS[entity])
    return folder


def jobs_of(spark, make):
    """What `make` gives, and how many jobs it ran."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "")
    try:
        made = make()
        return made, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_small_lookups_are_known_without_a_job(spark, stage_dir):
    tables = star.scan_entities(spark, stage_dir)
    ways, jobs = jobs_of(spark, lambda: star.ways_to_join(tables))
    assert isinstance(ways, Decided) and set(ways.values()) == {BROADCAST} and jobs == 0
    df, jobs = jobs_of(spark, lambda: stage.wide_stage(**tables, how=ways))
    assert jobs == 0 and "Exchange" not in re.sub("BroadcastExchange", "", physical_plan(df))


def test_large_tables_are_planned_without_counting_sales(spark, stage_dir, no_broadcast):  # noqa: F811
    tables = star.scan_entities(spark, stage_dir)
    ways, jobs = jobs_of(spark, lambda: star.ways_to_join(tables))
    assert set(ways.values()) == {SALTED} and jobs == 0
    partitions = skew.shuffle_partitions(tables["vendas"])
    heavy, whole = ways.heavy["customerkey"]
    assert dict(heavy) == dict(heavy_keys(key_counts(tables["vendas"], "customerkey"), "customerkey", partitions))
    assert whole is None and set(ways.heavy) == {"address_number", "customerkey"}  # addresses repeat keys
    same_rows(joins.stage_join(**tables, how=ways), joins.stage_join(**tables, how=BROADCAST))


def test_keys_that_lookups_have_once_need_no_job_at_all(spark, tmp_path, no_broadcast):  # noqa: F811
    for entity, df in Standins(spark, SF_DIR, skewed=True).all.items():
        once = df if entity == "vendas" else df.dropDuplicates(JOIN_KEYS[entity][:1])
        snapshots.write_snapshot(once, str(tmp_path / entity), RUN, JOIN_KEYS[entity])
    tables = star.scan_entities(spark, str(tmp_path))
    (ways, df), jobs = jobs_of(spark, lambda: (w := star.ways_to_join(tables), joins.stage_join(**tables, how=w)))
    assert jobs == 0 and set(ways.heavy) == {*joins.LOOKUP_KEYS, "customerkey"} and ways.heavy["customerkey"][1] is not None
    same_rows(df, joins.stage_join(**tables, how=BROADCAST))


def test_customers_in_between_are_measured(spark, stage_dir):
    tables, kept = star.scan_entities(spark, stage_dir), spark.conf.get(LIMIT)
    size = skew.measured_bytes(joins.all_lookups(*[tables[e] for e in ("clientes", "endereco", "divisao", "regiao")]).rows(BROADCAST))
    try:
        for limit, way in ((size + 10**6, BROADCAST), (tables.loads["clientes"].text_bytes() - 1, SALTED)):
            spark.conf.set(LIMIT, str(limit))
            assert star.ways_to_join(tables)["customerkey"] == way
    finally:
        spark.conf.set(LIMIT, kept)


def test_heavy_keys_that_an_entry_does_not_list(monkeypatch):
    load = published.Load(1, "x", rows=1000, frequent={"k": [("a", 500), (None, 300), ("b", 2)]})
    assert heavy_by_load(load, "k", 4) == [("a", 2), (None, 2)]
    assert heavy_by_load(load, "other", 4) is None
    monkeypatch.setattr(joins, "FREQUENT", 3)
    assert heavy_by_load(load, "k", 4) == [("a", 2), (None, 2)]
    assert heavy_by_load(load, "k", 1000) is None  # a fourth key could have two rows as well


def test_many_right_rows_without_a_key_lose_no_left_row(spark):
    left = spark.range(60).select(F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id") % 5).cast("string").alias("key"), "id")
    right = spark.range(90).select(F.when(F.col("id") > 5, F.lit(None)).otherwise(F.col("id")).cast("string").alias("key"), F.col("id").alias("r"))
    heavy = heavy_keys(key_counts(right, "key"), "key", 8)
    assert heavy[0][0] is None
    same_rows(salted_left_join(left, right, "key", [], heavy), left.join(right, "key", "left"))


def test_distinct_columns_take_one_scan(spark, tmp_path):
    rows = [("a", 1, None), ("a", 2, "x"), (None, 1, "x"), ("b", None, "")] * 5
    spark.createDataFrame(rows, "p string, q int, r string").write.orc(str(tmp_path / "t"))
    df = spark.read.orc(str(tmp_path / "t"))
    values = distinct_columns(df, "p", "q", "r")
    assert len(re.findall(r"\(\d+\) Scan orc", physical_plan(values))) == 1
    for name in df.columns:
        same_rows(of_column(values, name), df.select(name).distinct())


def test_star_scans_the_sales_twice(spark, stage_dir, tmp_path):
    """Once for customers and dates together, once for the fact."""
    tables = star.scan_entities(spark, stage_dir)
    values = distinct_columns(tables["vendas"], "customerkey", "invoice_date")
    made = star.narrow_star(tables, sold=of_column(values, "customerkey"), dates=of_column(values, "invoice_date"))
    alone = star.narrow_star(tables)
    for name in made:
        same_rows(made[name], alone[name])
    assert "dim_tempo" in star.star_job(spark, stage_dir, str(tmp_path))
    same_rows(read_gold(spark, f"{tmp_path}/dim_tempo", made["dim_tempo"].schema), alone["dim_tempo"])


def test_bucketed_sales_do_not_move(spark, stage_dir, tmp_path, no_broadcast):  # noqa: F811
    tables = star.scan_entities(spark, stage_dir)
    lookups = {e: tables[e] for e in ("endereco", "divisao", "regiao")}
    kept, jobs = jobs_of(spark, lambda: buckets.write_buckets(spark, tables, "bucket_test", "d", str(tmp_path), 8))
    assert kept.heavy == ["8"] and jobs <= 5
    df = buckets.stage_join_bucketed(spark, kept, lookups, BROADCAST)
    expected = joins.stage_join(**tables, how=BROADCAST)
    same_rows(df, expected)
    same_rows(buckets.stage_join_bucketed(spark, kept, lookups, SALTED), expected)
    # Lookups broadcast, customers not: the sales in buckets are read, sorted and merged.
    ways = Decided({key: BROADCAST for key in joins.LOOKUP_KEYS} | {"customerkey": SALTED}, {})
    customers = joins.all_lookups(spark.table(kept.customers), *lookups.values()).rows(ways)
    met = spark.table(kept.sales).join(customers.drop("dt_foto").hint("merge"), "customerkey", "left")
    plan = physical_plan(met)
    assert "SortMergeJoin" in plan and not re.findall(r"^\(\d+\) Exchange", plan, re.M)
    apart = spark.table(kept.apart)
    assert apart.where("customerkey is not null and customerkey <> '8'").isEmpty() and apart.count() > 100
    spark.sql("DROP DATABASE bucket_test CASCADE")


def test_a_few_customers_with_heavy_keys_repeat_no_sales(spark, tmp_path, monkeypatch):
    """A key's rows are dealt to no more salts than there are rows, and the few customers that the
    sales kept apart have are broadcast, whatever the planner takes them for."""
    few = spark.createDataFrame([("a",)] * 3 + [("b",)], "key string")
    assert heavy_keys(key_counts(few, "key"), "key", 200) == [("a", 3)]
    load = published.Load(1, "f", rows=4, frequent={"key": [("a", 3), ("b", 1)]})
    assert heavy_by_load(load, "key", 200) == [("a", 3)]
    tables = Standins(spark, SF_DIR, skewed=True).all
    kept = buckets.write_buckets(spark, tables, "bucket_few", "d", str(tmp_path), 8)
    lookups = {e: tables[e] for e in ("endereco", "divisao", "regiao")}
    before, join, how = spark.conf.get(LIMIT), buckets.left_join, []
    monkeypatch.setattr(buckets, "left_join", lambda *a, **k: how.append(k["how"]) or join(*a, **k))
    spark.conf.set(LIMIT, "20000")  # less than all customers, more than those of a few keys
    try:
        df = buckets.stage_join_bucketed(spark, kept, lookups, SALTED)
        assert how == [BROADCAST]
        same_rows(df, joins.stage_join(**tables, how=BROADCAST))
    finally:
        spark.conf.set(LIMIT, before)
        spark.sql("DROP DATABASE bucket_few CASCADE")


def test_small_views_do_not_move_the_sales(spark):
    """Distinct lookups of a few rows are broadcast, though the planner takes them for large."""
    before, tables = spark.conf.get(LIMIT), Standins(spark, SF_DIR).all
    spark.conf.set(LIMIT, "1500")
    try:
        with views.session_views(spark, tables, prefix="small_") as names:
            plan = physical_plan(spark.sql(views.stage_sql(names)))
    finally:
        spark.conf.set(LIMIT, before)
    assert len(re.findall(r"^\(\d+\) BroadcastHashJoin", plan, re.M)) == 2


def test_rejects_are_parsed_once(spark):
    """The filter on the names of the columns is not pushed below the projection that makes them."""
    df = spark.createDataFrame([("x", "31/02/2020"), ("1,5", "01/02/2020"), (None, None), ("", "")], "list_price string, invoice_date string")
    df = df.withColumns({n: F.lit(None).cast("string") for n in ENTITIES["vendas"].names if n not in df.columns})
    bad = conform.reject_rows(df, ENTITIES["vendas"])
    filters = re.findall(r"Filter .*", bad._jdf.queryExecution().optimizedPlan().toString())
    assert filters and not any("concat_ws" in condition for condition in filters)
    assert [(r.list_price, r.bad_columns) for r in bad.orderBy("list_price").collect()] == [
        ("", "invoice_date"), ("x", "invoice_date,list_price")
    ]


def test_views(spark):
    tables = Standins(spark, SF_DIR).all
    expected = joins.stage_join(**tables)
    with views.session_views(spark, tables, prefix="t_") as names:
        assert names["stage"] == "t_stage" and views.is_view(spark, "t_vendas")
        chain, view = spark.sql(views.stage_sql(names)), spark.table("t_stage")
        narrow = spark.sql(views.narrow_stage_sql(names))
        assert spark.table("t_stage").columns == STAGE.names
        with pytest.raises(ValueError, match="t_stage"), views.session_views(spark, tables, prefix="t_"):
            pass
    assert not any(views.is_view(spark, name) for name in names.values())
    same_rows(chain, expected)
    same_rows(view, expected)
    same_rows(narrow, joins.stage_join_narrow(**tables))


def test_rejects_are_counted_in_the_scan_that_exports(spark, stage_dir, tmp_path):
    staged = snapshots.scan_staged(spark, f"{stage_dir}/vendas", ENTITIES["vendas"])
    out = [str(tmp_path / name) for name in ("gold", "bad")]
    done = export_entity(spark, "vendas", f"{stage_dir}/vendas", out[0], RUN, rejects_path=out[1])
    counts = conform.date_reject_counts(staged, ENTITIES["vendas"]).first().asDict()
    counts |= conform.number_reject_counts(staged, ENTITIES["vendas"]).first().asDict()
    assert done.rejects == counts and done.load.rows == staged.count()
    cleaned, _ = conform.conform_counting(staged, ENTITIES["vendas"], RUN)
    assert len(re.findall(r"\(\d+\) Scan orc", physical_plan(cleaned))) == 1
    same_rows(cleaned, conform.conform_entity(staged, ENTITIES["vendas"], RUN))
    bad = conform.reject_rows(staged, ENTITIES["vendas"])
    back = read_gold(spark, out[1], bad.schema)
    assert back.count() == bad.count() > 0
    named = bad.select(F.explode(F.split(conform.BAD_COLUMNS, ",")).alias("name")).groupBy("name").count()
    assert {r.name: r["count"] for r in named.collect()} == {n: c for n, c in counts.items() if c}


def test_an_export_without_rejects(spark, stage_dir, tmp_path):
    done = export_entity(spark, "divisao", f"{stage_dir}/divisao", str(tmp_path / "g"), RUN, rejects_path=str(tmp_path / "b"))
    assert done.rejects == {} and done.load.rows > 0
    names = ", ".join(f"{n} string" for n in ["division", "division_name", "dt_foto", "bad_columns"])
    assert read_gold(spark, str(tmp_path / "b"), spark.createDataFrame([], names).schema).collect() == []


def optimized(df):
    """The optimized plan with all its columns."""
    name, spark = "spark.sql.debug.maxToStringFields", df.sparkSession
    kept = spark.conf.get(name)
    spark.conf.set(name, "1000")
    try:
        return df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set(name, kept)


def test_no_run_of_blanks_is_passed_over_by_the_quick_search(spark):
    from salesmart.functions.text import BLANKS, MAYBE_RUN, clean_string

    assert not [c for c in BLANKS if "!" <= c <= "~"]
    texts = [f"x{a}{b}y" for a in BLANKS for b in BLANKS] + ["xéçy", "x y", "xy"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = rows.select("text", F.col("text").rlike(MAYBE_RUN).alias("maybe"), clean_string(F.col("text")).alias("clean"))
    for row in rows.collect():
        run = len(row.text) == 4 and row.text[1] in BLANKS
        assert row.maybe or not run
        assert row.clean == ("x y" if run else row.text)


def test_shared_parts_of_the_sales_are_worked_out_once(spark):
    plan = optimized(Standins(spark, SF_DIR).vendas)
    assert len(re.findall(r"round\(\(l_extendedprice", plan)) == 1


@pytest.mark.parametrize("iso_dates", [False, True])
def test_values_are_parsed_once_to_be_cleaned_and_counted(spark, iso_dates):
    names = snapshots.staged_schema(ENTITIES["vendas"]).names
    one = dict.fromkeys(names, "1") | {"dt_foto": "20240101", "list_price": "n/d", "datekey": "", "sales_rep": None}
    rows = spark.createDataFrame([tuple(one[n] for n in names)], ", ".join(f"{n} string" for n in names))
    cleaned, seen = conform.conform_counting(rows.repartition(1), ENTITIES["vendas"], RUN, iso_dates)
    plan = optimized(cleaned)
    assert plan.count(" as double)") == 9
    cleaned.collect()
    dates = ["actual_delivery_date", "datekey", "invoice_date", "promised_delivery_date"]
    bad = dict.fromkeys(["list_price", *dates], 1)
    assert seen.get == dict.fromkeys(conform.parsed_columns(ENTITIES["vendas"]), 0) | bad


def test_the_fact_is_told_apart_before_its_keys_are_hashed(spark):
    from salesmart.operators.star import ft_vendas_with_keys

    df = ft_vendas_with_keys(**Standins(spark, SF_DIR).all)
    hashing = [line for line in optimized(df).splitlines() if "sha2(" in line]
    assert len(hashing) == 1 and hashing[0].count("sha2(") == 4
    grouped, _, made = hashing[0].partition("], [")
    assert grouped.lstrip(" +-:").startswith("Aggregate") and "sha2(" not in grouped and "sha2(" in made


def test_raw_stand_ins_are_compressed(spark, tmp_path):
    from verification.queries import write_raw

    write_raw(spark.createDataFrame([("a", None), ("", "b")], "x string, y string").coalesce(1), str(tmp_path / "raw"))
    files = [f.name for f in (tmp_path / "raw").iterdir() if f.name.startswith("part-")]
    assert files and all(name.endswith(".lz4") for name in files)
