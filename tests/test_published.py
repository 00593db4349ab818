"""Loads that fail, that are being read, that are not finished, and what a finished one tells."""

from __future__ import annotations

import datetime as dt
import os
import pathlib

import pytest
from pyspark.sql import functions as F

from salesmart.plans import export, load, star
from salesmart.schemas import ENTITIES, REGIAO
from salesmart.sources import gold, published, snapshots
from salesmart.sources.published import LoadError, expire
from tests.test_plans import RAW, RUN, sales_file

NEXT = RUN + dt.timedelta(days=1)
DAY, NEXT_DAY = "20240101", "20240102"


def region(spark, names):
    return spark.createDataFrame([(str(i), n) for i, n in enumerate(names)], "region_code string, region_name string")


def failing(spark):
    """Rows of which the last task's last raises."""
    rows = spark.range(0, 400, 1, 8).select(F.col("id").cast("string").alias("region_code"), "id")
    bad = F.when(F.col("id") == 399, F.raise_error(F.lit("no more"))).otherwise(F.lit("x"))
    return rows.select("region_code", bad.cast("string").alias("region_name"))


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_a_failed_load_leaves_the_day_as_it_was(spark, tmp_path):
    path = str(tmp_path / "regiao")
    with pytest.raises(Exception, match="no more"):
        snapshots.write_snapshot(failing(spark), path, RUN)
    with pytest.raises(FileNotFoundError):
        snapshots.scan_staged(spark, path, REGIAO)
    snapshots.write_snapshot(region(spark, ["old"]), path, RUN)
    for run_date in (RUN, NEXT):
        with pytest.raises(Exception, match="no more"):
            snapshots.write_snapshot(failing(spark), path, run_date)
    assert snapshots.list_snapshots(spark, path) == [DAY]
    assert rows(snapshots.scan_staged(spark, path, REGIAO)) == [("0", "old", DAY)]
    assert rows(snapshots.scan_staged(spark, path, REGIAO, snapshots.ALL)) == [("0", "old", DAY)]
    snapshots.write_snapshot(region(spark, ["new"]), path, RUN)
    assert rows(snapshots.scan_staged(spark, path, REGIAO)) == [("0", "new", DAY)]


def test_an_unfinished_day_is_never_the_latest(spark, tmp_path):
    paths = {name: str(tmp_path / name) for name in ("a", "b")}
    for path in paths.values():
        snapshots.write_snapshot(region(spark, ["old"]), path, RUN)
    # As a killed job leaves it: all files are there, but it was not published.
    region(spark, ["half"]).write.orc(f"{paths['a']}/dt_foto={NEXT_DAY}/load=0123")
    snapshots.write_snapshot(region(spark, ["whole"]), paths["b"], NEXT)
    assert snapshots.latest_common_day(spark, paths) == DAY
    assert rows(snapshots.scan_staged(spark, paths["a"], REGIAO)) == [("0", "old", DAY)]
    with pytest.raises(FileNotFoundError, match=NEXT_DAY):
        snapshots.scan_staged(spark, paths["a"], REGIAO, NEXT_DAY)


def test_rows_that_went_missing_are_not_published(spark, tmp_path):
    path = str(tmp_path / "regiao")
    snapshots.write_snapshot(region(spark, ["old"]), path, RUN)

    def lossy(df, at):
        df.write.format("noop").mode("overwrite").save()
        df.limit(1).write.orc(at)

    with pytest.raises(LoadError, match="not published"):
        published.write_load(
            region(spark, ["a", "b"]), path, lossy, day=DAY, recount=lambda s, at: s.read.orc(at).count()
        )
    assert rows(snapshots.scan_staged(spark, path, REGIAO)) == [("0", "old", DAY)]


def test_a_failed_gold_write_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "gold")
    with pytest.raises(FileNotFoundError):
        gold.read_gold(spark, path, REGIAO)
    gold.write_gold(region(spark, ["old", "older"]), path)
    with pytest.raises(Exception, match="no more"):
        gold.write_gold(failing(spark), path)
    schema = region(spark, []).schema
    assert rows(gold.read_gold(spark, path, schema)) == [("0", "old"), ("1", "older")]


def test_a_reader_keeps_what_it_resolved(spark, tmp_path):
    path, schema = str(tmp_path / "gold"), region(spark, []).schema
    gold.write_gold(region(spark, ["old"]), path)
    reading = gold.read_gold(spark, path, schema)
    staged = str(tmp_path / "regiao")
    snapshots.write_snapshot(region(spark, ["old"]), staged, RUN)
    scanning = snapshots.scan_staged(spark, staged, REGIAO)
    seen = []

    def write(df, at):
        seen.append(rows(gold.read_gold(spark, path, schema)))
        df.write.option("header", True).option("sep", ";").csv(at)
        seen.append(rows(gold.read_gold(spark, path, schema)))

    published.write_load(region(spark, ["new"]), path, write)
    snapshots.write_snapshot(region(spark, ["new"]), staged, RUN)
    assert seen == [[("0", "old")]] * 2
    assert rows(reading) == [("0", "old")] and rows(gold.read_gold(spark, path, schema)) == [("0", "new")]
    assert rows(scanning) == [("0", "old", DAY)]


def test_a_failed_export_keeps_the_gold_of_all_entities(spark, tmp_path, monkeypatch):
    for entity, text in RAW.items():
        (tmp_path / "raw" / entity).mkdir(parents=True)
        (tmp_path / "raw" / entity / "1.csv").write_bytes(text.encode())
    entities, stage, out = list(RAW), str(tmp_path / "stage"), str(tmp_path / "gold")
    load.load_entities(spark, str(tmp_path / "raw"), stage, RUN, entities)
    export.export_entities(spark, stage, out, RUN, entities)
    before = {e: rows(gold.read_gold(spark, f"{out}/{e}", ENTITIES[e])) for e in ("divisao", "regiao")}

    plain = export.scan_staged
    broken = lambda *a: plain(*a).withColumn("division", F.raise_error(F.lit("no more")).cast("string"))
    monkeypatch.setattr(export, "scan_staged", broken)
    with pytest.raises(Exception, match="no more"):
        export.export_entity(spark, "divisao", f"{stage}/divisao", f"{out}/divisao", RUN)
    assert {e: rows(gold.read_gold(spark, f"{out}/{e}", ENTITIES[e])) for e in before} == before


def test_what_an_entry_tells(spark, tmp_path):
    path = str(tmp_path / "regiao")
    given = [("1", "é"), ("1", None), (None, "abc"), ("2", "")]
    df = spark.createDataFrame(given, "region_code string, region_name string").repartition(2)
    made = snapshots.write_snapshot(df, path, RUN, ["region_code"])
    (entry,) = published.published(spark, path)
    assert entry == made
    assert (entry.number, entry.day, entry.rows) == (1, DAY, 4)
    assert entry.files == len([n for n in os.listdir(f"{path}/{entry.folder}") if n.endswith(".orc")])
    assert entry.bytes == sum(os.path.getsize(f"{path}/{entry.folder}/{n}") for n in os.listdir(f"{path}/{entry.folder}") if n.endswith(".orc"))
    assert entry.columns == {"region_code": 3, "region_name": 5} and entry.widest == {"region_code": 1, "region_name": 3}
    assert entry.frequent == {"region_code": [("1", 2), (None, 1), ("2", 1)]} and entry.most("region_code") == 2
    assert entry.text_bytes() == 8 + 3 * 8 * 4 and entry.text_bytes(["region_code"]) == 3 + 2 * 8 * 4
    empty = snapshots.write_snapshot(df.where("false"), path, RUN, ["region_code"])
    assert (empty.number, empty.rows, empty.most("region_code")) == (2, 0, 0)


def test_expiry_spares_what_is_current(spark, tmp_path):
    path = str(tmp_path / "regiao")
    old = snapshots.write_snapshot(region(spark, ["old"]), path, RUN)
    other = snapshots.write_snapshot(region(spark, ["other"]), path, NEXT)
    new = snapshots.write_snapshot(region(spark, ["new"]), path, RUN)
    region(spark, ["half"]).write.orc(f"{path}/dt_foto={DAY}/load=0123")
    long_ago, soon = dt.datetime(2000, 1, 1), dt.datetime.now() + dt.timedelta(days=1)
    assert expire(spark, path, long_ago) == []
    assert expire(spark, path, soon) == sorted([old.folder, f"dt_foto={DAY}/load=0123"])
    assert expire(spark, path, soon) == []
    both = [("0", "new", DAY), ("0", "other", NEXT_DAY)]
    assert rows(snapshots.scan_staged(spark, path, REGIAO, snapshots.ALL)) == both
    assert {new.folder, other.folder} == {v.folder for v in published.newest(published.published(spark, path)).values()}


def test_a_failed_star_keeps_the_star(spark, tmp_path, monkeypatch):
    for entity, text in (RAW | {"vendas": sales_file(["10", "20"])}).items():
        (tmp_path / "raw" / entity).mkdir(parents=True)
        (tmp_path / "raw" / entity / "1.csv").write_bytes(text.encode())
    stage, out = str(tmp_path / "stage"), str(tmp_path / "gold")
    load.load_entities(spark, str(tmp_path / "raw"), stage, RUN)
    star.star_job(spark, stage, out)
    schema = star.narrow_star(star.scan_entities(spark, stage))["dim_clientes"].schema
    before = rows(gold.read_gold(spark, f"{out}/dim_clientes", schema))
    plain = star.star.dim_clientes
    failing_dim = lambda *a, **k: plain(*a, **k).withColumn("customer", F.raise_error(F.lit("no more")).cast("string"))
    monkeypatch.setattr(star.star, "dim_clientes", failing_dim)
    with pytest.raises(Exception, match="no more"):
        star.star_job(spark, stage, out)
    assert rows(gold.read_gold(spark, f"{out}/dim_clientes", schema)) == before and len(before) == 2


def test_gold_is_compressed_if_asked(spark, tmp_path):
    path, df = str(tmp_path / "gold"), region(spark, ["x", " y", "", "S\u00e3o"])
    gold.write_gold(df, path, keep_blanks=True, compression="gzip")
    files = [n for n in os.listdir(gold.gold_folder(spark, path)) if n.startswith("part-")]
    assert files and all(n.endswith(".csv.gz") for n in files)
    assert rows(gold.read_gold(spark, path, df.schema)) == rows(df)


def test_raw_stand_ins_are_emptied_once_they_are_loaded(spark, tmp_path, monkeypatch):
    from verification import queries

    made, write = [], queries._raw_files
    monkeypatch.setattr(queries, "_raw_files", lambda *a: made.append(write(*a)) or made[-1])
    queries._load(spark, "/root/testdata/sf0.001", "regiao", str(tmp_path / "regiao"))
    files = [f for f in pathlib.Path(made[0]).rglob("part-*")]
    assert sum(f.stat().st_size for f in files) == 0
    assert snapshots.scan_staged(spark, str(tmp_path / "regiao"), REGIAO).count() == 5
