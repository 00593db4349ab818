"""Raw text, snapshots, the catalog and gold files, by write and read back."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from salesmart.plans.load import load_entity
from salesmart.schemas import DIVISAO, ENTITIES, REGIAO, STAGE, VENDAS, staged_schema
from salesmart.operators import conform, joins, stage
from salesmart.sources import catalog, gold, raw, snapshots
from verification import oracle
from verification.oracle import names
from verification.standins import Standins

RUN = dt.date(2024, 1, 2)


def write(path, data: bytes):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)
    return str(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_column_order_is_the_contracts():
    assert STAGE.names == names(oracle.STAGE) and joins.NARROW == names(oracle.NARROW)
    assert {e: [*c, "dt_foto"] for e, c in oracle.ENTITIES.items()} == {e: s.names for e, s in ENTITIES.items()}
    for schema in (*ENTITIES.values(), STAGE):
        kinds = {f.name: f.dataType.simpleString() for f in schema}
        assert {n for n, k in kinds.items() if k == "double"} == set(oracle.NUMBERS) & set(kinds)
        assert {n for n, k in kinds.items() if k == "date"} == {*oracle.DATES, "dt_foto", "data_foto"} & set(kinds)


def test_outputs_have_the_contracts_order(spark):
    tables = Standins(spark, "/root/testdata/sf0.001").all
    assert joins.stage_join(**tables).columns == names(oracle.STAGE)
    assert stage.conformed_stage(**tables).columns == names(oracle.STAGE)
    assert stage.wide_stage(**tables).columns[:43] == names(oracle.STAGE)
    for entity, schema in ENTITIES.items():
        made = conform.conform_entity(tables[entity], schema, RUN)
        assert made.columns == [*oracle.ENTITIES[entity], "dt_foto"]


def test_declared_columns():
    assert {name: len(s) for name, s in ENTITIES.items()} == {
        "regiao": 3,
        "divisao": 3,
        "endereco": 10,
        "clientes": 13,
        "vendas": 22,
    }
    kinds = [f.dataType.simpleString() for f in VENDAS]
    assert (kinds.count("date"), kinds.count("double"), kinds.count("string")) == (5, 9, 8)
    kinds = [f.dataType.simpleString() for f in STAGE]
    assert (kinds.count("date"), kinds.count("double"), kinds.count("string")) == (5, 9, 29)
    assert len(set(STAGE.names)) == 43


def test_scan_raw_keeps_text_as_it_is(spark, tmp_path):
    header = b"A;B;C\r\n"
    write(tmp_path / "t" / "1.csv", header + 'x;"y";z\r\n;;\r\n\\N; b ;São  Paulo\r\n'.encode())
    write(tmp_path / "t" / "2.csv", header + b"only\r\na;b;c;more\r\nA;B;C\r\n")
    df = raw.scan_raw(spark, str(tmp_path / "t"))
    assert df.columns == ["a", "b", "c"]
    assert rows(df) == sorted(
        [
            ("x", '"y"', "z"),
            ("", "", ""),
            (None, " b ", "São  Paulo"),
            ("only", None, None),
            ("a", "b", "c"),
            ("A", "B", "C"),
        ],
        key=repr,
    )


def test_scan_raw_loses_no_text(spark, tmp_path):
    path = write(tmp_path / "t" / "1.csv", b"A;B\nwe\x01stern;x\n\n \n\x01;\x01\x01\na;b;c;d\nshort\n")
    whole = [("we\x01stern", "x"), ("\x01", "\x01\x01"), ("a", "b"), ("short", None)]
    assert rows(raw.scan_raw(spark, path)) == sorted(whole, key=repr)
    blank = raw.scan_raw(spark, path, blank_lines=True)
    assert rows(blank) == sorted([*whole, ("", None), (" ", None)], key=repr)
    assert raw.raw_reject_counts(spark, path).first().asDict() == {
        "blank_lines": 2,
        "wide_lines": 1,
        "short_lines": 1,
    }


def test_header_is_checked_against_the_declared_columns(spark, tmp_path):
    stage = str(tmp_path / "stage")
    wrong = write(tmp_path / "wrong.csv", b"Region Code;Region Nome\n1;West\n")
    with pytest.raises(ValueError, match="region_name"):
        load_entity(spark, "regiao", wrong, stage, RUN)
    moved = write(tmp_path / "moved.csv", b"Region Name;More;Region Code\nWest;x;1\n")
    with pytest.warns(UserWarning, match="more"):
        load_entity(spark, "regiao", moved, stage, RUN)
    staged = snapshots.scan_staged(spark, stage, REGIAO)
    assert rows(staged) == [("1", "West", "20240101")]
    assert staged.columns == ["region_code", "region_name", "dt_foto"]
    with pytest.raises(ValueError, match="division"):
        snapshots.scan_staged(spark, stage, DIVISAO)


def test_files_with_columns_in_different_order(spark, tmp_path):
    folder, stage = tmp_path / "raw", str(tmp_path / "stage")
    write(folder / "1.csv", b"Region Code;Region Name\n1;West\n;\n")
    write(folder / "a 2+[x].csv", b"REGION NAME;REGION CODE;More\r\nEast;2;x\r\n\\N;3\r\n")
    write(folder / "3.csv", b"region code;region name\n4;A;B\n")
    write(folder / "4.csv", b"")
    with pytest.raises(Exception, match="header does not conform"):
        raw.scan_raw(spark, str(folder)).collect()
    expected = [("", ""), ("1", "West"), ("2", "East"), ("3", None), ("4", "A")]
    assert sorted(raw.file_headers(spark, str(folder))) == ["REGION NAME;REGION CODE;More", "Region Code;Region Name", "region code;region name"]
    with pytest.warns(UserWarning, match="more"):
        found = raw.scan_by_header(spark, str(folder), ["region_code", "region_name"])
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    with pytest.warns(UserWarning, match="more"):
        load_entity(spark, "regiao", str(folder), stage, RUN)
    staged = [(*r, "20240101") for r in expected]
    assert rows(snapshots.scan_staged(spark, stage, REGIAO)) == sorted(staged, key=repr)
    write(folder / "5.csv", b"Region Name;Code\nNorth;9\n")
    with pytest.raises(ValueError, match="5.csv: no column region_code"):
        load_entity(spark, "regiao", str(folder), stage, RUN)
    assert rows(snapshots.scan_staged(spark, stage, REGIAO)) == sorted(staged, key=repr)


def test_a_failure_that_is_no_header_is_raised(spark, tmp_path):
    path = write(tmp_path / "1.csv", b"Region Code;Region Name\n1;West\n")
    blocked = write(tmp_path / "blocked", b"")
    with pytest.raises(Exception, match="(?i)blocked"):
        load_entity(spark, "regiao", path, f"{blocked}/stage", RUN)


def test_header_names(spark, tmp_path):
    path = write(tmp_path / "DIVISAO.csv", b"Division;Division Name;U/M\r\n1;International;x\r\n")
    assert raw.schema_from_header(spark, path) == ["division", "division_name", "u_m"]
    assert raw.entity_name(path) == "divisao"
    assert raw.entity_name("/raw/Vendas/") == "vendas"


def region(spark, names):
    return spark.createDataFrame(list(enumerate(names)), "region_code string, region_name string")


NEXT = RUN + dt.timedelta(days=1)


def test_snapshot_days(spark, tmp_path):
    path = str(tmp_path / "regiao")
    with pytest.raises(FileNotFoundError):
        snapshots.scan_staged(spark, path, REGIAO)
    snapshots.write_snapshot(region(spark, ["old", "older"]), path, RUN)
    snapshots.write_snapshot(region(spark, ["next"]), path, NEXT)
    snapshots.write_snapshot(region(spark, ["new"]), path, RUN)
    assert snapshots.list_snapshots(spark, path) == ["20240101", "20240102"]
    folder = snapshots.day_load(spark, path, "20240101").folder
    assert folder.startswith("dt_foto=20240101/")
    assert any(n.endswith(".snappy.orc") for n in os.listdir(f"{path}/{folder}"))

    latest = snapshots.scan_staged(spark, path, REGIAO)
    assert latest.dtypes[-1] == ("dt_foto", "string")
    assert rows(latest) == [("0", "next", "20240102")]
    first = snapshots.scan_staged(spark, path, REGIAO, "20240101")
    assert rows(first) == [("0", "new", "20240101")]
    assert len(rows(snapshots.scan_staged(spark, path, REGIAO, snapshots.ALL))) == 2
    assert all("dt_foto=20240101" in name for name in first.inputFiles())

    snapshots.write_snapshot(region(spark, ["gone"]).where("false"), path, NEXT)
    assert rows(snapshots.scan_staged(spark, path, REGIAO)) == []
    assert rows(snapshots.scan_staged(spark, path, REGIAO, snapshots.ALL)) == rows(first)


def test_newest_common_day(spark, tmp_path):
    paths = {name: str(tmp_path / name) for name in ("on_time", "late")}
    snapshots.write_snapshot(region(spark, ["a"]), paths["late"], RUN)
    with pytest.raises(FileNotFoundError):
        snapshots.latest_common_day(spark, paths)
    for day in (RUN, NEXT):
        snapshots.write_snapshot(region(spark, ["a"]), paths["on_time"], day)
    assert snapshots.latest_common_day(spark, paths) == "20240101"


def test_registered_table(spark, tmp_path):
    at = str(tmp_path / "regiao")
    args = (spark, "mart_test", "regiao", REGIAO, at, str(tmp_path / "db"))
    table = catalog.register_table(*args)
    assert table == "mart_test.tbl_regiao"
    with pytest.raises(FileNotFoundError):
        catalog.scan_table(spark, table)
    catalog.load_table(region(spark, ["old"]), table, RUN)
    catalog.load_table(region(spark, ["next"]), table, NEXT)
    catalog.load_table(region(spark, ["new"]), table, RUN)
    assert rows(catalog.scan_table(spark, table)) == [("0", "next", "20240102")]
    assert rows(catalog.scan_table(spark, table, "20240101")) == [("0", "new", "20240101")]
    # Registering again keeps the days that lie there.
    assert len(rows(catalog.scan_table(spark, catalog.register_table(*args), "all"))) == 2
    catalog.load_table(region(spark, ["gone"]).where("false"), table, NEXT)
    assert rows(catalog.scan_table(spark, table)) == []
    assert rows(catalog.scan_table(spark, table, "20240101")) == [("0", "new", "20240101")]
    # A day loaded as a snapshot, and a load that fails.
    snapshots.write_snapshot(region(spark, ["later"]), at, NEXT + dt.timedelta(days=1))
    catalog.register_table(*args)
    assert rows(catalog.scan_table(spark, table)) == [("0", "later", "20240103")]
    broken = region(spark, ["x"]).withColumn("region_name", F.raise_error(F.lit("no more")).cast("string"))
    with pytest.raises(Exception, match="no more"):
        catalog.load_table(broken, table, RUN)
    assert rows(catalog.scan_table(spark, table, "20240101")) == [("0", "new", "20240101")]
    about = spark.sql(f"DESCRIBE EXTENDED {table} PARTITION (dt_foto = '20240101')").collect()
    assert any(r.col_name == "Partition Statistics" and "1 rows" in r.data_type for r in about)
    spark.sql("DROP DATABASE mart_test CASCADE")


def test_columns_and_places_with_quotes(spark, tmp_path):
    at = tmp_path / "it's"
    at.mkdir()
    table = catalog.register_table(spark, "odd_test", "regiao", REGIAO, str(at / "a"), str(tmp_path / "db"))
    catalog.load_table(region(spark, ["x"]), table, RUN)
    assert rows(catalog.scan_table(spark, table)) == [("0", "x", "20240101")]
    write(at / "raw" / "1.csv", b"A,a;B's\n1;2\n")
    raw_table = catalog.register_raw_table(spark, "odd_test", "raw", ["a,a", "b's"], str(at / "raw"))
    assert catalog.scan_raw_table(spark, raw_table).columns == ["a,a", "b's"]
    spark.sql("DROP DATABASE odd_test CASCADE")


def test_registered_raw_table(spark, tmp_path):
    path = write(tmp_path / "raw" / "1.csv", b"A;B\nwe\x01stern;\n\\N; b \n").rsplit("/", 1)[0]
    names = raw.schema_from_header(spark, path)
    table = catalog.register_raw_table(spark, "raw_test", "regiao", names, path, str(tmp_path / "db"))
    assert rows(catalog.scan_raw_table(spark, table)) == rows(raw.scan_raw(spark, path))
    write(tmp_path / "raw" / "2.csv", b"A;B\nmore;x\n")
    spark.catalog.refreshTable(table)
    assert len(rows(catalog.scan_raw_table(spark, table))) == 3 and spark.table(table).count() == 3
    spark.sql("DROP DATABASE raw_test CASCADE")
    assert (tmp_path / "raw" / "1.csv").exists()


def test_gold_round_trip(spark, tmp_path):
    path = str(tmp_path / "gold")
    given = [("1", "a;b", dt.date(2024, 1, 1)), ("", None, None), ("é", 'q"q', None)]
    df = spark.createDataFrame(given, DIVISAO).repartition(3)
    gold.write_gold(df, path)
    assert rows(gold.read_gold(spark, path, DIVISAO)) == sorted(given, key=repr)

    gold.write_gold(df.limit(1), path, files=1)
    folder = gold.gold_folder(spark, path)
    parts = [n for n in os.listdir(folder) if n.endswith(".csv")]
    assert len(parts) == 1
    text = open(f"{folder}/{parts[0]}", encoding="utf-8").read()
    assert text.splitlines()[0] == "division;division_name;dt_foto"
    assert gold.read_gold(spark, path, DIVISAO).count() == 1


def test_gold_keeps_blanks_and_line_feeds_if_asked(spark, tmp_path):
    path = str(tmp_path / "gold")
    given = [("1", " Bob ", None), ("2", "two\nlines", None)]
    df = spark.createDataFrame(given, DIVISAO)
    gold.write_gold(df, path)
    trimmed = [("1", "Bob", None), ("2", "two\nlines", None)]
    assert rows(gold.read_gold(spark, path, DIVISAO, line_feeds=True)) == trimmed
    gold.write_gold(df, path, keep_blanks=True)
    assert rows(gold.read_gold(spark, path, DIVISAO, line_feeds=True)) == given


def test_gold_failure_raises(spark, tmp_path):
    blocked = write(tmp_path / "file", b"")
    with pytest.raises(Exception):
        gold.write_gold(region(spark, ["x"]), f"{blocked}/gold")


def test_staged_columns_are_text_with_the_day_last():
    assert staged_schema(REGIAO).names == ["region_code", "region_name", "dt_foto"]
    assert {f.dataType.simpleString() for f in staged_schema(VENDAS)} == {"string"}
