"""Raw and staged tables in the session's catalog."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.schemas import SNAPSHOT, data_columns
from salesmart.sources.published import Load, newest, published
from salesmart.sources.raw import scan_raw
from salesmart.sources.snapshots import ALL, LATEST, NO_DAY, write_snapshot


def _text(value: str) -> str:
    """A text as an SQL literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _database(spark: SparkSession, database: str, location: str | None) -> None:
    at = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{at}")


def register_table(
    spark: SparkSession,
    database: str,
    entity: str,
    schema: T.StructType,
    location: str,
    database_location: str | None = None,
) -> str:
    """Create the database if need be, and the entity's staged table anew.

    The table only points at the location: dropping it keeps the files, and days that are
    published there already, be it by `write_snapshot`, are found again. Returns the table's name.
    """
    table = f"{database}.tbl_{entity}"
    columns = ", ".join(f"{name} STRING" for name in data_columns(schema))
    _database(spark, database, database_location)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"CREATE TABLE {table} ({columns}, {SNAPSHOT} STRING) USING ORC "
        f"OPTIONS ('orc.compress' = 'SNAPPY') PARTITIONED BY ({SNAPSHOT}) "
        f"LOCATION {_text(location)}"
    )
    days = [
        f"{_day(day)} LOCATION {_text(f'{location.rstrip('/')}/{load.folder}')}"
        for day, load in newest(published(spark, location)).items()
    ]
    if days:
        spark.sql(f"ALTER TABLE {table} ADD {' '.join(days)}")
        _leave_sizes(spark, table)
    return table


def register_raw_table(
    spark: SparkSession,
    database: str,
    entity: str,
    columns: list[str],
    location: str,
    database_location: str | None = None,
) -> str:
    r"""Create the database if need be, and the entity's external table over raw files anew.

    The table holds the lines as text, header lines apart, and only points at the location.
    `scan_raw_table` splits them: a delimited table of Spark's own would turn empty fields
    into NULL. Returns the table's name.
    """
    table = f"{database}.tbl_{entity}"
    _database(spark, database, database_location)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"CREATE TABLE {table} (line STRING) USING CSV OPTIONS ('header' = 'true', "
        f"'sep' = '\u0001', 'quote' = '') LOCATION {_text(location)} "
        f"COMMENT {_text(f'Lines of {entity}')} TBLPROPERTIES ('columns' = {_text(json.dumps(columns))})"
    )
    return table


def scan_raw_table(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a registered raw table, as `scan_raw` gives them for its location."""
    named = spark.sql(f"SHOW TBLPROPERTIES {table} ('columns')").first()["value"]
    return scan_raw(spark, _location(spark, table), json.loads(named))


def load_table(df: DataFrame, table: str, run_date: dt.date) -> Load:
    """Load the day before the run into a registered table, replacing that day only.

    The day is loaded as a snapshot at the table's location, and its partition is pointed to the
    load once that is published, so a load that fails leaves the day as it was, and a load
    without rows makes it empty. Sizes are left in the catalog for the planner.
    """
    spark = df.sparkSession
    names = [name for name in spark.table(table).columns if name != SNAPSHOT]
    location = _location(spark, table)
    load = write_snapshot(df.select(*names), location, run_date)
    at = _text(f"{location}/{load.folder}")
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {_day(load.day)} LOCATION {at}")
    spark.sql(f"ALTER TABLE {table} {_day(load.day)} SET LOCATION {at}")
    spark.catalog.refreshTable(table)
    _leave_sizes(spark, table, _day(load.day))
    return load


def _day(day: str) -> str:
    return f"PARTITION ({SNAPSHOT} = {_text(day)})"


def _leave_sizes(spark: SparkSession, table: str, day: str | None = None) -> None:
    """Let the catalog have the bytes of the table, and the rows of a day, or of each day."""
    spark.sql(f"ANALYZE TABLE {table} {day or f'PARTITION ({SNAPSHOT})'} COMPUTE STATISTICS")
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS NOSCAN")


def _location(spark: SparkSession, table: str) -> str:
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == "Location").first()
    return about["data_type"].rstrip("/")


def scan_table(spark: SparkSession, table: str, dt_foto: str = LATEST) -> DataFrame:
    """Staged rows of one snapshot day of a registered table; the latest by default."""
    staged = spark.table(table)
    if dt_foto == ALL:
        return staged
    if dt_foto == LATEST:
        # Partition names come from the catalog, one row per day; no file is opened.
        days = spark.sql(f"SHOW PARTITIONS {table}").where(~F.col("partition").endswith(NO_DAY))
        last = days.agg(F.max("partition")).first()[0]
        if last is None:
            raise FileNotFoundError(f"no snapshot in {table}")
        dt_foto = last.split("=", 1)[1]
    return staged.where(F.col(SNAPSHOT) == dt_foto)
