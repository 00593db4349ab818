"""Daily snapshots of an entity: Snappy ORC, one folder for each day and load of it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.dates import snapshot_day
from salesmart.schemas import SNAPSHOT, staged_schema
from salesmart.sources.published import Load, newest, published, write_load
from salesmart.sources.raw import check_columns

LATEST = "latest"
ALL = "all"

# The partition Spark writes rows without a day to.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"

# The folder of a load, below that of its day.
LOAD = "load"


def snapshot_text(run_date: dt.date) -> str:
    """The day before the run, as yyyyMMdd text."""
    return snapshot_day(run_date).strftime("%Y%m%d")


def stamp_snapshot(df: DataFrame, run_date: dt.date) -> DataFrame:
    """Add dt_foto, the day before the run, as yyyyMMdd text."""
    return df.withColumn(SNAPSHOT, F.lit(snapshot_text(run_date)))


def write_snapshot(df: DataFrame, path: str, run_date: dt.date, keys: Sequence[str] = ()) -> Load:
    """Load the day before the run. A day loaded again is replaced, others are not touched.

    The rows go to a new folder below the day's, and readers change over to it once all of them
    are there; a load that fails leaves the day as it was. A load without rows makes the day
    empty. The rows of the most frequent `keys` are counted for the joins.
    """
    day = snapshot_text(run_date)
    return write_load(
        df.drop(SNAPSHOT),
        path,
        lambda rows, at: rows.write.option("compression", "snappy").orc(at),
        day=day,
        below=f"{SNAPSHOT}={day}/",
        recount=lambda spark, at: _orc(spark, df, at).count(),
        keys=keys,
        read=lambda spark, at: _orc(spark, df, at),
    )


def _orc(spark: SparkSession, like: DataFrame, at: str) -> DataFrame:
    """The rows of a folder, which may hold no file."""
    return spark.read.schema(like.drop(SNAPSHOT).schema).orc(at)


def list_snapshots(spark: SparkSession, path: str) -> list[str]:
    """The days with a finished load at a path."""
    return sorted(newest(published(spark, path)))


def day_load(spark: SparkSession, path: str, dt_foto: str = LATEST) -> Load:
    """The last finished load of a day, by default of the latest."""
    days = newest(published(spark, path))
    day = max(days, default=None) if dt_foto == LATEST else dt_foto
    if day not in days:
        raise FileNotFoundError(f"no snapshot {'' if day is None else day + ' '}at {path}")
    return days[day]


def latest_common_day(spark: SparkSession, paths: Mapping[str, str]) -> str:
    """The newest day loaded at every one of the paths, which are named for the message."""
    return common_day({name: newest(published(spark, path)) for name, path in paths.items()})


def common_day(days: Mapping[str, Mapping[str, Load]]) -> str:
    common = set.intersection(*map(set, days.values()))
    if not common:
        raise FileNotFoundError(f"no day is loaded for all of {', '.join(days)}")
    return max(common)


def scan_staged(
    spark: SparkSession, path: str, schema: T.StructType, dt_foto: str = LATEST
) -> DataFrame:
    """Staged rows, all text, of one snapshot day.

    Two days read together would multiply rows in every join, so the default is the
    latest day. Only the folder of that day's last finished load is listed, so its size is what
    the planner sees. A declared column that the load lacks is an error, not a column of NULL.
    """
    if dt_foto == ALL:
        loads = list(newest(published(spark, path)).values())
        if not loads:
            raise FileNotFoundError(f"no snapshot at {path}")
    else:
        loads = [day_load(spark, path, dt_foto)]
    return scan_loads(spark, path, schema, loads)


def scan_loads(spark: SparkSession, path: str, schema: T.StructType, loads: Sequence[Load]) -> DataFrame:
    """Staged rows of the loads given."""
    path = path.rstrip("/")
    for load in loads:
        check_columns(list(load.columns), [n for n in schema.names if n != SNAPSHOT], f"{path}/{load.folder}")
    staged = staged_schema(schema)
    folders = [f"{path}/{load.folder}" for load in loads]
    reader = spark.read.option("basePath", path).schema(T.StructType([*staged, T.StructField(LOAD, T.StringType())]))
    return reader.orc(folders).select(*staged.names)
