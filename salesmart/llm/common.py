"""Helpers of the operators: tables, stored intermediates, columns added from Arrow batches."""

from __future__ import annotations

import pickle
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_DIR = "spark.checkpoint.dir"
CHUNK_CHARS = 1_000_000

_written: ContextVar[list[str] | None] = ContextVar("_written", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share. Where that is unset and
    Spark runs inside one machine, as in tests, a new local one."""
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="salesmart-llm-")
    return shared.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written as Parquet and read back, so that nothing computes them again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if (written := _written.get()) is not None:
        written.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def noted() -> Iterator[list[str]]:
    """The paths that `stored` writes inside the block, in order."""
    paths: list[str] = []
    token = _written.set(paths)
    try:
        yield paths
    finally:
        _written.reset(token)


def empty(spark: SparkSession, paths: Iterable[str]) -> None:
    """Replace stored tables that nothing will read again by tables without rows."""
    for path in paths:
        spark.range(0).write.mode("overwrite").parquet(path)


def shipped(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """A function that gives `value` on an executor, to which it is broadcast.

    It travels as bytes that hold its classes too, so that executors need no package of this
    library. Each task unpacks it once.
    """
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    here: list = []

    def load() -> Any:
        if not here:
            here.append(pickle.loads(sent.value))
        return here[0]

    return load


def add_columns(
    df: DataFrame,
    source: str,
    make: Callable[[list], dict[str, list]],
    fields: Sequence[T.StructField],
    *,
    without: Sequence[str] = (),
    keep_if: Callable[[dict[str, list]], list[bool]] | None = None,
) -> DataFrame:
    """df with columns that `make` derives from the values of column `source`.

    A column of df with the name of a new one is replaced. `without` names columns not to be
    sent back, `keep_if` says from the new columns which rows stay. `make` gets values of at
    most CHUNK_CHARS characters together, or a single longer one.
    """
    new = [field.name.lower() for field in fields]
    kept = [name for name in df.columns if name.lower() not in {*new, *(w.lower() for w in without)}]
    schema = T.StructType([*(df.schema[name] for name in kept), *fields])
    kinds = {field.name: _arrow(field.dataType) for field in fields}
    numbered = {name: i for i, name in enumerate(df.columns)}
    at, indices = numbered[source], [numbered[name] for name in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(at).to_pylist()
            made: dict[str, list] = {name: [] for name in kinds}
            for chunk in chunks(values):
                for name, column in make(chunk).items():
                    made[name].extend(column)
            columns = [batch.column(i) for i in indices]
            columns += [pa.array(made[name], kind) for name, kind in kinds.items()]
            out = pa.RecordBatch.from_arrays(columns, names=[*kept, *kinds])
            if keep_if is not None:
                out = out.filter(pa.array(keep_if(made), pa.bool_()))
            yield out

    return df.mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    simple = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
    return simple[kind.simpleString()]


def chunks(values: list) -> Iterator[list]:
    """Runs of consecutive texts with at most CHUNK_CHARS characters together."""
    start, size = 0, 0
    for i, value in enumerate(values):
        n = len(value or "")
        if i > start and size + n > CHUNK_CHARS:
            yield values[start:i]
            start, size = i, 0
        size += n
    if start < len(values):
        yield values[start:]


def crc_mod(column, modulus: int):
    """crc32 of the id as text, modulo `modulus`; null ids give null."""
    return F.crc32(F.col(column).cast("string")) % modulus


def text_column(df: DataFrame, name: str = "text") -> DataFrame:
    """df with `name` as a string column."""
    return df.withColumn(name, F.col(name).cast("string"))


HEAVY_KEYS = 2000


def skewed_join(rows: DataFrame, table: DataFrame, key: str, weight: str) -> DataFrame:
    """rows with their key's row of `table` (one for each key), without moving heavy keys' rows.

    `weight` is each key's number of rows. A key with 1 / HEAVY_KEYS of all rows or more is
    heavy; there are HEAVY_KEYS such keys at most, so theirs alone are broadcast. Both inputs
    are read twice and should be stored.
    """
    total = rows.count()
    heavy = table.where(F.col(weight) * HEAVY_KEYS >= total)
    light = rows.join(F.broadcast(heavy.select(key)), key, "left_anti")
    by_shuffle = light.join(table.where(F.col(weight) * HEAVY_KEYS < total), key)
    return rows.join(F.broadcast(heavy), key).unionByName(by_shuffle)


def skewed_anti_join(rows: DataFrame, table: DataFrame, key: str, weight: str, gone: str) -> DataFrame:
    """rows without those whose key `gone` holds for in `table`, without moving heavy keys' rows.

    `table` has a row for each key of `rows`, with its number of rows as `weight`, and should be
    stored. Rows without a key stay. As in skewed_join, HEAVY_KEYS keys at most are heavy, and
    theirs alone are broadcast. rows are read three times.
    """
    table = table.where(F.col(key).isNotNull())
    total = table.agg(F.sum(weight)).first()[0] or 0
    bar = F.col(weight) * HEAVY_KEYS >= total
    heavy, light = table.where(bar), table.where(~bar & F.col(gone)).select(key)
    known = rows.where(F.col(key).isNotNull())
    kept = known.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key, "left_anti")
    hot = known.join(F.broadcast(heavy.where(~F.col(gone)).select(key)), key, "left_semi")
    return kept.unionByName(hot).unionByName(rows.where(F.col(key).isNull()))
