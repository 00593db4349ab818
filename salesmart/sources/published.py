"""Loads of a table, of which readers see finished ones only.

Each load writes its rows to a folder of its own and counts them on the way. What lies there
afterwards is counted again; only if both agree is the load published, by one small file more in
`_published` below the table's path. Adding that file is the one step that changes what readers
see: before it they resolve the load before, after it the new one, and a load that fails at any
point is never seen. No folder that a reader may have resolved is touched by a load; `expire`
empties superseded and unfinished ones later.

A published entry also says how much text each column holds and which keys are frequent, so that
joins are planned without counting anything again.

Everything goes through Spark's own readers and writers, so a path may be in any store Spark reads.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PUBLISHED = "_published"
# So many keys of a column are kept, the most frequent first.
FREQUENT = 1000

ENTRY = (
    "number long, folder string, day string, rows long, files long, bytes long, columns map<string, long>, "
    "widest map<string, long>, frequent map<string, array<struct<key: string, rows: long>>>"
)

Frequent = list[tuple[str | None, int]]


class LoadError(RuntimeError):
    """What was written is not what was counted on the way."""


@dataclass(frozen=True)
class Load:
    """A published load: its folder below the table's path, and what it holds.

    `columns` has the bytes of text of each column, `widest` its longest value's, `frequent` the
    rows of each key column's most frequent keys, NULL among them.
    """

    number: int
    folder: str
    day: str | None = None
    rows: int = 0
    files: int = 0
    bytes: int = 0
    columns: Mapping[str, int] = field(default_factory=dict)
    widest: Mapping[str, int] = field(default_factory=dict)
    frequent: Mapping[str, Frequent] = field(default_factory=dict)

    def text_bytes(self, names: Sequence[str] | None = None) -> int:
        """The size of the rows by the planner's kind of count: text, and a word for each column."""
        names = list(self.columns) if names is None else names
        return sum(self.columns[n] for n in names) + 8 * (len(names) + 1) * self.rows

    def most(self, key: str) -> int:
        """The rows of the most frequent key that can match, 0 without any."""
        return max((rows for value, rows in self.frequent[key] if value is not None), default=0)


def published(spark: SparkSession, path: str) -> list[Load]:
    """All published loads of a table, in order; none where nothing was ever published."""
    try:
        entries = spark.read.schema(ENTRY).json(f"{path.rstrip('/')}/{PUBLISHED}").collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    found = []
    for entry in entries:  # one for each load ever made
        values = entry.asDict()
        frequent = {k: [(f.key, f.rows) for f in v] for k, v in (values.pop("frequent") or {}).items()}
        found.append(Load(**values, frequent=frequent))
    return sorted(found, key=lambda load: (load.number, load.folder))


def newest(loads: Sequence[Load]) -> dict[str | None, Load]:
    """For each day its last published load."""
    return {load.day: load for load in loads}


def write_load(
    df: DataFrame,
    path: str,
    write: Callable[[DataFrame, str], None],
    *,
    day: str | None = None,
    below: str = "",
    recount: Callable[[SparkSession, str], int] | None = None,
    keys: Sequence[str] = (),
    read: Callable[[SparkSession, str], DataFrame] | None = None,
) -> Load:
    """Write df by `write` to a new folder, compare, and publish it.

    `below` is put before the folder's name. `recount` says how many rows lie in a folder. For
    `keys` the rows of the most frequent keys are counted over what `read` gives.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    before = published(spark, path)
    folder = f"{below}load={uuid.uuid4().hex}"
    at = f"{path}/{folder}"
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    sizes = {name: F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0)).cast("long") for name in texts}
    seen = Observation()
    observed = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(size).alias(f"bytes{i}") for i, size in enumerate(sizes.values())],
        *[F.max(size).alias(f"widest{i}") for i, size in enumerate(sizes.values())],
    )
    write(observed, at)
    counted = seen.get
    files, size = _written(spark, at)
    rows = counted["rows"] if recount is None else recount(spark, at)
    if rows != counted["rows"] or (counted["rows"] and not files):
        raise LoadError(f"{at}: {counted['rows']} rows were written, {rows} lie in {files} files; not published")
    load = Load(
        number=1 + max((load.number for load in before), default=0),
        folder=folder,
        day=day,
        rows=rows,
        files=files,
        bytes=size,
        columns={name: counted.get(f"bytes{i}") or 0 for i, name in enumerate(texts)},
        widest={name: counted.get(f"widest{i}") or 0 for i, name in enumerate(texts)},
        frequent={key: _frequent(read(spark, at), key) for key in keys},
    )
    publish(spark, path, load)
    return load


def publish(spark: SparkSession, path: str, load: Load) -> None:
    """Add a load's entry, as one file; what it names must be complete."""
    entry = spark.createDataFrame([asdict(load)], ENTRY)
    entry.coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/{PUBLISHED}")


def _written(spark: SparkSession, folder: str) -> tuple[int, int]:
    """Number and bytes of the files in a folder, by a listing; none is opened."""
    files = spark.read.format("binaryFile").load(folder).select("length")
    found = files.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")).first()
    return found.files, found.bytes or 0


def _frequent(df: DataFrame, key: str) -> Frequent:
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    most = counts.orderBy(F.desc("rows"), key).limit(FREQUENT).collect()
    return [(row[key], row["rows"]) for row in most]


def expire(spark: SparkSession, path: str, before: dt.datetime) -> list[str]:
    """Empty the folders of superseded and unfinished loads whose files are all older than
    `before`, a time in the session's time zone; their names.

    The last load of each day stays, whatever its age. `before` must leave time to running loads
    and to readers that resolved a load before it was superseded. Entries stay.
    """
    path = path.rstrip("/")
    current = {load.folder for load in newest(published(spark, path)).values()}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    folder = F.regexp_extract("path", r"/((?:[^/=]+=[^/]*/)?load=[0-9a-f]+)/[^/]*$", 1)
    ages = files.select(folder.alias("folder"), "modificationTime", "length").where("folder != ''").groupBy("folder")
    old = ages.agg(F.max("modificationTime").alias("last"), F.sum("length").alias("bytes"))
    old = old.where((F.col("last") < F.lit(before)) & (F.col("bytes") > 0))
    stale = sorted(row.folder for row in old.select("folder").collect() if row.folder not in current)
    for name in stale:
        spark.range(0).select(F.lit("").alias("nothing")).write.mode("overwrite").text(f"{path}/{name}")
    return stale
