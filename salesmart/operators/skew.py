"""Left join that holds up when one key has a large part of all rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How a left join is worked out: by the size of the right side, or as told.
AUTO = "auto"
BROADCAST = "broadcast"
SALTED = "salted"

ROWS = "_rows"


def _optimized(df: DataFrame):
    return df._jdf.queryExecution().optimizedPlan()


def planned_bytes(df: DataFrame) -> int:
    """The size Spark's planner works with when it decides on a broadcast."""
    return int(str(_optimized(df).stats().sizeInBytes()))


def scanned_bytes(df: DataFrame) -> int:
    """The size of the tables a plan reads."""
    leaves = _optimized(df).collectLeaves()
    return sum(
        int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())
    )


def measured_bytes(df: DataFrame, extra: int = 0) -> int:
    """The size of the rows themselves, counted in one pass: text, a word per column, and
    `extra` bytes for what will be added to each row."""
    words = 8 * (len(df.columns) + 1) + extra
    texts = [
        F.coalesce(F.octet_length(f.name), F.lit(0))
        for f in df.schema
        if isinstance(f.dataType, T.StringType)
    ]
    width = sum(texts, F.lit(words).cast("long"))
    return df.agg(F.sum(width)).first()[0] or 0


# The size suffixes that Spark's settings take.
UNITS = {"": 1, "b": 1, "k": 2**10, "kb": 2**10, "m": 2**20, "mb": 2**20, "g": 2**30, "gb": 2**30}


def broadcast_limit(df: DataFrame) -> int:
    """spark.sql.autoBroadcastJoinThreshold in bytes; -1 means never."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    number = text.rstrip("kmgb")
    return int(number) * UNITS[text[len(number) :]]


def fits_broadcast(df: DataFrame, extra: int = 0, measure_up_to: int = 10) -> bool:
    """Whether a side is known to be within the broadcast limit.

    The planner multiplies the sizes of both sides of a join, so it takes any joined side
    for huge. Such a side is measured, in one job, unless the tables it reads are more than
    `measure_up_to` times the limit already; then it is taken to be too large.
    """
    limit = broadcast_limit(df)
    if planned_bytes(df) <= limit:
        return True
    if scanned_bytes(df) > measure_up_to * limit:
        return False
    return measured_bytes(df, extra) <= limit


def way_to_join(right: DataFrame, how: str = AUTO, extra: int = 0) -> str:
    """BROADCAST or SALTED; AUTO decides by the size of the right side."""
    if how == AUTO:
        return BROADCAST if fits_broadcast(right, extra) else SALTED
    if how not in (BROADCAST, SALTED):
        raise ValueError(f"no way to join: {how}")
    return how


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def key_counts(df: DataFrame, key: str, weight: Column | None = None) -> DataFrame:
    """Rows for each key, NULL too. With a weight, each row stands for that many."""
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(key).agg(rows.alias(ROWS))


Heavy = list[tuple[object, int]]


def heavy_keys(counts: DataFrame, key: str, partitions: int) -> Heavy:
    """Keys with more rows than an even partition has, and how many salts each one needs.

    At most `partitions` keys can pass the bar, whatever the data holds, and the salts of
    all of them add up to at most twice that. No key has more salts than rows, as the other
    side's rows are repeated for each. NULL counts as a key. They are collected by one
    job over the counts, so that the joins know them without counting again, and so that
    nothing is salted where nothing is heavy.
    """
    total = Observation()
    counted = counts.select(F.col(key).alias("key"), ROWS).observe(total, F.sum(ROWS).alias("rows"))
    most = counted.orderBy(F.desc(ROWS)).limit(partitions).collect()
    even = max((total.get["rows"] or 0) / partitions, 1)
    return [(row["key"], math.ceil(row[ROWS] / even)) for row in most if row[ROWS] > even]


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    heavy_left: Heavy,
    heavy_right: Heavy,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """`left.join(right, key, "left")` with the rows of heavy keys spread over many tasks.

    Only heavy keys get more than one salt: the left rows of a key heavy on the left are dealt
    out to its salts and the right rows of that key repeated for each; a key heavy on the right
    the other way round. A left row repeated so must not come out unmatched where another salt
    holds its match; such a key is known to be on the right, so its unmatched rows are dropped.
    Each side is scanned once and shuffled once.

    A NULL key never matches, so right rows without a key are left out.

    A salt is a hash of the key, the columns `spread_by` that the side has, and the partition
    a row is read in, not a random number, so a task run again after an executor is lost puts
    every row where it was before. Rows that are copies are spread too, by partition.
    """
    salts = []
    heavy_right = [(value, n) for value, n in heavy_right if value is not None]
    right = right.where(F.col(key).isNotNull())
    if heavy_left:
        left = _dealt(_with_salts(left, heavy_left, key), key, "_left_salt", spread_by)
        right = _repeated(_with_salts(right, heavy_left, key), "_left_salt").drop("_salts")
        salts.append("_left_salt")
    if heavy_right:
        right = _dealt(_with_salts(right, heavy_right, key), key, "_right_salt", spread_by)
        right = right.withColumn("_match", F.lit(True))
        left = _repeated(_with_salts(left, heavy_right, key), "_right_salt")
        salts.append("_right_salt")
    joined = left.join(right, [key, *salts], "left")
    if heavy_right:
        joined = joined.where((F.col("_salts") == 1) | F.col("_match").isNotNull())
        joined = joined.drop("_salts", "_match")
    return joined.drop(*salts)


def _dealt(df: DataFrame, key: str, salt: str, spread_by: Sequence[str]) -> DataFrame:
    row = F.xxhash64(key, *[c for c in spread_by if c in df.columns], F.spark_partition_id())
    return df.withColumn(salt, F.pmod(row, F.col("_salts")).cast("int")).drop("_salts")


def _repeated(df: DataFrame, salt: str) -> DataFrame:
    return df.withColumn(salt, F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))


def _with_salts(df: DataFrame, heavy: Heavy, key: str) -> DataFrame:
    """df with its keys' numbers of salts, 1 for a key that is not heavy.

    There is a heavy key for each shuffle partition at most, so they may be broadcast whatever
    the data size.
    """
    kind = df.schema[key].dataType.simpleString()
    few = df.sparkSession.createDataFrame(heavy, f"_heavy_key {kind}, _salts int")
    found = df.join(F.broadcast(few), F.col(key).eqNullSafe(F.col("_heavy_key")), "left")
    return found.withColumn("_salts", F.coalesce("_salts", F.lit(1))).drop("_heavy_key")


def left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    *,
    how: str = AUTO,
    left_counts: DataFrame | None = None,
    right_counts: DataFrame | None = None,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Left outer join on one column that both sides name alike.

    A right side within the session's broadcast limit is broadcast, and the left side does
    not move. Beyond that both sides are shuffled, with the keys that the counts show to be
    heavy salted; a side without counts has each key once. All ways give the same rows.
    """
    if way_to_join(right, how) == BROADCAST:
        return left.join(F.broadcast(right), key, "left")
    partitions = shuffle_partitions(left)
    heavy = [heavy_keys(c, key, partitions) if c is not None else [] for c in (left_counts, right_counts)]
    return salted_left_join(left, right, key, *heavy, spread_by)
