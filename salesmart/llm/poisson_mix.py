"""Mixing sources to target weights by Poisson replication.

A source's rate is its target share of the corpus over its actual one, times `size`. Each
document draws a uniform number from a hash of the seed and its id; the inverse of the Poisson
distribution with the source's rate turns it into a number of copies. A rate above MAX_RATE is
split into equal parts of MAX_RATE at most, each with a draw of its own from a hash of seed, id and
part: the sum of the draws has the Poisson distribution with the whole rate. The copies are shuffled
globally: each has a hash of seed, id and copy as its key, by which rows are dealt to partitions
and sorted inside them. All draws depend on ids alone, so a rerun or a lost task repeats them.

Documents with such rates are dealt anew by CHUNK_COPIES of their copies, so that one of them does
not make all its copies in one task.

Counts are taken over all documents, once. There is a row of counts for each source; they are
broadcast only where there are MAX_BROADCAST_SOURCES of them at most, else joined by shuffle, but
for sources with a large part of all rows, whose documents do not move.

Defined cases: a null source is a source of its own, named by null in `weights`; a source without
a target weight has rate 0, so its documents go; a null id draws like the text `null`; rows that
repeat an id draw the same number of copies; weights must be finite and not negative. An empty
table gives no rows. Columns named like a result are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import skewed_join, stored

MAX_BROADCAST_SOURCES = 10_000
# The inverse is summed to this many copies; what lies beyond has a probability below 1e-12 for
# rates of one draw up to MAX_RATE, which a hash of 52 bits hardly tells from 0.
MAX_RATE = 100.0
MAX_COPIES = 190
CHUNK_COPIES = 100
DRAW = ("rate", "copies", "copy", "mix_key")


def uniform(seed: int, *columns: str | Column) -> Column:
    """A number in (0, 1) from the first 52 bits of an MD5 digest."""
    values = [F.col(c) if isinstance(c, str) else c for c in columns]
    named = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("null")) for c in values])
    bits = F.conv(F.substring(F.md5(named), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 52)


def inverse_poisson(u: Column, rate: Column) -> Column:
    """The least k at which the Poisson distribution function reaches u."""
    # u goes through the state: as part of the step it would be hashed again in each.
    start = F.struct(u.alias("u"), F.lit(0).alias("k"), F.exp(-rate).alias("term"), F.exp(-rate).alias("total"))

    def step(s: Column, _: Column) -> Column:
        term = s["term"] * rate / (s["k"] + 1)
        more = F.struct(s["u"].alias("u"), (s["k"] + 1).alias("k"), term.alias("term"), (s["total"] + term).alias("total"))
        return F.when(s["total"] < s["u"], more).otherwise(s)

    steps = F.sequence(F.lit(1), F.least(F.lit(MAX_COPIES), F.ceil(rate + 9 * F.sqrt(rate) + 12).cast("int")))
    return F.aggregate(steps, start, step, lambda s: s["k"])


def inverse_in_parts(seed: int, rate: Column) -> Column:
    """The sum of as many draws as a rate above MAX_RATE has parts."""
    parts = F.ceil(rate / MAX_RATE).cast("int")
    draw = lambda total, part: total + inverse_poisson(uniform(seed, "doc_id", part), rate / parts)
    return F.aggregate(F.sequence(F.lit(1), parts), F.lit(0), draw)


def rates(docs: DataFrame, weights: dict[str | None, float] | None, size: float) -> DataFrame:
    """(source, n, rate) for each source. Without weights all sources get the same share."""
    counts = stored(docs.groupBy("source").agg(F.count(F.lit(1)).alias("n")), "sources")
    if weights is None:
        weighted = counts.withColumn("weight", F.lit(1.0))
    else:
        if any(not math.isfinite(w) or w < 0 for w in weights.values()):
            raise ValueError("weights must be finite and not negative")
        rows = [(name, float(w)) for name, w in weights.items()] or [(None, 0.0)]
        table = docs.sparkSession.createDataFrame(rows, "_name string, weight double")
        table = F.broadcast(table) if len(rows) <= MAX_BROADCAST_SOURCES else table
        weighted = counts.join(table, counts.source.eqNullSafe(table._name), "left").drop("_name")
        weighted = weighted.withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    totals = weighted.agg(F.sum("n").alias("rows"), F.sum("weight").alias("weights")).first()
    share = F.col("weight") * float(size * (totals["rows"] or 0)) / float(totals["weights"] or 1)
    return weighted.select("source", "n", (share / F.col("n")).alias("rate"))


def mixed(docs: DataFrame, weights: dict[str | None, float] | None = None, *, size: float = 1.0, seed: int = 42, with_draw: bool = True) -> DataFrame:
    """Copies of docs in a global shuffle, with_draw with their rate, copies, copy (from 0) and
    mix_key.

    `size` is the expected number of rows of the result over that of docs.
    """
    table = rates(docs, weights, size)
    seen = table.agg(F.count(F.lit(1)).alias("n"), F.max("rate").alias("most")).first()
    # A null source is a key like any other.
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("_source")
    sources = table.select(key, F.col("n").alias("_n"), F.col("rate").alias("_rate"))
    keyed = docs.select("*", key)
    if seen["n"] <= MAX_BROADCAST_SOURCES:
        rated = keyed.join(F.broadcast(sources), "_source").drop("_source", "_n")
    else:
        rated = skewed_join(keyed, stored(sources, "rates"), "_source", "_n").drop("_source", "_n")
    few = rated if (seen["most"] or 0) <= MAX_RATE else rated.where(F.col("_rate") <= MAX_RATE)
    drawn = few.withColumn("_copies", inverse_poisson(uniform(seed, "doc_id"), F.col("_rate")))
    # A filter on the number of copies, or that of a plain explode, would have it worked out again.
    numbers = F.when(F.col("_copies") > 0, F.sequence(F.lit(0), F.col("_copies") - 1))
    copied = drawn.withColumn("_copy", F.explode_outer(numbers)).where("_copy is not null")
    if (seen["most"] or 0) > MAX_RATE:
        many = rated.where(F.col("_rate") > MAX_RATE).withColumn("_copies", inverse_in_parts(seed, F.col("_rate")))
        starts = F.when(F.col("_copies") > 0, F.sequence(F.lit(0), F.col("_copies") - 1, F.lit(CHUNK_COPIES)))
        dealt = many.withColumn("_start", F.explode_outer(starts)).where("_start is not null").repartition("doc_id", "_start")
        chunk = F.sequence("_start", F.least(F.col("_start") + CHUNK_COPIES, F.col("_copies")) - 1)
        copied = copied.unionByName(dealt.withColumn("_copy", F.explode(chunk)).drop("_start"))
    named = F.concat_ws(":", F.lit(f"{seed}-order"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("_copy").cast("string"))
    shuffled = copied.withColumn("_mix_key", F.md5(named)).repartition("_mix_key").sortWithinPartitions("_mix_key")
    if not with_draw:
        return shuffled.select(docs.columns)
    keep = [c for c in docs.columns if c.lower() not in DRAW]
    return shuffled.select(*keep, *[F.col(f"_{c}").alias(c) for c in DRAW])
