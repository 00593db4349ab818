"""SimHash near duplicates through an embedding of fingerprints into segment bit counts.

A fingerprint's 64 bits are cut into SEGMENTS segments; its embedding is their bit counts. The
Manhattan distance of two embeddings never exceeds the number of differing bits, so a range join
under it loses no link. The join runs over a grid: the segments form BANDS bands, and a pair
within MAX_BITS differs in MAX_BITS bands at most, so it shares the cell of all other bands. Each
fingerprint lies in one cell for each choice of the bands that may differ. Pairs of a cell pass the
Manhattan bound first and are then verified by their differing bits.

The grid grows with the data. BANDS are tried in turn: more bands share more of the embedding, so
their cells are finer, at more rows for a fingerprint. A table starts at the first number at which
unrelated fingerprints alone would not crowd a cell; fingerprints that share a cell with more than
CELL_ROWS form no pairs there and go on to the next number, which keeps every pair of them within
MAX_BITS together. What the finest grid leaves crowded are dense clusters. Their members meet at
centres: two fingerprints differ in at most two bits if and only if some value lies within one bit
of both, so all members within one bit of a value are linked to the smallest of them, exactly.

Equal fingerprints are one row throughout, with their smallest document.
"""

from __future__ import annotations

import itertools
import math
from functools import reduce
from operator import add

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import add_columns, skewed_anti_join, skewed_join, stored, text_column
from salesmart.llm.components import components

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 2
SEGMENTS = 32
BANDS = (4, 8, 16)
CELL_ROWS = 32

FINGERPRINT = T.StructField("fp", T.LongType())


def shingle_hashes(text: str | None) -> list[int]:
    """XXH64 of each shingle of a text; bytes.split parts at the ASCII white space only."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    if len(words) < SHINGLE_WORDS:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    digest = xxhash.xxh64_intdigest
    columns = [words[i:] for i in range(SHINGLE_WORDS)]
    return [digest(b" ".join(s), SEED) for s in zip(*columns, strict=False)]


def fingerprint(hashes: list[int]) -> int:
    """Each bit is 1 if more than half of the hashes set it; signed, as Spark's long is."""
    if not hashes:
        return 0
    array = np.array(hashes, np.uint64)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(array), 65536):
        part = array[start : start + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    bits = np.packbits((2 * ones > len(array)).astype(np.uint8))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, *, text: str = "text", without: list[str] | None = None) -> DataFrame:
    """docs with `fp`, the fingerprint as a long. A null text and one without words have 0."""

    def make(values: list) -> dict[str, list]:
        return {"fp": [fingerprint(shingle_hashes(v)) for v in values]}

    return add_columns(text_column(docs, text), text, make, [FINGERPRINT], without=without or [])


def bit_counts(fp: str) -> list[Column]:
    """Bit counts of the segments of column `fp`, highest bits first."""
    width = 64 // SEGMENTS
    return [
        F.bit_count(F.shiftrightunsigned(fp, 64 - width * (i + 1)).bitwiseAND(2**width - 1))
        for i in range(SEGMENTS)
    ]


def manhattan(a: str, b: str) -> Column:
    """Distance of two fingerprints' embeddings: a lower bound of their differing bits."""
    return reduce(add, [F.abs(x - y) for x, y in zip(bit_counts(a), bit_counts(b), strict=True)])


def first_bands(n: int) -> int:
    """The index of the first of BANDS whose cells hold half of CELL_ROWS of `n` unrelated
    fingerprints at most; the last one if none does."""
    width = 64 // SEGMENTS
    same = sum(math.comb(width, ones) ** 2 for ones in range(width + 1)) / 4**width  # equal bit counts
    for i, bands in enumerate(BANDS):
        if n * same ** (SEGMENTS - MAX_BITS * SEGMENTS // bands) <= CELL_ROWS / 2:
            return i
    return len(BANDS) - 1


def grid(fps: DataFrame, bands: int) -> DataFrame:
    """(cell, fp): a row for each choice of the MAX_BITS bands that may differ.

    The bit counts are digits of one number to the base 64 / SEGMENTS + 1. A cell is that number
    without the digits of the bands that may differ, and the number of the choice in front, so
    equal cells are equal coordinates, not equal hashes.
    """
    base, per_band = 64 // SEGMENTS + 1, SEGMENTS // bands
    digits = [n.cast("long") * base**i for i, n in enumerate(bit_counts("fp"))]
    parts = [reduce(add, digits[i * per_band : (i + 1) * per_band]).alias(f"band{i}") for i in range(bands)]
    names = [f"band{i}" for i in range(bands)]
    embedded = fps.select("fp", *parts).select("fp", *names, reduce(add, map(F.col, names)).alias("all"))
    cells = [
        F.col("all") - reduce(add, [F.col(f"band{i}") for i in choice]) + F.lit(n * base**SEGMENTS).cast("long")
        for n, choice in enumerate(itertools.combinations(range(bands), MAX_BITS))
    ]
    return embedded.select(F.explode(F.array(*cells)).alias("cell"), "fp")


def links(fps: DataFrame, n: int | None = None) -> DataFrame:
    """(a, b): links that join all of `fps` (distinct, column fp, `n` rows) within MAX_BITS bits.

    Pairs from ordinary cells are all there; those of clusters that crowd the finest grid are
    joined through their centres. What is reachable is the same as over all pairs.
    """
    found = []
    left = fps
    for bands in BANDS[first_bands(fps.count() if n is None else n) :]:
        cells = stored(grid(left, bands), "cells")
        shared = stored(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
        met = stored(skewed_join(cells, shared, "cell", "n"), "met")
        few = met.where(F.col("n") <= CELL_ROWS)
        pairs = few.select("cell", F.col("fp").alias("a")).join(few.select("cell", F.col("fp").alias("b")), "cell")
        in_range = pairs.where("a < b").where(manhattan("a", "b") <= MAX_BITS)
        verified = in_range.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS)
        found.append(verified.select("a", "b"))
        crowded = met.where(F.col("n") > CELL_ROWS).select("fp").distinct()
        if crowded.isEmpty():
            return reduce(DataFrame.union, found).distinct()
        left = stored(crowded, "crowded")
    return reduce(DataFrame.union, [*found, through_centres(left)]).distinct()


def through_centres(fps: DataFrame) -> DataFrame:
    """(a, b): each of `fps` with the smallest that lies within one bit of the same value."""
    flips = [F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)]]
    around = stored(fps.select(F.explode(F.array(*flips)).alias("centre"), "fp"), "centres")
    least = around.groupBy("centre").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    met = skewed_join(around, stored(least, "least"), "centre", "n")
    return met.where("a != fp").select("a", F.col("fp").alias("b"))


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) for each row of docs.

    component_id is the smallest id reachable over links of MAX_BITS differing bits or fewer,
    the row's own included. A row without an id joins its group but cannot name it; a group
    without any id has a null component. Repeated rows are repeated. No row in, no row out.
    """
    marked = fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), without=["text"])
    marked = stored(marked, "fingerprints")
    each = marked.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    fps = stored(each, "distinct")
    reached = components(links(fps.select("fp"))).select(F.col("node").alias("fp"), "component")
    grouped = stored(fps.join(reached, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "grouped")
    named = grouped.groupBy("component").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("n"))
    joined = skewed_join(grouped, stored(named, "named"), "component", "n")
    names = stored(joined.select("fp", "copies", "component_id"), "names")
    return skewed_join(marked, names, "fp", "copies").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs without those that are near duplicates of a document with a smaller doc_id.

    Rows with the same doc_id stay or go together; rows without one stay.
    """
    repeated = F.max(F.coalesce(F.col("doc_id") != F.col("component_id"), F.lit(False)))
    ids = near_duplicates(docs).groupBy("doc_id").agg(repeated.alias("repeated"), F.count(F.lit(1)).alias("n"))
    return skewed_anti_join(docs, stored(ids, "ids"), "doc_id", "n", "repeated")
