"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Vectors are dealt into blocks of about BLOCK_ROWS. In a block each dimension has a posting list
ordered by descending impact, cut into segments of equal quantised impact (the component without
its lowest LEVEL_BITS bits). A query takes segments by descending contribution, its own component
times the segment's bound, in rounds of falling levels, and adds them up in one accumulator for
each row. What a row can still gain in a dimension is the contribution of that dimension's next
segment, which gives each row an upper bound. The k-th best exact score so far is the threshold.
Rows whose bound lies below it are proved out. The search ends when so few rows are left that
scoring them exactly is less work than the segments not taken yet, or when all are taken; every
row left is then scored exactly. Nothing else drops a row, so the result is exact.

Blocks are searched in waves, FIRST_BLOCKS at first and WAVE_GROWTH times as many in each later
one. A query's k-th best score of the earlier waves is its threshold from the start of the next, so
later blocks prove most rows out at once and give no row that cannot be among the best: rows found
grow with the number of waves, a logarithm of the number of blocks. In a wave, groups of QUERY_ROWS
queries meet the blocks; a group of queries as large as a block keeps copies of either side low.

Equal vectors score alike, so of all rows with the same vector only those of its k + 1 smallest ids
are indexed, each k times at most: whatever id asks, k rows of others are among them, and ties go
to smaller ids. Blocks are dealt by id and vector, so neither a hot id nor a hot vector fills one.

Defined cases: vectors that are null or hold a null or non-finite component take no part, nor do
rows without an id; of repeated query ids the smallest vector asks; rows with the query's id are
its own and no candidates; other repeated ids are candidates each. Vectors of different length
are compared as if filled with zeros. Scores must fit 64 bits.
"""

from __future__ import annotations

import itertools
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import stored

SCALE = 1024
BLOCK_ROWS = 8192
QUERY_ROWS = 8192
FIRST_BLOCKS = 64
WAVE_GROWTH = 4
LEVEL_BITS = 4
# Levels of the rounds, as shares of a query's largest contribution; the last one takes all.
ROUNDS = (0.25, 0.0, -0.1, None)
SEED_ROWS = 64  # rows that are scored exactly in each round for a better threshold
MIN_SCORE = -(1 << 63)  # the threshold of a query without k rows yet: every score passes

INDEX = "block int, dim int, rows array<int>, impacts array<long>, vec_ids array<long>"
FOUND = "query_id long, vec_id long, score long"


def quantised(embedding: str = "embedding") -> Column:
    """floor(SCALE * x) of each component as a double."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))


def usable(embedding: str = "embedding") -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.col(embedding).isNotNull() & F.forall(embedding, lambda x: finite(x.cast("double")))


def dealt(rows: DataFrame, keys: list[str], size: int) -> tuple[Column, int]:
    """A block number by a hash of `keys`, and the number of blocks of about `size` rows."""
    blocks = max(1, -(-rows.count() // size))
    return F.pmod(F.xxhash64(*keys), F.lit(blocks)).cast("int"), blocks


def merged(vectors: DataFrame, k: int) -> DataFrame:
    """Those of the (vec_id, q) rows that can be among a query's k best: of each vector the k + 1
    smallest ids, each k times at most."""
    copies = vectors.groupBy("q", "vec_id").agg(F.count(F.lit(1)).alias("n"))
    first = F.row_number().over(Window.partitionBy("q").orderBy("vec_id"))
    able = copies.withColumn("nth", first).where(F.col("nth") <= k + 1)
    repeats = F.sequence(F.lit(1), F.least(F.col("n"), F.lit(k)).cast("int"))
    return able.select("vec_id", "q", F.explode(repeats).alias("copy"))


def _posting_lists(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    matrix = _matrix(rows["q"])
    order = np.argsort(-matrix, axis=0, kind="stable")
    dims = matrix.shape[1]
    return pd.DataFrame({
        "block": key[0],
        "dim": range(-1, dims),
        "rows": [None, *[order[:, d].astype(np.int32) for d in range(dims)]],
        "impacts": [None, *[matrix[order[:, d], d] for d in range(dims)]],
        "vec_ids": [rows["vec_id"].to_numpy(), *[None] * dims],
    })


def _matrix(vectors: pd.Series) -> np.ndarray:
    sizes = vectors.map(len)
    matrix = np.zeros((len(vectors), int(sizes.max())), np.int64)
    for n in sizes.unique():
        at = (sizes == n).to_numpy()
        matrix[at, :n] = np.array(vectors[at].tolist(), np.int64).reshape(at.sum(), n)
    return matrix


def build_index(vectors: DataFrame) -> tuple[DataFrame, int]:
    """The posting lists of (vec_id, q, copy), a row for each block and dimension and one (dim -1)
    for the ids of each block; and the number of blocks."""
    block, blocks = dealt(vectors, ["vec_id", "q", "copy"], BLOCK_ROWS)
    lists = vectors.withColumn("block", block).groupBy("block").applyInPandas(_posting_lists, INDEX)
    return stored(lists, "postings"), blocks


def waves(blocks: int) -> list[tuple[int, int]]:
    """The first block of each wave and the one after its last."""
    ends = [0]
    size = FIRST_BLOCKS
    while ends[-1] < blocks:
        ends.append(min(blocks, ends[-1] + size))
        size *= WAVE_GROWTH
    return list(itertools.pairwise(ends))


class Block:
    """Posting lists of one block, with the bounds of their segments."""

    def __init__(self, lists: pd.DataFrame):
        lists = lists.sort_values("dim")
        self.ids = np.asarray(lists["vec_ids"].iloc[0], np.int64)
        self.rows = [np.asarray(r, np.int64) for r in lists["rows"].iloc[1:]]
        impacts = [np.asarray(x, np.int64) for x in lists["impacts"].iloc[1:]]
        self.matrix = np.zeros((len(self.ids), len(self.rows)), np.int64)
        for d, (rows, values) in enumerate(zip(self.rows, impacts, strict=True)):
            self.matrix[rows, d] = values
        self.largest = int(np.abs(self.matrix).max(initial=0))
        levels = [x >> LEVEL_BITS for x in impacts]
        # bounds of the segment that each posting lies in; reversed for a negative component
        self.top = [((x + 1) << LEVEL_BITS) - 1 for x in levels]
        self.bottom = [(x << LEVEL_BITS)[::-1] for x in levels]
        self.backward = [r[::-1] for r in self.rows]

    def scores(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact scores; whole numbers below 2 ** 53 are exact as doubles, which are faster."""
        if self.largest * int(np.abs(q).max(initial=0)) * max(1, len(q)) < 1 << 53:
            return (self.matrix[rows].astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
        return self.matrix[rows] @ q

    def search(self, query_id: int, q: np.ndarray, k: int, least: int = MIN_SCORE) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the k best rows that score `least` or more, ties to smaller ids."""
        dims = self.matrix.shape[1]
        q = np.pad(q, (0, max(0, dims - len(q))))[:dims]
        others = np.flatnonzero(self.ids != query_id)
        possible = self._possible(q, k, others, least) if q.any() else others
        scores = self.scores(possible, q)
        possible, scores = possible[scores >= least], scores[scores >= least]
        best = np.lexsort((self.ids[possible], -scores))[:k]
        return self.ids[possible][best], scores[best]

    def _possible(self, q: np.ndarray, k: int, alive: np.ndarray, threshold: int) -> np.ndarray:
        """Those of the rows `alive` that may be among their k best and reach the threshold."""
        used = np.flatnonzero(q)
        lists = [(self.rows[d], self.top[d]) if q[d] > 0 else (self.backward[d], self.bottom[d]) for d in used]
        gains = [q[d] * bounds for d, (_, bounds) in zip(used, lists, strict=True)]  # descending
        first, last = max(g[0] for g in gains), min(g[-1] for g in gains)
        gained = np.zeros(len(self.ids), np.int64)
        taken = [0] * len(used)
        for share in ROUNDS:
            level = last if share is None else first * share
            rest = 0  # what a row can still gain at most
            for i, ((rows, _), gain) in enumerate(zip(lists, gains, strict=True)):
                end = len(gain) - int(gain[::-1].searchsorted(level))
                if end > taken[i]:
                    gained[rows[taken[i] : end]] += gain[taken[i] : end]
                    taken[i] = end
                if end < len(gain) and gain[end] > 0:
                    rest += gain[end]
            bound = gained[alive] + rest
            if len(alive) > SEED_ROWS >= k:
                lead = alive[np.argpartition(-bound, SEED_ROWS)[:SEED_ROWS]]
                threshold = max(threshold, np.partition(self.scores(lead, q), -k)[-k])
            alive = alive[bound >= threshold]
            left = sum(map(len, gains)) - sum(taken)
            if len(alive) * len(used) <= left:
                break  # scoring the rest exactly takes less than adding up further segments
        return alive


def _search(key: tuple, lists: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    if lists.empty or queries.empty:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
    block = Block(lists)
    asked = zip(queries["query_id"], queries["q"], queries["least"], strict=True)
    found = [(query, *block.search(query, np.asarray(q, np.int64), k, int(least))) for query, q, least in asked]
    return pd.DataFrame({
        "query_id": np.repeat([f[0] for f in found], [len(f[1]) for f in found]),
        "vec_id": np.concatenate([f[1] for f in found]),
        "score": np.concatenate([f[2] for f in found]),
    })


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score) from (vec_id, embedding) rows on both sides."""
    known = F.col("vec_id").isNotNull() & usable()
    usable_rows = vectors.where(known).select(F.col("vec_id").cast("long"), quantised().alias("q"))
    index, blocks = build_index(stored(merged(usable_rows, k), "vectors"))
    asked = queries.where(known).groupBy(F.col("vec_id").cast("long").alias("query_id")).agg(F.min(quantised()).alias("q"))
    asked = stored(asked, "queries")
    part, parts = dealt(asked, ["query_id"], QUERY_ROWS)
    asked = asked.withColumn("part", part)
    search = lambda key, lists, rows: _search(key, lists, rows, k)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    best: list[DataFrame] = []  # the k best of all waves so far
    for start, end in waves(blocks):
        limits = asked.withColumn("least", F.lit(MIN_SCORE).cast("long"))
        if best:
            full = best[0].where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
            limits = asked.join(full, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(MIN_SCORE).cast("long")))
        among = (F.col("block") >= start) & (F.col("block") < end)
        left = index.where(among).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        right = limits.withColumn("block", F.explode(F.sequence(F.lit(start), F.lit(end - 1))))
        found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(search, FOUND)
        every = reduce(DataFrame.unionByName, [found, *(b.drop("rank") for b in best)])
        ranked = every.withColumn("rank", place).where(F.col("rank") <= k)
        best = [ranked if end == blocks else stored(ranked, "best")]
    return best[0].select("query_id", "rank", "vec_id", "score")
