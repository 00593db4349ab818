"""Phrases whose words keep together, by set-oriented relational mining (SETM).

A text is split into pieces and a piece into words. The occurrences of the phrases of one length
are a relation (doc, piece, pos, item): one row for each, `item` being the phrase's code. It is
persisted in buckets by doc, each sorted by doc, piece and pos. The relation of the next length
comes from a merge join of the relation with itself, by piece and adjacent position: an
occurrence of `a b` at 3 and one of `b c` at 4 make `a b c` at 3. Its rows are counted by group,
and only those of frequent groups (a semi-join) are persisted and extended further. As every part
of a frequent phrase is frequent, nothing is lost.

Documents are shuffled once, as whole texts; buckets meet without a shuffle after that. Only
counts move: a pair of codes once for each task that has it. Words get a 64-bit hash, which is
checked over the whole vocabulary: if another word shares the hash of a frequent one, the next
seed is tried, so codes are exact.

Everything is per language. `n` is the number of all word occurrences, `f` of a phrase all its
occurrences within pieces, overlaps included. A phrase of 2 words or more is cut after each of its
words but the last: l = f(first part), r = f(rest), score = floor(1000 * a * n / (l * r)) in
decimal arithmetic. The lowest-scoring cut counts, ties to the smallest first part.

A candidate goes if a longer one that contains it has `SHARE` percent of its count or more. It is
enough to look at those one word longer: what is between the two has a count between theirs.

Defined cases: a null text is empty, a null language is `und`; empty texts have no words; repeated
rows count each, whatever their id; no frequent phrase gives no row. A text of any length is one
row and its pieces lie in one bucket. Columns other than text and language are not used.
"""

from __future__ import annotations

import itertools
import math
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.llm.common import shared_folder, skewed_join, stored

PIECE_MARKS = r"[.,;:!?\x0A-\x0D]"
MAX_WORDS = 5
LEAST = 100
SHARE = 100
FIRST = 2000
SEED = 42
# Frequent groups are broadcast up to this number of rows of three words each, about 100 MB as a
# hash table; beyond it their occurrences are shuffled to them.
BROADCAST_GROUPS = 1_000_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


def ascii_lower(word: Column) -> Column:
    """A-Z lowered and nothing else; `lower` does just that to words without other letters."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def tokens(docs: DataFrame) -> DataFrame:
    """(doc, lang, piece, pos, word) for each word of (doc, lang, text)."""
    pieces = F.posexplode(F.split(F.coalesce("text", F.lit("")), PIECE_MARKS)).alias("piece", "part")
    words = F.array_remove(F.split(F.replace("part", F.lit("\t"), F.lit(" ")), " "), "")
    cut = docs.select("doc", "lang", pieces).select("doc", "lang", "piece", F.posexplode(words).alias("pos", "word"))
    return cut.withColumn("word", ascii_lower(F.col("word")))


def word_hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "lang", "word")


def vocabulary(docs: DataFrame, least: int) -> tuple[DataFrame, int]:
    """(lang, word, a), stored, and a seed by which no word has the hash of a frequent one."""
    words = tokens(docs).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("a"))
    words = stored(words, "vocabulary")
    for seed in itertools.count(SEED):
        hashes = words.groupBy(word_hash(seed).alias("hash")).agg(F.count(F.lit(1)).alias("words"), F.max("a").alias("a"))
        if hashes.where((F.col("words") > 1) & (F.col("a") >= least)).limit(1).count() == 0:
            return words, seed


class Relations:
    """Occurrence relations of one run: tables in buckets by doc, sorted, dropped at the end."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.names: list[str] = []

    def persist(self, rows: DataFrame) -> DataFrame:
        """rows (doc, piece, pos, item), already dealt out by doc, as such a table."""
        name = f"setm_occurrences_{uuid.uuid4().hex}"
        self.names.append(name)
        writer = rows.select("doc", "piece", "pos", "item").write.format("parquet")
        writer = writer.bucketBy(self.buckets, "doc").sortBy("doc", "piece", "pos")
        writer.option("path", f"{shared_folder(self.spark)}/{name}").saveAsTable(name)
        return self.spark.table(name)

    def drop(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


@contextmanager
def buckets_meet(spark: SparkSession):
    """Let a join by doc, piece and position take buckets by doc alone as they lie."""
    before = spark.conf.get(CO_PARTITION)
    spark.conf.set(CO_PARTITION, "false")
    try:
        yield
    finally:
        spark.conf.set(CO_PARTITION, before)


def adjacent(rows: DataFrame) -> DataFrame:
    """(doc, piece, pos, first, rest): the merge join of a relation with itself."""
    left = rows.select("doc", "piece", "pos", F.col("item").alias("first"))
    right = rows.select("doc", "piece", (F.col("pos") - 1).alias("pos"), F.col("item").alias("rest"))
    return left.join(right.hint("merge"), ["doc", "piece", "pos"])


def frequent_only(rows: DataFrame, groups: DataFrame, key: Column, buckets: int) -> DataFrame:
    """The occurrences of `groups` (key, a, code), with the code as item; dealt out by doc."""
    keyed = rows.withColumn("key", key)
    codes = groups.select(key.alias("key"), "a", F.col("code").alias("item"))
    if groups.count() <= BROADCAST_GROUPS:
        return keyed.join(F.broadcast(codes.drop("a")), "key")
    return skewed_join(keyed, codes, "key", "a").repartition(buckets, "doc")


def coded(groups: DataFrame, name: str) -> DataFrame:
    """Frequent groups with a code each, written at once so that it never changes."""
    return stored(groups.withColumn("code", F.monotonically_increasing_id()), name)


def mine(docs: DataFrame, *, max_words: int = MAX_WORDS, least: int = LEAST) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n) of (lang, text) rows, and for each length from 1 the frequent phrases.

    These have (code, lang, phrase, last, a, heads, tails, first, rest): `heads` and `tails` are
    the counts of the first and of the last 1, 2, ... words; `first` and `rest` are the codes of
    the phrase without its last and without its first word.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.monotonically_increasing_id().alias("doc"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.col("text").cast("string").alias("text"),
    )
    words, seed = vocabulary(texts, least)
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))
    counts = F.array("a")
    none = F.lit(None).cast("long")
    singles = words.where(F.col("a") >= least).select(
        "lang", "word", F.col("word").alias("phrase"), F.col("word").alias("last"), "a",
        counts.alias("heads"), counts.alias("tails"), none.alias("first"), none.alias("rest"),
    )
    found = [coded(singles, "words")]
    relations = Relations(spark)
    try:
        with buckets_meet(spark):
            dealt = texts.repartition(relations.buckets, "doc").sortWithinPartitions("doc")
            rows = frequent_only(tokens(dealt), found[0], word_hash(seed), relations.buckets)
            rows = relations.persist(rows)
            for n_words in range(2, max_words + 1):
                pairs = adjacent(rows)
                counted = pairs.groupBy("first", "rest").agg(F.count(F.lit(1)).alias("a")).where(F.col("a") >= least)
                groups = coded(counted, f"groups-{n_words}")
                found.append(stored(spelled(groups, found[-1]), f"phrases-{n_words}"))
                if n_words < max_words:
                    kept = frequent_only(pairs, groups, F.struct("first", "rest"), relations.buckets)
                    rows = relations.persist(kept)
    finally:
        relations.drop()
    return stored(totals, "totals"), found


def spelled(groups: DataFrame, shorter: DataFrame) -> DataFrame:
    """Frequent groups with their words and the counts of their first and last words."""
    first = shorter.select(F.col("code").alias("first"), "lang", "phrase", "heads")
    rest = shorter.select(F.col("code").alias("rest"), "last", "tails")
    known = groups.join(first, "first").join(rest, "rest")
    return known.select(
        "code", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "a",
        F.concat("heads", F.array("a")).alias("heads"), F.concat("tails", F.array("a")).alias("tails"), "first", "rest",
    )


def not_inside(phrases: DataFrame, longer: DataFrame, share: int = SHARE) -> DataFrame:
    """Phrases that no phrase one word longer contains with `share` percent of their count."""
    around = longer.select(F.col("first").alias("code"), "a").union(longer.select("rest", "a"))
    most = around.groupBy("code").agg(F.max("a").alias("most"))
    joined = phrases.join(most, "code", "left")
    return joined.where(F.coalesce(100 * F.col("most") < share * F.col("a"), F.lit(True))).drop("most")


def cut_scores(n_words: int) -> Column:
    """The lowest-scoring cut as a struct (score, cut, l, r)."""
    cuts = []
    for k in range(1, n_words):
        left, right = F.element_at("heads", k), F.element_at("tails", n_words - k)
        wide = [f"cast({x} as decimal(19,0))" for x in ("a", "n", f"element_at(heads, {k})", f"element_at(tails, {n_words - k})")]
        ratio = F.expr("cast(1000 as decimal(4,0)) * {} * {} div ({} * {})".format(*wide))
        cuts.append(F.struct(ratio.alias("score"), F.lit(k).alias("cut"), left.alias("l"), right.alias("r")))
    return F.array_min(F.array(*cuts)) if len(cuts) > 1 else cuts[0]


def first_by_language(rows: DataFrame, first: int) -> DataFrame:
    """The first rows of each language with their rank, without a language's rows in one task.

    Ranks are taken in parts of a language, then among what the parts leave, in fewer parts.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for n in (parts, math.isqrt(parts), 1):
        part = F.pmod(F.xxhash64("phrase"), F.lit(n))
        rank = F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))
        rows = rows.withColumn("rank", rank.cast("long")).where(F.col("rank") <= first)
    return rows


def phrases(
    docs: DataFrame, *, max_words: int = MAX_WORDS, least: int = LEAST, share: int = SHARE, first: int = FIRST
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `first` best phrases."""
    totals, found = mine(docs, max_words=max_words, least=least)
    kept = None
    for n_words in range(2, max_words + 1):
        rows = found[n_words - 1]
        if n_words < max_words:
            rows = not_inside(rows, found[n_words], share)
        rows = rows.select("lang", "phrase", "a", "heads", "tails", F.lit(n_words).alias("n_words"))
        kept = rows if kept is None else kept.union(rows)
    kept = stored(kept, "candidates")
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("weight"))
    joined = skewed_join(kept, stored(sizes.join(totals, "lang"), "sizes"), "lang", "weight")
    best = F.lit(None)
    for n_words in range(max_words, 1, -1):
        best = F.when(F.col("n_words") == n_words, cut_scores(n_words)).otherwise(best)
    scored = joined.withColumn("best", best).select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    ranked = first_by_language(scored, first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
