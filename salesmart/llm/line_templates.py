"""Line dedup by a log-template tree of fixed depth.

A line is parsed down the tree by its number of words, then by its LEADING first words; below
that leaf its other words form the template. Words with a digit are variable fields everywhere.
In lines of LONG_LINE words or more any one quarter of the other words may vary as well: such a
line belongs to PARTS open templates, each with one quarter left open, and to a closed one.

A template recurs if it is in lines of MIN_DOCS documents, or SHORT_MIN_DOCS for lines of fewer
than SHORT_LINE words, which also clean texts share by chance; a line of one word never counts.
All lines of a recurring template are dropped but for those of its document with the smallest id.

A line that differs from one in one quarter may differ from another in a second one, and lines two
steps apart are no copies. So an open template drops lines only where a line that surely stays
stands for it: one in its first document that no open template finds in an earlier document. Then
no passage is lost altogether: a dropped line has a copy, or a line with one other quarter, that
stays.

Templates are compared by 64-bit hashes. Everything is SQL functions.

Defined cases: a null text stays null, an empty one empty; lines without a word are kept; rows
without an id are neither counted nor changed; rows that repeat an id are one document. Documents
that lose all lines stay, with an empty text. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import skewed_join, stored

LEADING = 3
PARTS = 4
LONG_LINE = 20
SHORT_LINE = 5
MIN_DOCS = 2
SHORT_MIN_DOCS = 50

SPACES = r"[\x20\x09-\x0D]+"
FIELD = r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*"
UNEVEN = r"[\x09-\x0D]|\x20\x20"
OPEN = "<*>"
# The lowest bits of a template: it is of a short line, or it has an open quarter.
SHORT_BIT, OPEN_BIT = 1, 2


def templates(lines: Column) -> Column:
    """For each line of an array the hashes of the templates it belongs to, the closed one last;
    none for one word.

    The lowest bits tell their kind. Each step is an array of its own, as a
    value used twice inside one step would be worked out twice.
    """
    nodes = F.transform(F.transform(F.transform(lines, _masked), _words), _node)
    return F.transform(nodes, _line_templates)


def _masked(line: Column) -> Column:
    """A line without white space at its ends, variable fields as OPEN."""
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, FIELD, OPEN)).otherwise(line)
    return F.btrim(masked, F.lit(" \t\n\x0b\x0c\r"))


def _words(line: Column) -> Column:
    """Words of a trimmed line; one without any has one empty word. Splitting at single spaces
    is several times faster than at a pattern, and does for most lines."""
    return F.when(line.rlike(UNEVEN), F.split(line, SPACES)).otherwise(F.split(line, " "))


def _node(tokens: Column) -> Column:
    """Number of words, leaf, and the hashes of the quarters of a long line or of a whole one."""
    n = F.size(tokens)
    rest = n - LEADING
    starts = [F.floor(rest * i / PARTS).cast("int") for i in range(PARTS + 1)]
    quarters = [F.xxhash64(F.slice(tokens, a + (LEADING + 1), b - a)) for a, b in zip(starts, starts[1:], strict=False)]
    leaf = F.xxhash64(n, F.slice(tokens, 1, LEADING))
    parts = F.when(n >= LONG_LINE, F.array(*quarters)).otherwise(F.array(F.xxhash64(tokens)))
    return F.struct(n.alias("n"), leaf.alias("leaf"), parts.alias("parts"))


def _line_templates(node: Column) -> Column:
    n, leaf, parts = node["n"], node["leaf"], node["parts"]
    opened = [F.xxhash64(leaf, F.lit(i), *[parts[j] for j in range(PARTS) if j != i]) for i in range(PARTS)]
    whole = F.xxhash64(leaf, parts[0]).bitwiseAND(-4)
    closed = F.xxhash64(leaf, *[parts[j] for j in range(PARTS)]).bitwiseAND(-4)
    none = F.array().cast("array<bigint>")
    return (
        F.when(n >= LONG_LINE, F.array(*[h.bitwiseAND(-4).bitwiseOR(OPEN_BIT) for h in opened], closed))
        .when(n >= SHORT_LINE, F.array(whole))
        .when(n >= 2, F.array(whole.bitwiseOR(SHORT_BIT)))
        .otherwise(none)
    )


def recurring(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, drop): for each document that loses lines, the templates they belong to."""
    lines = F.split(F.col(text).cast("string"), "\n")
    # A plain explode would filter by the array's size first, and so have it worked out twice.
    by_line = docs.where("doc_id is not null").select("doc_id", F.explode_outer(templates(lines)).alias("of"))
    exploded = by_line.select("doc_id", F.explode_outer("of").alias("t"), F.element_at("of", -1).alias("line"))
    seen = stored(exploded.where("t is not null"), "lines")
    met = stored(skewed_join(seen, stored(_known(seen), "templates"), "t", "n"), "met")

    is_open, later = F.col("t").bitwiseAND(OPEN_BIT) != 0, F.col("doc_id") != F.col("first")
    unsure = met.where(is_open & later).select("doc_id", "line").distinct()
    stand_for = met.where(is_open & ~later).join(unsure, ["doc_id", "line"], "left_anti")
    sure = stored(stand_for.groupBy("t").agg(F.first("n").alias("n")), "sure")
    found = skewed_join(met.where(is_open & later).select("doc_id", "t"), sure, "t", "n").select("doc_id", "t")
    hits = found.union(met.where(~is_open & later).select("doc_id", "t"))
    return hits.groupBy("doc_id").agg(F.collect_set("t").alias("drop"))


def _known(seen: DataFrame) -> DataFrame:
    """(t, n, first) of the templates that recur: rows and first document of each.

    Rows that repeat an id are one document. Where two documents are enough, the first and the
    last tell; only for short lines are they counted.
    """
    is_short = F.col("t").bitwiseAND(SHORT_BIT) == 1
    counted = seen.groupBy("t").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    twice = counted.where(F.col("first") != F.col("last"))
    documents = seen.where(is_short).select("t", "doc_id").distinct().groupBy("t").agg(F.count(F.lit(1)).alias("documents"))
    often = documents.where(F.col("documents") >= SHORT_MIN_DOCS).select("t")
    short = twice.where(is_short & (F.col("n") >= SHORT_MIN_DOCS)).join(often, "t", "left_semi")
    return twice.where(~is_short).union(short).select("t", "n", "first")


def deduplicated(docs: DataFrame, text: str = "text", *, with_counts: bool = True) -> DataFrame:
    """docs with `text` without the lines of recurring templates; with_counts with n_lines and
    n_dropped too."""
    dropped = recurring(docs, text).withColumnRenamed("drop", "_drop")
    df = docs.join(dropped, "doc_id", "left").withColumn("_lines", F.split(F.col(text).cast("string"), "\n"))
    df = df.withColumn("_of", F.when(F.col("_drop").isNotNull(), templates(F.col("_lines"))))
    left = F.filter(F.arrays_zip("_lines", "_of"), lambda x: ~F.arrays_overlap(x["_of"], F.col("_drop")))
    df = df.withColumn("_left", left)
    joined = F.array_join(F.transform("_left", lambda x: x["_lines"]), "\n")
    df = df.withColumn(text, F.when(F.col("_drop").isNull(), F.col(text)).otherwise(joined))
    if not with_counts:
        return df.select(docs.columns)
    keep = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    n_lines = F.coalesce(F.size("_lines"), F.lit(0)).cast("long")
    n_dropped = F.coalesce(F.size("_lines") - F.size("_left"), F.lit(0)).cast("long")
    return df.select(*keep, n_lines.alias("n_lines"), n_dropped.alias("n_dropped"))
