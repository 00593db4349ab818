"""Benchmark passages in texts, by Wu-Manber multi-pattern search over words.

Texts and items are lowered in A-Z and cut into words. A pattern is a window of WINDOW
consecutive item words, or the whole of a shorter item. Patterns of one length are searched
together; for each length there are

- a shift table: for a block of BLOCK words, how far the end of the search window may move on
  without missing a pattern. A block that is in no pattern lets it move on by nearly the whole
  length, so most positions are never looked at;
- buckets: for a block that ends patterns (shift 0), the patterns by their first words. Those
  that start as the text does there are compared word by word, which alone confirms a hit.

A text word inside any confirmed occurrence is hit.

The benchmark is read in parts of about PART_BYTES of text, by a hash of its id and text, and an
item lies in one part whole. The sizes are counted first. One part's tables are gathered, broadcast
and run over all documents; with several, what one part found is written as a column beside the
documents and the next part adds to it, so memory holds one part at a time. Documents are never
shuffled, so no key of theirs can be too frequent.

Defined cases: null and empty texts and items have no words; an item without words is no pattern; an
item without an id hits words, but no id stands for it; repeated rows are scanned each, and items
that share a window are all named; an empty benchmark hits nothing. Columns named like a result are
replaced; others stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import add_columns, shipped, stored, text_column

WINDOW = 10
BLOCK = 2
PART_BYTES = 16 << 20

# Bytes of a text: A-Z lowered, all other ASCII but digits and a-z as blanks. Bytes above ASCII
# belong to letters beyond it, which are word characters.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

Words = Sequence[bytes]
# (length, block length, shifts by block, patterns by last block and first words)
Tables = tuple[int, int, dict[tuple, int], dict[tuple, dict[tuple, list[tuple[Words, list[str]]]]]]

def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def windows_of(words: Words, window: int) -> Iterable[tuple]:
    if len(words) <= window:
        return [tuple(words)] if words else []
    return (tuple(words[i : i + window]) for i in range(len(words) - window + 1))


def search_tables(items: Iterable[tuple[object, str | None]], window: int = WINDOW) -> list[Tables]:
    """The tables of all pattern lengths from (item id, text) rows, the longest first."""
    named: dict[tuple, set[str]] = {}
    for item, text in items:
        for pattern in windows_of(words_of(text), window):
            named.setdefault(pattern, set()).update([] if item is None else [str(item)])
    made = []
    for length in sorted({len(p) for p in named}, reverse=True):
        block = min(BLOCK, length)
        shifts: dict[tuple, int] = {}
        buckets: dict[tuple, dict[tuple, list]] = {}
        for pattern, ids in named.items():
            if len(pattern) != length:
                continue
            for end in range(block, length + 1):
                key = pattern[end - block : end]
                shifts[key] = min(shifts.get(key, length), length - end)
            starts = buckets.setdefault(pattern[length - block :], {})
            starts.setdefault(pattern[:block], []).append((pattern, sorted(ids)))
        made.append((length, block, shifts, buckets))
    return made


def occurrences(words: list[bytes], tables: Tables) -> tuple[list[int], set[str]]:
    """Starts of the occurrences of a length's patterns, ascending, and the ids they stand for."""
    length, block, shifts, buckets = tables
    furthest = length - block + 1
    starts: list[int] = []
    ids: set[str] = set()
    end, n = length, len(words)
    blocks = list(zip(*(words[i:] for i in range(block)), strict=False))  # by first word
    while end <= n:
        last = blocks[end - block]
        shift = shifts.get(last, furthest)
        if shift:
            end += shift
            continue
        start = end - length
        for pattern, named in buckets[last].get(blocks[start], ()):
            if tuple(words[start:end]) == pattern:
                starts.append(start)
                ids.update(named)
        end += 1
    return starts, ids


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans in order that cover the same words."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def scan(words: list[bytes], all_tables: list[Tables]) -> tuple[list[tuple[int, int]], set[str]]:
    """The hit words as disjoint spans, and the ids of items with an occurrence."""
    spans, ids = [], set()
    for tables in all_tables:
        starts, named = occurrences(words, tables)
        spans += [(start, start + tables[0]) for start in starts]
        ids |= named
    return merged(spans), ids


RESULTS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("n_items", T.LongType()),
    T.StructField("items_sha256", T.StringType()),
    T.StructField("contaminated", T.BooleanType()),
    T.StructField("hit_spans", T.ArrayType(T.LongType())),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
]
# What a later part starts from: the text and what the parts before it found.
_SO_FAR = "_so_far"


def results(text: str | None, all_tables: list[Tables], spans: Sequence[int] = (), ids: Sequence[str] = ()) -> tuple:
    """The values of RESULTS, with hits and items found before."""
    words = words_of(text)
    found, named = scan(words, all_tables)
    found = merged([*found, *zip(spans[::2], spans[1::2], strict=True)])
    hit = sum(end - start for start, end in found)
    named = sorted(named.union(ids))
    digest = hashlib.sha256(",".join(named).encode()).hexdigest()
    return len(words), hit, len(named), digest, hit > 0, [x for span in found for x in span], named


def _pass(rows: DataFrame, source: str, items: list[tuple], window: int, without: Sequence[str]) -> DataFrame:
    load = shipped(rows.sparkSession, search_tables(items, window))

    def make(values: list) -> dict[str, list]:
        all_tables = load()
        asked = [tuple(v.values()) if isinstance(v, dict) else (v,) for v in values]
        made = [results(text, all_tables, *before) for text, *before in asked]
        return {field.name: [row[i] for row in made] for i, field in enumerate(RESULTS)}

    return add_columns(rows, source, make, RESULTS, without=without)


def benchmark_parts(benchmark: DataFrame, part_bytes: int = PART_BYTES) -> Iterator[list[tuple]]:
    """The items (item_id, text) in parts of about `part_bytes`, one at a time."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 100)).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    if parts > 1:
        items = stored(items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))), "benchmark")
    for part in range(parts):
        rows = items.where(F.col("part") == part) if parts > 1 else items
        yield [(r.item_id, r.text) for r in rows.collect()]


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    window: int = WINDOW,
    without: Sequence[str] = (),
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """docs with n_words, n_hit, n_items, items_sha256, contaminated, `hit_spans` (word numbers,
    start and end in turn, ends exclusive) and `item_ids`; without the columns `without`."""
    parts = benchmark_parts(benchmark, part_bytes)
    items, following = next(parts), next(parts, None)
    rows = _pass(text_column(docs, text), text, items, window, without if following is None else ())
    if following is None:
        return rows
    while following is not None:
        so_far = F.struct(F.col(text), "hit_spans", "item_ids")
        rows = stored(rows, "scanned").withColumn(_SO_FAR, so_far)
        rows = _pass(rows, _SO_FAR, following, window, [_SO_FAR])
        following = next(parts, None)
    return stored(rows, "scanned").drop(*without)
