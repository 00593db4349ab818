from __future__ import annotations

import hashlib
import random
import re

import pytest

from salesmart.llm import wu_manber
from salesmart.llm.wu_manber import decontaminated, occurrences, search_tables, words_of
from tests.llm.helpers import docs

COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def brute(texts, items, window=10):
    patterns = []
    for item, text in items:
        words = plain_words(text)
        size = min(window, len(words))
        patterns += [(item, words[i : i + size]) for i in range(len(words) - size + 1) if size]
    out = []
    for i, text in enumerate(texts):
        words = plain_words(text)
        hit, ids = set(), set()
        for item, p in patterns:
            for at in range(len(words) - len(p) + 1):
                if words[at : at + len(p)] == p:
                    hit |= set(range(at, at + len(p)))
                    ids |= set() if item is None else {str(item)}
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((i, len(words), len(hit), len(ids), digest, bool(hit)))
    return out


def cases():
    rng = random.Random(5)
    word = lambda: rng.choice(["the", "of", "a", "x1", "Ärger", "ärger", "naïve", "b", "c", "d"])
    text = lambda n: "".join(word() + rng.choice([" ", ", ", "\n", "-", "\x7f", "_"]) for _ in range(n))
    items = [(i, text(rng.choice([3, 8, 10, 11, 30]))) for i in range(20)]
    items += [(20, items[3][1]), (21, None), (22, ""), (23, "?!"), (None, "one lonely item"), (7, "a second text of item seven"),
              (24, "solo"), (25, "a a a a a a a a a a a a"), (26, "two words"), (7, items[7][1])]
    texts = [text(rng.randint(0, 80)) for _ in range(60)]
    for i in range(40):
        _, passage = items[rng.randrange(20)]
        texts.append(text(rng.randint(0, 20)) + passage.upper().replace("Ä", "ä") + " " + text(rng.randint(0, 20)))
    texts += [None, "", " . ", "a " * 3000, "One-LONELY_item", "solo SOLO solo", "two words two words", "long" * 4000]
    return texts, items


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("part_bytes", [1 << 24, 700])
@pytest.mark.parametrize("window", [10, 4])
def test_equals_brute_force(spark, part_bytes, window):
    texts, items = cases()
    got = decontaminated(docs(spark, texts), benchmark(spark, items), window=window, part_bytes=part_bytes)
    assert sorted(map(tuple, got.select(*COLUMNS).collect())) == brute(texts, items, window)
    assert any(r.contaminated for r in got.collect()) and not all(r.contaminated for r in got.collect())


def test_hit_spans_and_items(spark):
    found = decontaminated(docs(spark, ["x One two three y two three z"]), benchmark(spark, [(3, "one two"), (12, "two-three")])).first()
    assert found.hit_spans == [1, 4, 5, 7] and found.item_ids == ["12", "3"] and found.n_hit == 5


def test_blocks_that_are_in_no_pattern_are_skipped():
    tables = search_tables([(1, "a b c d e f g h i j k l")])
    (length, block, shifts, buckets) = tables[0]
    assert (length, block) == (10, 2) and len(buckets) == 3
    assert shifts[(b"i", b"j")] == 0 and shifts[(b"a", b"b")] == 8 and shifts[(b"h", b"i")] == 1
    looked = []

    class Spy(dict):
        def get(self, key, default):
            looked.append(key)
            return super().get(key, default)

    words = words_of("zz " * 900 + "a b c d e f g h i j k l " + "yy " * 900)
    starts, ids = occurrences(words, (length, block, Spy(shifts), buckets))
    assert starts == [900, 901, 902] and ids == {"1"}
    assert len(looked) < len(words) / 8


def test_empty_tables_and_clashing_columns(spark):
    some = docs(spark, ["one two", None]).selectExpr("*", "1 as n_hit", "'x' as item_ids", "2 as item_id", "3 as _so_far")
    got = decontaminated(some, benchmark(spark, []))
    assert [r.n_hit for r in got.collect()] == [0, 0] and {"item_id", "lang", "source"} <= set(got.columns)
    assert decontaminated(docs(spark, ["x"]).limit(0), benchmark(spark, [(1, "x")])).collect() == []
    assert decontaminated(docs(spark, ["x"]).limit(0), benchmark(spark, [])).collect() == []


def test_repeated_rows_are_scanned_each(spark):
    some = docs(spark, ["solo here", "none"])
    got = decontaminated(some.union(some), benchmark(spark, [(24, "solo")]))
    assert sorted((r.doc_id, r.n_hit) for r in got.collect()) == [(0, 1), (0, 1), (1, 0), (1, 0)]
