from __future__ import annotations

import random
from collections import Counter

import pytest
import xxhash

from salesmart.llm import common, simhash
from salesmart.llm.components import components
from salesmart.llm.queries import QUERIES
from salesmart.llm.simhash import fingerprint, links, near_duplicates, one_of_each, shingle_hashes
from tests.llm.helpers import SF_DIR, docs, groups


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def close(a, b):
    return ((a ^ b) & (2**64 - 1)).bit_count() <= 2


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one two", "A b C d", "É é\x85x y\x1cz \xa0 w", "x " * 70000])
def test_fingerprint(text):
    assert fingerprint(shingle_hashes(text)) == signed(plain_fingerprint(text))


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    expected = groups(sorted(texts), lambda a, b: close(fps[a], fps[b]))
    rows = QUERIES["op7_simhash"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    assert all(r.fingerprint == f"{fps[r.doc_id]:016x}" and r.component_id == expected[r.doc_id] for r in rows)


@pytest.mark.parametrize("cell_rows", [2, 32])
def test_crowded_cells_lose_no_link(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(simhash, "CELL_ROWS", cell_rows)
    rng = random.Random(3)
    values = {0, -1 & (2**64 - 1), 1 << 63}
    for _ in range(3):
        centre = rng.getrandbits(64)
        for _ in range(150):
            value = centre
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                value ^= 1 << bit
            values.add(value)
    values = sorted(map(signed, values))
    found = dict(map(tuple, components(links(spark.createDataFrame([(v,) for v in values], "fp long"))).collect()))
    assert {v: found.get(v, v) for v in values} == groups(values, close)


@pytest.mark.parametrize("bands", [(4, 8, 16), (8, 16)])
def test_a_crowd_is_linked_through_finer_cells(spark, monkeypatch, bands):
    monkeypatch.setattr(simhash, "BANDS", bands)
    monkeypatch.setattr(simhash, "through_centres", None)  # not called
    rng = random.Random(8)
    values = set()
    for _ in range(200):  # all have their upper half in common
        value = 0xDEADBEEF << 32 | rng.getrandbits(32)
        values |= {value, value ^ 1 << rng.randrange(64), value ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64)}
    values = sorted(map(signed, values))
    found = dict(map(tuple, components(links(spark.createDataFrame([(v,) for v in values], "fp long"))).collect()))
    assert {v: found.get(v, v) for v in values} == groups(values, close) and len(found) > 500


def test_bands_grow_with_the_fingerprints():
    starts = [simhash.first_bands(10**n) for n in range(15)]
    assert starts == sorted(starts) and starts[0] == starts[7] == 0 and starts[9] == 1 and starts[14] == 2


@pytest.mark.parametrize("heavy", [3, 2000])
def test_hot_fingerprint_and_hot_id(spark, monkeypatch, heavy):
    monkeypatch.setattr(common, "HEAVY_KEYS", heavy)
    texts = ["same words in all of these"] * 100 + [f"text {i} of its own {i * 7} here" for i in range(100)]
    frame = docs(spark, texts)
    frame = frame.union(frame.where("doc_id = 50 or doc_id = 150").crossJoin(spark.range(60)).drop("id"))
    frame = frame.union(frame.where("doc_id < 60").selectExpr("cast(null as long)", "text", "lang", "source", "n_chars"))
    got = Counter(tuple(r) for r in near_duplicates(frame).select("doc_id", "component_id").collect())
    assert got[(50, 0)] == 61 and got[(None, 0)] == 120 and got[(150, 150)] == 61
    kept = Counter(r.doc_id for r in one_of_each(frame).collect())
    gone = {d for d, c in got if d is not None and d != c}
    assert kept == Counter(r.doc_id for r in frame.collect() if r.doc_id not in gone)
    assert 50 in gone and kept[150] == 61 and kept[None] == 120


@pytest.mark.parametrize("heavy", [3, 2000])
def test_components_of_graphs(spark, monkeypatch, heavy):
    monkeypatch.setattr(common, "HEAVY_KEYS", heavy)
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)]
    edges += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)] + [(7, 7), (3, 4), (None, 1), (2, None)]
    linked = {frozenset(e) for e in edges}
    nodes = sorted({x for a, b in edges if a is not None and b is not None and a != b for x in (a, b)})
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == groups(nodes, lambda a, b: frozenset((a, b)) in linked)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_odd_rows(spark):
    frame = docs(spark, [None, "", "a b c d", "a b c d", "A B c\td", "other words entirely here"])
    frame = frame.union(frame.where("doc_id = 5")).union(frame.where("doc_id = 3").selectExpr("null", "text", "lang", "source", "n_chars"))
    got = Counter(tuple(r) for r in near_duplicates(frame).select("doc_id", "component_id").collect())
    assert got == Counter([(0, 0), (1, 0), (2, 2), (3, 2), (4, 2), (5, 5), (5, 5), (None, 2)])
    assert Counter(r.doc_id for r in one_of_each(frame).collect()) == Counter([0, 2, 5, 5, None])
    assert near_duplicates(frame.where("false")).collect() == []
