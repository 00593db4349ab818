from __future__ import annotations

import numpy as np
import pytest

from salesmart.llm import topk_saat
from salesmart.llm.topk_saat import top_k


def brute(queries, rows, k):
    usable = lambda v: v is not None and all(x is not None and np.isfinite(x) for x in v)
    whole = lambda v: [int(np.floor(1024 * float(np.float32(x)))) for x in v]
    rows = [(i, whole(v)) for i, v in rows if i is not None and usable(v)]
    asked = {}
    for i, v in sorted((i, whole(v)) for i, v in queries if i is not None and usable(v)):
        asked.setdefault(i, v)
    out = []
    for i, q in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in rows if j != i)
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


@pytest.mark.parametrize(("block", "first"), [(40, 64), (40, 1), (25, 3), (8192, 64)])
def test_equals_brute_force(spark, monkeypatch, block, first):
    monkeypatch.setattr(topk_saat, "BLOCK_ROWS", block)
    monkeypatch.setattr(topk_saat, "FIRST_BLOCKS", first)
    monkeypatch.setattr(topk_saat, "QUERY_ROWS", 10)
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 0.3, (4, 12))
    rows = [(i, (centres[i % 4] + rng.normal(0, 0.1, 12)).tolist()) for i in range(700)]
    rows += [(i, rows[i - 700][1]) for i in range(700, 800)]  # ties
    rows += [(900, None), (901, [0.1] * 11 + [None]), (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11),
             (None, [0.2] * 12), (904, [0.0] * 12), (905, []), (906, [1.0] * 3), (5, [0.5] * 12), (20, [-0.5] * 12)]
    queries = [r for r in rows if r[0] is not None and r[0] % 20 == 0] + [(904, [0.0] * 12), (905, [])]
    got = top_k(frame(spark, queries), frame(spark, rows), 10)
    assert sorted(map(tuple, got.collect())) == brute(queries, rows, 10)


def test_few_and_no_rows(spark):
    rows = [(0, [1.0]), (1, [2.0])]
    got = top_k(frame(spark, rows), frame(spark, rows), 10).collect()
    assert sorted(map(tuple, got)) == brute(rows, rows, 10)
    none = frame(spark, rows).where("false")
    assert top_k(none, none).collect() == []
    assert top_k(none, frame(spark, rows)).collect() == []
    assert top_k(frame(spark, rows), none).collect() == []


def test_hot_ids_and_vectors(spark, monkeypatch):
    """A third of the rows under one id, another third with one vector: results are whole and no
    block holds more than its share."""
    monkeypatch.setattr(topk_saat, "BLOCK_ROWS", 50)
    monkeypatch.setattr(topk_saat, "FIRST_BLOCKS", 2)
    rng = np.random.default_rng(4)
    vector = lambda: rng.integers(-300, 300, 6).astype(float).__truediv__(1024).tolist()
    same = vector()
    rows = [(7, vector()) for _ in range(300)] + [(i, same) for i in range(1000, 1300)]
    rows += [(7, same)] * 20 + [(i, vector()) for i in range(2000, 2300)] + [(3000, [-x for x in same])] * 15
    queries = [(7, same), (1001, same), (2000, rows[620][1]), (5, [-x for x in same])]
    got = top_k(frame(spark, queries), frame(spark, rows), 10)
    assert sorted(map(tuple, got.collect())) == brute(queries, rows, 10)
    usable = frame(spark, rows).select("vec_id", topk_saat.quantised().alias("q"))
    kept = topk_saat.merged(usable, 10).collect()
    assert sum(r.q == [int(x * 1024) for x in same] for r in kept) == 10 + 10  # id 7 ten times, ten other ids
    index, blocks = topk_saat.build_index(topk_saat.merged(usable, 10))
    assert max(len(r.vec_ids) for r in index.where("dim = -1").collect()) < 2 * 50 and blocks == -(-len(kept) // 50)


def test_waves_cover_all_blocks():
    for blocks in (0, 1, 64, 65, 10_000):
        found = topk_saat.waves(blocks)
        assert [b for start, end in found for b in range(start, end)] == list(range(blocks)) and len(found) < 6


def test_search_stops_on_proof_only():
    import pandas as pd

    rng = np.random.default_rng(2)
    for sign in (1, -1):
        matrix = (sign * np.abs(rng.normal(0, 200, (3000, 24)))).astype(int)
        lists = topk_saat._posting_lists((0,), pd.DataFrame({"vec_id": range(3000), "q": list(matrix)}))
        block = topk_saat.Block(lists)
        for q in (matrix[5], -matrix[7], np.where(np.arange(24) % 2, matrix[9], 0)):
            ids, scores = block.search(-1, q, 10)
            exact = matrix @ q
            best = np.lexsort((np.arange(3000), -exact))[:10]
            assert list(ids) == list(best) and list(scores) == list(exact[best])
