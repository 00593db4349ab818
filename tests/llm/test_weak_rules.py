from __future__ import annotations

import itertools
import math

import numpy as np
import pytest

from salesmart.llm import weak_rules
from salesmart.llm.weak_rules import FEATURES, features, judged, posteriors
from tests.llm.helpers import docs


def plain_em(patterns, counts, n_rules):
    """The same model in numpy."""
    votes = np.array([[p // 3**j % 3 - 1 for j in range(n_rules)] for p in patterns])
    prior, good, bad = 0.8, np.full(n_rules, 0.95), np.full(n_rules, 0.3)

    def posterior():
        odds = math.log((1 - prior) / prior)
        up = np.log((1 - bad) / good)
        down = np.log(bad / (1 - good))
        return 1 / (1 + np.exp(odds + (votes == 1) @ up + (votes == -1) @ down))

    for _ in range(weak_rules.ITERATIONS):
        r = posterior() * counts
        s = counts - r
        voted = votes != 0
        prior = (r.sum() + 1) / (counts.sum() + 2)
        good = (1 + r @ (votes == 1)) / (2 + r @ voted)
        bad = (1 + s @ (votes == -1)) / (2 + s @ voted)
    return posterior()


def test_em_equals_numpy(spark):
    rng = np.random.default_rng(4)
    patterns = rng.choice(81, 40, replace=False)
    counts = rng.integers(1, 500, 40)
    frame = spark.createDataFrame([(int(p), int(n)) for p, n in zip(patterns, counts, strict=True)], "pattern int, n long")
    got = {r.pattern: r.posterior for r in posteriors(frame, 4).collect()}
    expected = plain_em(patterns, counts.astype(float), 4)
    assert got == {int(p): pytest.approx(x, abs=1e-9) for p, x in zip(patterns, expected, strict=True)}


def test_em_finds_accurate_rules(spark):
    """Votes drawn from known accuracies: the posterior tells the classes apart."""
    rng = np.random.default_rng(5)
    accurate, rows = [0.95, 0.9, 0.85, 0.6], {}
    truth = rng.random(20000) < 0.7
    votes = np.array([np.where(rng.random(len(truth)) < a, truth, ~truth) for a in accurate]) * 2 - 1
    votes[rng.random(votes.shape) < 0.3] = 0
    codes = sum((v + 1) * 3**j for j, v in enumerate(votes))
    for code in codes:
        rows[int(code)] = rows.get(int(code), 0) + 1
    got = {r.pattern: r.posterior for r in posteriors(spark.createDataFrame(list(rows.items()), "pattern int, n long"), 4).collect()}
    judged_good = np.array([got[int(c)] >= 0.5 for c in codes])
    assert (judged_good == truth).mean() > 0.9


def test_labelled_quality(spark):
    folder = "/root/testdata/sf0.1"
    kept = judged(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"))
    rows = kept.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("not base_failed").collect()
    right = {q: [r.kept == bool(q) for r in rows if r.quality == q] for q in (0, 1)}
    assert all(sum(x) >= 0.97 * len(x) for x in right.values())


def repeated(words):
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    return len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)})


def test_repeated_words(spark):
    texts = ["".join(p) for n in (5, 6, 7, 11) for p in itertools.islice(itertools.product("ab", repeat=n), 0, None, 7 if n > 6 else 1)]
    texts = [" ".join(t) for t in texts]
    rows = features(docs(spark, texts).select("doc_id", "text")).collect()
    assert all(r.n_repeat_words == repeated(texts[r.doc_id].split()) for r in rows)


def test_odd_texts(spark):
    texts = [None, "", " \x0b\n\n", "a", "a\na\n b\nb\n\na", "\xa0 x\x85y", "w " * 40000, "same text", "same text"]
    frame = docs(spark, texts).selectExpr("*", "'mine' as n_words", "'mine' as pattern")
    rows = sorted(judged(frame).collect(), key=lambda r: r.doc_id)
    assert [r.n_words for r in rows] == [0, 0, 0, 1, 5, 2, 40000, 2, 2]
    assert rows[4].n_dup_lines == 2 and rows[6].n_repeat_words == 40000
    assert not any(r.kept for r in rows) and all(r.base_failed for r in rows)
    assert all(getattr(rows[0], f) == 0 for f in FEATURES)
    assert judged(frame.where("false")).collect() == []
