"""Queries without SQL twins against brute force over the whole table: what the models decide,
recomputed text by text in plain Python."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
import regex

from salesmart.llm import lang_subword, toxic_crf, weak_rules
from salesmart.llm.queries import QUERIES
from tests.llm.helpers import SF_DIR
from tests.llm.test_weak_rules import plain_em


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def kept_model(monkeypatch, module):
    """The models that a query fits from now on."""
    models, fit = [], module.fit
    monkeypatch.setattr(module, "fit", lambda *args: models.append(fit(*args)) or models[-1])
    return models


def plain_votes(text):
    words = regex.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if regex.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    repeated = len({i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)})
    n, chars = len(words), sum(map(len, words))
    symbols, marks = sum(text.count(c) for c in "#*$%&|<>"), text.count("!")
    clean = sum(bool(regex.fullmatch(r"\p{L}+[.,;:?!]?", w)) for w in words)
    function = sum(w in weak_rules.FUNCTION_WORDS for w in words)
    upper = len(regex.findall(r"\p{Lu}", text))
    doubled = len(lines) - len(set(lines))
    rules = [  # (for, against), against first
        (n >= 20, n < 5),
        (100 * repeated <= 5 * n, 100 * repeated > 20 * n),
        (100 * symbols <= 5 * n, 100 * symbols > 30 * n),
        (100 * doubled <= 10 * len(lines), 100 * doubled > 30 * len(lines)),
        (100 * upper <= 10 * chars, 100 * upper > 40 * chars),
        (100 * marks <= 5 * n, 100 * marks > 30 * n),
        (100 * clean >= 85 * n, 100 * clean < 60 * n),
        (100 * function >= 10 * n, 100 * function < 2 * n),
    ]
    votes = [-1 if bad else 1 if good else 0 for good, bad in rules]
    return sum((v + 1) * 3**j for j, v in enumerate(votes)), n < 10 or 100 * repeated > 20 * n


def test_quality_verdicts(spark, texts):
    judged = {i: plain_votes(t) for i, t in texts.items()}
    counts = Counter(p for p, _ in judged.values())
    patterns = sorted(counts)
    good = dict(zip(patterns, plain_em(patterns, np.array([float(counts[p]) for p in patterns]), 8), strict=True))
    rows = QUERIES["op2_weak_rules"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        pattern, failed = judged[r.doc_id]
        assert r.posterior == pytest.approx(good[pattern], abs=1e-9)
        assert r.base_failed == failed and r.kept == (not failed and good[pattern] >= 0.5)
    assert {r.kept for r in rows} == {True, False}


def plain_marginals(model, words):
    """Probabilities of toxic by forward and backward sums over both tags, scaled at each word."""
    a = model.transitions
    unary = [(1.0, math.exp(min(30, max(-30, model.emission(w))))) for w in words]
    scaled = lambda v: [x / sum(v) for x in v]
    forward = [scaled(unary[0])]
    for u in unary[1:]:
        forward.append(scaled([u[j] * sum(forward[-1][i] * a[i, j] for i in (0, 1)) for j in (0, 1)]))
    backward = [[0.5, 0.5]]
    for u in reversed(unary[1:]):
        backward.append(scaled([sum(a[i, j] * u[j] * backward[-1][j] for j in (0, 1)) for i in (0, 1)]))
    both = [scaled([f[0] * b[0], f[1] * b[1]]) for f, b in zip(forward, reversed(backward), strict=True)]
    return [p[1] for p in both]


def test_toxicity_scores(spark, monkeypatch):
    folder = "/root/testdata/sf0.01"  # the smallest tables with enough toxic documents to learn from
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    models = kept_model(monkeypatch, toxic_crf)
    rows = QUERIES["op4_toxic_crf"](spark, folder).collect()
    (model,) = models
    assert len(rows) == len(texts)
    for r in rows:
        lines = [line.split() for line in texts[r.doc_id].split("\n") if line.split()]
        p = [x for words in lines for x in plain_marginals(model, words)]
        bias, total, most = model.document
        z = bias + (total * math.log1p(sum(p)) + most * max(p) if p else 0)
        score = 1 / (1 + math.exp(-min(30, max(-30, z))))
        assert r.score == pytest.approx(score, abs=1e-9)
        assert r.predicted == int(r.score >= 0.7) and r.n_toxic_words == sum(x >= 0.5 for x in p)
    assert {r.predicted for r in rows} == {0, 1}


def plain_buckets(text):
    """Buckets of the 2 to 4 letter pieces of each run of letters, with a blank at both its ends."""
    lower = lambda c: c.lower() if len(c.lower()) == 1 else c
    runs = "".join(lower(c) if c.isalpha() else " " for c in text).split(" ")
    for run in runs:
        padded = [0, *map(ord, run), 0] if run else []
        for n in (2, 3, 4):
            for i in range(len(padded) - n + 1):
                h = n
                for c in padded[i : i + n]:
                    h = (h ^ c) * 0x9E3779B97F4A7C15 % 2**64
                yield h >> 49


def test_language_scores(spark, texts, monkeypatch):
    models = kept_model(monkeypatch, lang_subword)
    rows = QUERIES["op9_lang_subword"](spark, SF_DIR).collect()
    (model,) = models
    assert len(rows) == len(texts)
    for r in rows:
        buckets = Counter(plain_buckets(texts[r.doc_id]))
        if not buckets:
            assert (r.lang_pred, r.score, r.rejected) == ("und", 1.0, True)
            continue
        mean = sum(n * model.table[b] for b, n in buckets.items()) / buckets.total()
        logits = (mean if model.weights is None else mean @ model.weights) + model.bias
        e = np.exp((logits - logits.max()) / model.temperature)
        p = e / e.sum()
        assert r.lang_pred == model.langs[int(p.argmax())] and r.score == pytest.approx(p.max(), abs=1e-9)
        assert r.rejected == (r.score < model.reject_below)
    assert len({r.lang_pred for r in rows}) > 2
