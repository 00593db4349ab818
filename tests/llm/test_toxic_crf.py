from __future__ import annotations

import itertools

import numpy as np

from salesmart.llm import toxic_crf
from salesmart.llm.toxic_crf import Model, Tagger, clean, fit, passes, sample, spans, spread, tagged, train
from tests.llm.helpers import docs

A = np.array([[1.3, 0.4], [0.6, 2.1]])


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    sizes = np.array([1, 4, 7, 2, 4])
    x = rng.uniform(0.1, 4, sizes.sum())
    place, starts, counts = spread(sizes)
    laid = np.empty_like(x)
    laid[place] = x
    forward, backward = passes(laid, starts, counts, A)
    odds = (forward * backward)[place]
    got = odds / (1 + odds)
    at = 0
    for n in sizes:
        own, total, marked = x[at : at + n], 0.0, np.zeros(n)
        for tags in itertools.product((0, 1), repeat=int(n)):
            weight = np.prod(np.where(tags, own, 1)) * np.prod([A[a, b] for a, b in itertools.pairwise(tags)])
            total += weight
            marked += weight * np.array(tags)
        assert np.allclose(got[at : at + n], marked / total)
        at += n


def corpus(n=400, seed=2):
    rng = np.random.default_rng(seed)
    plain = [f"{a}{b}" for a in ("ba", "do", "ki", "lu") for b in ("na", "re", "so", "ti", "mu")]
    bad = ["vilestone", "vileward", "grubbish"]
    texts, labels = [], []
    for i in range(n):
        words = rng.choice(plain, 40).tolist()
        if i % 4 == 0:
            for at in rng.choice(40, 3, replace=False):
                words[at] = rng.choice(bad).capitalize() + ","
        texts.append(" ".join(words[:20]) + f"\nline {i} " + " ".join(words[20:]))
        labels.append(int(i % 4 == 0))
    return texts, labels


def test_spans_and_scores_of_unseen_documents():
    model = train(*corpus())
    texts, labels = corpus(200, seed=9)
    texts[0] = texts[0].replace("Vile", "VILE")
    tagger = Tagger(model)
    rows, p, per_doc = tagger.summary(texts)
    score = 1 / (1 + np.exp(-rows @ model.document))
    assert ((score >= 0.7) == np.array(labels, bool)).all()
    ends = np.cumsum(per_doc)
    for text, end, n in zip(texts, ends, per_doc, strict=True):
        found = {text[a:b] for a, b in spans(text, p[end - n : end])}
        words = {w for part in found for w in part.split()}
        assert words == {w for w in text.split() if w.lower().startswith(("vile", "grub"))}


def test_neighbouring_words_are_one_span():
    assert spans("a  b\nc d", np.array([0.9, 0.8, 0.1, 0.6])) == [(0, 4), (7, 8)]


def test_sample_is_bounded_and_whole(spark, monkeypatch):
    monkeypatch.setattr(toxic_crf, "TRAIN_DOCS", 20)
    texts = [f"text {i} " * 3000 for i in range(100)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(1, 0), (None, 1), (3, None), (5, 7)], "doc_id long, toxic int")
    frame = docs(spark, texts)
    got = sample(frame.union(frame), labels).collect()
    assert len(got) == 40 and all(r.text == texts[r.doc_id] for r in got)
    assert all(r.toxic == r.doc_id % 2 for r in got)


def test_odd_rows(spark):
    texts, labels = corpus(80)
    model = train(texts, labels)
    odd = [None, "", " \n\n", "vilestone", "nice " * 50000 + "vilestone", "vilestone\tx", "same", "same"]
    frame = docs(spark, odd).selectExpr("*", "'mine' as score", "'other' as kept")
    rows = sorted(tagged(frame, model).collect(), key=lambda r: r.doc_id)
    assert [r.n_toxic_words for r in rows] == [0, 0, 0, 1, 1, 1, 0, 0]
    assert rows[3].toxic_spans == "0:9" and rows[4].toxic_spans == "250000:250009"
    assert all(0 <= r.score <= 1 and r.kept == "other" for r in rows) and rows[0].score == rows[1].score == rows[2].score
    assert [r.doc_id for r in clean(frame, model).collect()] == [r.doc_id for r in rows if not r.predicted]
    assert clean(frame, model).columns == frame.columns
    assert tagged(frame.where("false"), model).collect() == []
    none = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert fit(frame, none) is None
    assert {r.score for r in tagged(frame, None).collect()} == {0.0} and clean(frame, None).count() == 8
    assert isinstance(model, Model)
