from __future__ import annotations

import numpy as np

from salesmart.llm import lang_subword
from salesmart.llm.lang_subword import fit, identified, letter_codes, sample, subwords, train
from tests.llm.helpers import docs

SYLLABLES = {"aa": ["ka", "lo", "mi"], "bb": ["stru", "pfen", "acht"], "cc": ["ção", "ñe", "él"]}


def corpus(n, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        lang = list(SYLLABLES)[i % 3]
        words = ["".join(rng.choice(SYLLABLES[lang], rng.integers(1, 4))) for _ in range(rng.integers(2, 40))]
        rows.append((" ".join(words).capitalize() + ".", lang))
    return rows


def test_subwords_are_those_of_the_words():
    codes = letter_codes()
    bucket, owner = subwords(["Ab, ab", "", None, "x1y", "ab-É"], codes)
    assert np.bincount(owner, minlength=5).tolist() == [2 * (3 + 2 + 1), 0, 0, 2 * (2 + 1), 6 + 3]
    first, fifth = bucket[owner == 0], bucket[owner == 4]
    assert set(first) < set(fifth)
    one = {n: set(subwords([" abc "], codes)[0].tolist()) for n in (1,)}[1]
    assert len(one) == len([" a", "ab", "bc", "c ", " ab", "abc", "bc ", " abc", "abc "])


def test_unseen_texts():
    rows = corpus(300, 1)
    model = train(*map(list, zip(*rows, strict=True)))
    texts, langs = map(list, zip(*corpus(300, 2), strict=True))
    logits, _ = model.logits(texts, letter_codes())
    assert [model.langs[i] for i in logits.argmax(1)] == langs
    assert 0 <= model.reject_below <= 1 and model.temperature > 0


def test_sample_is_fair_and_bounded(spark, monkeypatch):
    monkeypatch.setattr(lang_subword, "TRAIN_DOCS", 40)
    rows = [(i, f"text {i}", "rare" if i % 50 == 0 else "often" if i % 7 else None) for i in range(500)] + [(None, "x", "often"), (1, "again", "often")]
    got = sample(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert len(got) == 40 and sum(r.lang == "rare" for r in got) == 10 and all(r.doc_id is not None for r in got)


def test_odd_rows(spark):
    rows = corpus(120, 3)
    train_frame = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(rows)], "doc_id long, text string, lang string")
    model = fit(train_frame)
    odd = [None, "12 34 !!", "\U0001f600" * 30, "k", "\U00020000", "ka lo " * 50000, "ka lo", "ka lo"]
    frame = docs(spark, odd).selectExpr("*", "'mine' as score")
    got = sorted(identified(frame, model).collect(), key=lambda r: r.doc_id)
    assert [r.lang_pred for r in got[:3]] == ["und"] * 3 and all(r.rejected for r in got[:3])
    assert all(r.lang_pred in SYLLABLES for r in got[3:]) and [r.lang_pred for r in got[5:]] == ["aa"] * 3
    assert all(0 <= r.score <= 1 for r in got)
    assert identified(frame.where("false"), model).collect() == []
    assert fit(train_frame.where("false")) is None
    assert {r.lang_pred for r in identified(frame, None).collect()} == {"und"}


def test_all_languages_are_learned(spark):
    rows = [(i, f"text {i}", f"l{i % 300}") for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len({r.lang for r in lang_subword.sample(frame).collect()}) == 300


def test_many_languages_are_not_broadcast(spark, monkeypatch):
    rows = [(i, f"text {i}", "often" if i % 3 == 0 else f"l{i % 200}") for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(lang_subword, "TRAIN_DOCS", 250)
    plain = sorted(map(tuple, lang_subword.sample(frame).collect()))
    monkeypatch.setattr(lang_subword, "MAX_BROADCAST_LANGS", 5)
    assert sorted(map(tuple, lang_subword.sample(frame).collect())) == plain and len(plain) == 250


def test_calibration_reads_whole_texts(monkeypatch):
    seen = []
    monkeypatch.setattr(lang_subword, "_calibrated", lambda model, texts, y, codes: seen.extend(texts) or model)
    texts = [f"{'ab' if i % 2 else 'cd'} " * 500 for i in range(40)]
    lang_subword.train(texts, ["x" if i % 2 else "y" for i in range(40)])
    assert seen and all(len(t) == 1500 for t in seen)


def test_more_languages_than_dimensions():
    words = [chr(97 + i) + chr(122 - i) + chr(97 + i) for i in range(26)]
    names = [f"l{i:02d}" for i in range(26)]
    model = lang_subword.train([f"{w} {w}" for w in words] * 20, names * 20)
    assert model.weights is not None and model.table.shape[1] == lang_subword.DIM
    best = model.logits(words, lang_subword.letter_codes())[0].argmax(1)
    assert [model.langs[i] for i in best] == names
