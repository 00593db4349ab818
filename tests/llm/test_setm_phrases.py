from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from salesmart.llm import setm_phrases
from salesmart.llm.setm_phrases import phrases


def brute(rows, least, share=100, first=2000, max_words=5):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang, text = lang if lang is not None else "und", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = tuple(re.findall("[^\x20\x09]+", piece))
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                f[lang].update(words[i : i + k] for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        wanted = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = set()
        for p, a in wanted.items():
            parts = {p[i:j] for i in range(len(p)) for j in range(i + 2, len(p) + 1)} - {p}
            inside |= {q for q in parts if 100 * a >= share * wanted[q]}
        scored = []
        for p, a in wanted.items():
            if p in inside:
                continue
            cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


def corpus():
    rng = random.Random(3)
    words = ["of", "The", "the", "ÄRA", "ära", "New", "york", "city", "İx", "a b", "z\x1c", "x1"]
    rows = []
    for i in range(300):
        text = " ".join(rng.choice(words) + rng.choice(["", "", "", ".", "\n", "  ", "\t", "\x0b"]) for _ in range(rng.randint(0, 40)))
        rows.append((rng.choice(["en", "de", None]), text))
    rows += [("en", "new york city hall opened"), ("en", "new york city hall closed")] * 15
    rows += [("fr", None), ("fr", ""), (None, " .;!"), ("en", "the " * 500), ("en", "long" * 5000)]
    return rows


@pytest.mark.parametrize("broadcast", [10**6, 0])
@pytest.mark.parametrize("share", [100, 60])
def test_equals_brute_force(spark, monkeypatch, broadcast, share):
    monkeypatch.setattr(setm_phrases, "BROADCAST_GROUPS", broadcast)
    rows = corpus()
    got = phrases(frame(spark, rows), least=12, share=share)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {kind for name, kind in got.dtypes if name not in ("lang", "phrase")} == {"bigint"}
    assert sorted(map(tuple, got.collect())) == brute(rows, 12, share)


def test_first_rows_and_ties(spark):
    rows = [("en", f"a{i} b{i}. c{i} d{i} e{i}") for i in range(60)] * 3
    got = sorted(map(tuple, phrases(frame(spark, rows), least=3, first=25).collect()))
    assert got == brute(rows, 3, first=25)
    assert len(got) == 25 and len({r[-1] for r in got}) == 1


def test_clashing_columns_and_repeated_rows(spark):
    rows = corpus()[:80] * 2
    df = frame(spark, rows).selectExpr("*", "1 as doc", "'x' as word", "2 as n", "3 as code", "4 as first")
    assert sorted(map(tuple, phrases(df, least=10).collect())) == brute(rows, 10)


def test_no_rows_and_nothing_frequent(spark):
    assert phrases(frame(spark, []), least=1).collect() == []
    assert phrases(frame(spark, [("en", "one two"), ("en", None)]), least=2).collect() == []


def test_products_beyond_64_bits(spark):
    row = spark.createDataFrame([(9 * 10**15, 10**16, [10**16], [2 * 10**16])], "a long, n long, heads array<long>, tails array<long>")
    best = row.select(setm_phrases.cut_scores(2).alias("best")).first().best
    assert best.score == 1000 * 9 * 10**15 * 10**16 // (10**16 * 2 * 10**16)


def test_another_seed_where_hashes_meet(spark, monkeypatch):
    from pyspark.sql import functions as F

    plain = setm_phrases.word_hash
    crowded = lambda seed: F.length("word").cast("long") if seed == setm_phrases.SEED else plain(seed)
    monkeypatch.setattr(setm_phrases, "word_hash", crowded)
    rows = corpus()
    assert sorted(map(tuple, phrases(frame(spark, rows), least=12).collect())) == brute(rows, 12)


def test_relations_meet_without_a_shuffle_and_are_dropped(spark):
    docs = spark.range(50).selectExpr("id as doc", "explode(sequence(0, 9)) as pos").selectExpr("doc", "0 as piece", "pos", "doc % 7 as item")
    relations = setm_phrases.Relations(spark)
    rows = relations.persist(docs.repartition(relations.buckets, "doc"))
    with setm_phrases.buckets_meet(spark):
        joined = setm_phrases.adjacent(rows)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 50 * 9
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    relations.drop()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("setm_")]
