"""The registered queries: SQL twins, and brute force where SQL has none."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest

import __spark_entry__
from salesmart.llm.queries import ORACLE_SQL, QUERIES, tokenizer_path
from tests.llm.helpers import SF_DIR, TABLES, bag, crc

duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"create view {table} as select * from read_parquet('{SF_DIR}/{table}.parquet')")
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    rows = duck.execute(f"select {', '.join(columns)} from ({ORACLE_SQL[name]})").fetchall()
    assert bag(df) == Counter(map(str, rows))
    assert rows


def test_quality_base(spark, documents):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    got = {r.doc_id: r for r in QUERIES["op2_weak_rules"](spark, SF_DIR).collect()}
    assert set(got) == set(documents)
    for i, doc in documents.items():
        text = doc.text or ""
        words = word.findall(text)
        windows = [tuple(words[j : j + 5]) for j in range(len(words) - 4)]
        seen = Counter(windows)
        covered = {j + k for j, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
        lines = [line for line in text.split("\n") if word.search(line)]
        row = got[i]
        assert row.n_words == len(words)
        assert row.word_chars == sum(map(len, words))
        assert row.n_symbols == sum(text.count(c) for c in "#*$%&|<>")
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.n_repeat_words == len(covered)
        assert row.base_failed == (len(words) < 10 or 100 * len(covered) > 20 * len(words))
        assert not (row.base_failed and row.kept)


def test_secret_base(spark, documents):
    patterns = [
        ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 6),
        ("access", r"AKIA[A-Z0-9]+", 0, 0, 20),
        ("hex", r"[0-9a-f]+", 0, 0, 24),
    ]
    got = {r.doc_id: r for r in QUERIES["op5_secret_cnn"](spark, SF_DIR).collect()}
    for i, doc in documents.items():
        found = []
        for kind, (name, pattern, flags, group, least) in enumerate(patterns):
            matches = [m for m in re.finditer(pattern, doc.text or "", flags) if len(m[group]) >= least]
            found += [(m.start(), kind, f"{name}:{m.start()}:{m.end()}") for m in matches]
            assert got[i][f"n_{name}"] == len(matches)
        base = [x[2] for x in sorted(found)]
        assert got[i].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(got[i].spans.split(",")) | {""}


def test_tokens(spark, documents):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for row in QUERIES["op10_bpe"](spark, SF_DIR).collect():
        ids = library.encode(documents[row.doc_id].text or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == digest(" ".join(map(str, ids)))
        assert row.decoded_sha256 == digest(library.decode(ids, skip_special_tokens=False))


def test_languages_held_out(spark, documents):
    rows = QUERIES["op9_lang_subword"](spark, SF_DIR).collect()
    assert all(r.held_out == (crc(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and documents[r.doc_id].lang]
    assert sum(r.lang_pred == documents[r.doc_id].lang for r in held) >= 0.95 * len(held)


def test_toxicity_held_out(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = QUERIES["op4_toxic_crf"](spark, "/root/testdata/sf0.1").collect()
    assert all(r.held_out == (crc(r.doc_id, 3) == 1) and r.predicted == (r.score >= 0.7) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and labels.get(r.doc_id) in (0, 1)]
    counts = Counter(held)
    assert counts[1, 1] >= 0.9 * (counts[1, 1] + counts[1, 0])
    assert counts[0, 1] <= 0.02 * (counts[0, 0] + counts[0, 1])


def test_whitened_embeddings(spark):
    from tests.llm.test_whitening import check

    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    used = [r for r in rows if r.embedding is not None and all(x is not None and abs(x) < float("inf") for x in r.embedding)]
    dims = max(len(r.embedding) for r in used)
    check(QUERIES["op13_whitening"](spark, SF_DIR).collect(), [r.embedding for r in used], [r.vec_id for r in used], dims)
