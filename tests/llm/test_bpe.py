from __future__ import annotations

import random
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from salesmart.llm import bpe_ranks
from salesmart.llm.bpe_ranks import Encoder, Vocabulary, encode_documents
from salesmart.llm.queries import tokenizer_path
from tests.llm.helpers import docs

tokenizers = pytest.importorskip("tokenizers")
LIBRARY = tokenizers.Tokenizer.from_file(tokenizer_path())
ENCODER = Encoder(Vocabulary(tokenizer_path()))


def check(texts):
    for text, words in zip(texts, ENCODER.encode(texts), strict=True):
        ids = LIBRARY.encode(text, add_special_tokens=False).ids
        assert " ".join(w[1] for w in words) == " ".join(map(str, ids))
        assert " ".join(w[2] for w in words) == LIBRARY.decode(ids, skip_special_tokens=False)
        assert sum(w[0] for w in words) == len(ids)


def test_fixed_texts():
    check(["", " ", "Hello   World's", "é 'S 'LL  it'S", "<|endoftext|>a<|startoftext|><|ENDOFTEXT|>", "ÀΣΑΣ İ ſ K ǅ",
           "a\x1cb\x85c\xa0d e﻿​\x00", "你好 😀 123 x²Ⅷ", "é ́", "''s''t '"])


def test_long_words():
    check(["a" * 3000, "abc" * 700 + "é" * 200, "!" * 500, "x" * 64 + " " + "x" * 65 + " " + "the" * 22])


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(codec="utf-8", max_codepoint=0x2FFF), max_size=60))
def test_any_text(text):
    check([text])


def test_pieces_of_text():
    rng = random.Random(4)
    parts = ["a", "th", "É", "é", " ", "\n", "'s", "'LL", "1", "你", "😀", "<|endoftext|>", "İ", "!", "??", "x" * 70, "_", "<|"]
    check(["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(800)])


def test_small_cache(monkeypatch):
    monkeypatch.setattr("salesmart.llm.bpe_ranks.CACHE_BYTES", 3)
    check([f"word{i} other{i} again" for i in range(30)])


def test_odd_rows(spark):
    frame = docs(spark, [None, "", "same text", "same text"]).selectExpr("*", "'mine' as n_tokens")
    rows = sorted(encode_documents(frame, tokenizer_path(), with_ids=True).collect(), key=lambda r: r.doc_id)
    assert [r.n_tokens for r in rows] == [0, 0, 2, 2] and [len(r.token_ids) for r in rows] == [0, 0, 2, 2]
    assert rows[0].text is None and rows[2].ids_sha256 == rows[3].ids_sha256
    assert encode_documents(frame.where("false"), tokenizer_path()).collect() == []


def test_letters_newer_than_this_unicode():
    """Every code point that this Python's Unicode has not assigned, alone and beside others."""
    odd = [c for c in map(chr, range(0x80, 0x40000)) if not 0xD800 <= ord(c) < 0xE000 and unicodedata.category(c) == "Cn"]
    check([f":{c} a{c}1" for c in odd if not bpe_ranks.regex.match(r"[^\p{L}\p{N}]", c)][::7] + [":\u0c5c", "a\u0558b", "\u1c89x"])
