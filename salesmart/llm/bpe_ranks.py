"""Byte-pair encoding and decoding by a contiguous array of ranks.

A short word is a row of token ids with the rank of each adjacent pair beside it. The smallest
rank is scanned for, its boundary deleted, and the two neighbouring ranks refreshed, until no
pair of the word has a rank. All new words of a stretch of text are rows of one array, so each
scan serves them all. Words above SHORT_WORD bytes take the same merges from a heap.

Defined cases: a null text is an empty one and has no ids; repeated rows are encoded each; other
columns pass through, but one named like a result is replaced.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from salesmart.llm.common import add_columns, shipped, text_column

SHORT_WORD = 64
CACHE_BYTES = 96 << 20
WORD_BYTES = 400  # of an entry beside its texts
NO_RANK = np.int32(2**31 - 1)
# White space as Unicode has it, which the pre-tokenizer's \s stands for.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

# What newer versions of Unicode count as letters or numbers and the tokenizer's
# patterns do not, as the inside of a character class.
NEWER = (
    r"\u0558\u058B-\u058C\u088F\u0C5C\u0CDC\u208F\u209D-\u209F\uA7CE-\uA7CF\uA7D2\uA7D4\uA7DD\uA7E2\uA7F1\uAB6C-\uAB6D"
    r"\U000107BB-\U000107BF\U00010940-\U00010959\U00010EC5-\U00010EC7\U00010ED9-\U00010EEE\U00011B0A\U00011DB0-\U00011DDB"
    r"\U00011DE0-\U00011DE9\U00011DF1\U0001246F\U00012475-\U0001247F\U00012550-\U00012686\U00016EA0-\U00016EB8"
    r"\U00016EBB-\U00016ED3\U00016FF2-\U00016FF6\U000187F8-\U000187FF\U00018CD6-\U00018CDA\U00018D09-\U00018D20"
    r"\U00018D80-\U00018DF2\U00018E00-\U00019191\U000191A0-\U000191D2\U0001B123-\U0001B128\U0001B168\U0001D6A6"
    r"\U0001DF1F-\U0001DF24\U0001DF2B-\U0001DF81\U0001DF90-\U0001DF96\U0001DFCD-\U0001DFFF\U0001E6C0-\U0001E6DE"
    r"\U0001E6E0-\U0001E6E2\U0001E6E4-\U0001E6E5\U0001E6E7-\U0001E6ED\U0001E6F0-\U0001E6F4\U0001E6FE-\U0001E6FF"
    r"\U0002B73A-\U0002B73F\U0002B81E\U0002CEA2-\U0002CEAD\U000323B0-\U00033479\U0003D000-\U0003FC3F"
)
# Capitals that the tokenizer lowers and this Python's Unicode may not know.
NEWER_CAPITALS = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}

FIELDS = [
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
]
IDS = T.StructField("token_ids", T.ArrayType(T.IntegerType()))


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where printable, else the next free one."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, free = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in plain else free))
        free += byte not in plain
    return letters


class Vocabulary:
    """Tables of a tokenizer file for BPE with word ends: merges by rank, ids, special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or steps != ["NFC", "Replace", "Lowercase"] or spec["decoder"]:
            raise ValueError(f"{path}: not a lower-cased BPE without a decoder")
        self.suffix = model["end_of_word_suffix"]
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = model["vocab"]
        self.tokens = [""] * (max(*vocab.values(), *self.special.values()) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)  # by rank
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.int32)
        self.final = np.array([vocab[x + self.suffix] for x in letters], np.int32)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, NO_RANK where they are never merged."""
        key = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def encode_words(self, words: list[str]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(words)
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        low = 0
        for high in (8, 12, 16, 24, SHORT_WORD):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            if rows.size:
                for row, ids in zip(rows, self._merge(rows, raw, sizes[rows], high), strict=True):
                    out[row] = ids
            low = high
        for row in np.flatnonzero(sizes > SHORT_WORD):
            out[row] = self._merge_long(raw[row])
        return out

    def _merge(self, rows: np.ndarray, raw: list[bytes], sizes: np.ndarray, width: int) -> list:
        n = len(rows)
        flat = np.frombuffer(b"".join(raw[i].ljust(width, b"\0") for i in rows), np.uint8)
        codes = flat.reshape(n, width)
        column = np.arange(width)
        ids = np.where(column < (sizes - 1)[:, None], self.inner[codes], self.final[codes])
        ids[column >= sizes[:, None]] = -1
        ranks = np.full((n, width), NO_RANK, np.int32)
        pair = column[:-1] < (sizes - 1)[:, None]
        ranks[:, :-1][pair] = self.rank(ids[:, :-1][pair], ids[:, 1:][pair])
        done = np.full((n, width), -1, np.int32)
        place = np.arange(n)
        while place.size:
            best = ranks.argmin(1)
            line = np.arange(len(place))
            smallest = ranks[line, best]
            open_ = smallest < NO_RANK
            if not open_.all():
                done[place[~open_]] = ids[~open_]
                place, ids, ranks = place[open_], ids[open_], ranks[open_]
                best, smallest = best[open_], smallest[open_]
                line = np.arange(len(place))
                if not place.size:
                    break
            ids[line, best] = self.merged[smallest]
            after = column[:-1] > best[:, None]  # the boundary after the pair's left part goes
            ids[:, :-1] = np.where(after, ids[:, 1:], ids[:, :-1])
            ids[:, -1] = -1
            after = column[:-1] >= best[:, None]
            ranks[:, :-1] = np.where(after, ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = NO_RANK
            # of the two ranks refreshed, one is the merged part's with what follows it
            for left in (best, best - 1):
                right = np.minimum(left + 1, width - 1)
                known = (left >= 0) & (left + 1 < width) & (ids[line, right] >= 0)
                x = line[known]
                ranks[x, left[known]] = self.rank(ids[x, left[known]], ids[x, right[known]])
                x = line[~known & (left >= 0)]
                ranks[x, left[~known & (left >= 0)]] = NO_RANK
        return [row[row >= 0].tolist() for row in done]

    def _merge_long(self, raw: bytes) -> list[int]:
        ids = [*self.inner[np.frombuffer(raw[:-1], np.uint8)].tolist(), int(self.final[raw[-1]])]
        ends = list(range(1, len(ids) + 1))
        before = list(range(-1, len(ids) - 1))
        a = np.array(ids, np.int64)
        first = self.rank(a[:-1], a[1:])
        heap = [(int(first[i]), int(i)) for i in np.flatnonzero(first < NO_RANK)]
        heapq.heapify(heap)
        now = {i: r for r, i in heap}

        def refresh(i: int) -> None:
            now.pop(i, None)
            if i >= 0 and ends[i] < len(ids):
                r = int(self.rank(np.array([ids[i]]), np.array([ids[ends[i]]]))[0])
                if r < NO_RANK:
                    now[i] = r
                    heapq.heappush(heap, (r, i))

        while heap:
            r, i = heapq.heappop(heap)
            if now.get(i) != r:
                continue
            gone = ends[i]
            now.pop(gone, None)
            ids[i], ids[gone], ends[i] = int(self.merged[r]), -1, ends[gone]
            if ends[i] < len(ids):
                before[ends[i]] = i
            refresh(i)
            refresh(before[i])
        return [i for i in ids if i >= 0]


def _is_latin(text: str) -> bool:
    """Whether a text is within the first 256 letters, told by one quick pass."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Encoder:
    """Encodes texts with a Vocabulary and remembers the words it has met, CACHE_BYTES of them and
    those of the texts at hand."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.words: dict[str, tuple[int, str, str]] = {}
        self.bytes = 0
        pattern = vocabulary.pattern.replace("\\s", SPACE)
        self.pretoken = regex.compile(pattern)
        # Most texts have none of the newer letters, and are split by the plain pattern.
        self.newer = regex.compile(f"[{NEWER}{''.join(map(chr, NEWER_CAPITALS))}]")
        for kind in ("\\p{L}", "\\p{N}"):
            pattern = pattern.replace(kind, f"[{kind}--[{NEWER}]]")
        self.careful = regex.compile(pattern, regex.V1)
        marks = sorted(vocabulary.special, key=len, reverse=True)
        self.mark = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.marked = {t: (1, str(i), t) for t, i in vocabulary.special.items()}

    def pieces(self, text: str) -> list[str]:
        """Words of a text; a special token in it is a piece of its own."""
        if self.mark is not None and any(m in text for m in self.marked):
            return [w for part in self.mark.split(text) for w in ([part] if part in self.marked else self.plain(part))]
        return self.plain(text)

    def plain(self, text: str) -> list[str]:
        if text.isascii():
            return self.pretoken.findall(text.lower())
        # Each letter is lower-cased alone, without the rule for a final sigma.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if _is_latin(text) or self.newer.search(text) is None:
            return self.pretoken.findall(text)
        return self.careful.findall(text.translate(NEWER_CAPITALS))

    def learn(self, words: set[str]) -> None:
        if self.bytes > CACHE_BYTES:
            self.words.clear()
            self.bytes = 0
        new = [w for w in words if w not in self.words and w not in self.marked]
        tokens = self.vocabulary.tokens
        for word, ids in zip(new, self.vocabulary.encode_words(new), strict=True):
            written, decoded = " ".join(map(str, ids)), " ".join(map(tokens.__getitem__, ids))
            self.words[word] = (len(ids), written, decoded)
            self.bytes += WORD_BYTES + 2 * len(word) + len(written) + 2 * len(decoded)
        self.words.update(self.marked)

    def encode(self, texts: list[str]) -> list[list[tuple[int, str, str]]]:
        """For each text its words as (number of tokens, ids, decoded tokens)."""
        split = [self.pieces(t) for t in texts]
        self.learn(set().union(*split))
        known = self.words
        return [list(map(known.__getitem__, words)) for words in split]


def encode_documents(docs: DataFrame, path: str, *, text: str = "text", with_ids: bool = False, without: list[str] | None = None) -> DataFrame:
    """docs with n_tokens, ids_sha256 (of the decimal ids joined by a space), decoded_sha256
    (of the decoded text) and, if asked for, token_ids. `path` is read by the driver alone."""
    load = shipped(docs.sparkSession, Vocabulary(path))
    own: list[Encoder] = []

    def make(values: list) -> dict[str, list]:
        if not own:
            own.append(Encoder(load()))
        rows = own[0].encode([v or "" for v in values])
        ids = [" ".join([w[1] for w in row]) for row in rows]
        made = {
            "n_tokens": [sum([w[0] for w in row]) for row in rows],
            "ids_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in ids],
            "decoded_sha256": [hashlib.sha256(" ".join([w[2] for w in row]).encode()).hexdigest() for row in rows],
        }
        if with_ids:
            made["token_ids"] = [np.fromstring(x, np.int32, sep=" ") if x else np.empty(0, np.int32) for x in ids]
        return made

    fields = [*FIELDS, IDS] if with_ids else FIELDS
    return add_columns(text_column(docs, text), text, make, fields, without=without or [])
