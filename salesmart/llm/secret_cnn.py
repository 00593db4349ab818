"""Secrets in texts: fixed patterns, and a character convolutional network for what they miss.

The patterns give the base spans (kinds assign, access, hex), which always stay. Candidates of
the network are all runs of CANDIDATE_LENGTH characters or more from the alphabet of keys, plain
words and numbers included, or what base spans leave of them. Base values teach the network but
are not scored, as no score would change their spans. The network sees each candidate with the characters
around it: embedding, a convolution over five characters, the maximum over the candidate's and
over the context's places, and a logistic output. It is trained on labelled findings: base values
are secrets, candidates that touch no base span are not. To find secrets without their keyword and
of any length, each secret is also shown TWINS times bare: a part of it, CANDIDATE_LENGTH characters
or more, with what stands before and after some plain finding; in every second twin each letter
or digit is another one, so that the mixture counts and not the alphabet of the secrets at hand.
Every second plain finding is shown in capitals too.

A quarter of the values of each label is held back, by a digest of the value, before any twin is
made, so no value teaches and judges. The scores are calibrated by Platt's method on it. The
threshold, on the score before any clipping, is the largest that keeps RECALL of the held-back
secrets' bare twins (JUDGED_TWINS of each), as others are found by the patterns anyway. Candidates above it that overlap
no base span are added with kind `cnn`.

Training starts on the driver, from TRAIN_SECRETS secrets at most, the first by digest of all texts,
so that rare ones are found at any size of the table; and plain findings, TRAIN_WORDS at most of short
candidates without a digit and TRAIN_PLAIN of long ones and of others, the first by digest of TRAIN_DOCS
documents chosen by a hash of their id. Unless these are all there are, each task goes on from that
start through every finding of its texts: all are scored by the network as it then is, and those
that it does not take for plain by a MARGIN teach it, as beyond a margin the loss is flat; secrets, their
twins and capitals likewise, in batches of BATCH_PLAIN plain windows and BATCH_SECRET secret ones, in which
earlier ones come again where there are too few. The network is the mean of the tasks' weights by the
findings they saw, so it depends a little on how rows are split over tasks. It scores all secrets held
back and their twins, and tasks their plain findings held back as they meet them; these scores, counted in
steps of 1 / STEPS, calibrate it and set its threshold, a whole step. Detection reads whole texts.

Defined cases: a null text is an empty one; empty texts have no spans; without findings of both
labels the network adds nothing; repeated rows are scanned each; rows without an id are scanned,
not trained on. Columns named like a result are replaced.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Collection, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import add_columns, chunks, shipped, stored, text_column

# Fixed patterns of the base, and the least length of what counts.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24

KINDS = ("assign", "access", "hex", "cnn")
CANDIDATE_LENGTH = ASSIGN_LENGTH
LONG_CANDIDATE = 16  # from here on, plain findings are drawn apart: most are short words
TRAIN_DOCS = 4000
TRAIN_SECRETS = 1000
TRAIN_WORDS, TRAIN_PLAIN = 4000, 800
TWINS = 2
JUDGED_TWINS = 20
HELD_BACK = 4  # one value in so many
CONTEXT = 24  # characters seen on either side
VALUE = 40  # characters of a candidate in one window; a longer one has several
WIDTH = 5
EMBED, FILTERS = 8, 24
EPOCHS, BATCH, RATE = 10, 64, 0.01
BATCH_PLAIN, BATCH_SECRET, PASS_RATE = 128, 32, 0.005
MARGIN = 4.0  # log odds
AT_ONCE = 1 << 15  # windows made at a time
KEPT = 10_000  # windows of each label that a task keeps for batches that lack some
RECALL = 0.95
STEPS, LARGEST = 256, 64  # steps to a unit of the score; scores beyond the largest count as it

assign_re = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
access_re = re.compile(ACCESS)
hex_re = re.compile(r"[0-9a-f]{24,}")  # a run is matched whole, so this drops the short ones
keyword_re = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)
any_keyword_re = re.compile(rf"(?=({keyword_re.pattern}))", re.IGNORECASE | re.ASCII)  # overlapping ones too
# Full stops and colons belong to a run, but not to its ends.
candidate_re = re.compile(r"[A-Za-z0-9+/_=-][A-Za-z0-9+/_.:=-]{%d,}[A-Za-z0-9+/_=-]" % (CANDIDATE_LENGTH - 2))

FIELDS = [
    T.StructField("n_assign", T.LongType()),
    T.StructField("n_access", T.LongType()),
    T.StructField("n_hex", T.LongType()),
    T.StructField("n_cnn", T.LongType()),
    T.StructField("base_sha256", T.StringType()),
    T.StructField("spans", T.StringType()),
]

Span = tuple[int, int, int]  # start, kind by place in KINDS, end


def may_have_keyword(text: str) -> bool:
    low = text.lower()
    return "passw" in low or "secret" in low or "token" in low or "api" in low


def base_spans(text: str) -> list[Span]:
    found: list[Span] = []
    if may_have_keyword(text):
        found += [(m.start(), 0, m.end()) for m in assign_re.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in access_re.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [(m.start(), 2, m.end()) for m in hex_re.finditer(text)]
    found.sort()
    return found


def candidates(text: str, base: list[Span] | tuple = ()) -> list[tuple[int, int]]:
    """Offsets of tokens that could be a key: runs of a key's characters, not mostly marks. What
    base spans leave of a run is a candidate if it is long enough."""
    runs = [m.span() for m in candidate_re.finditer(text)]
    if base:
        runs = [piece for start, end in runs for piece in _outside(start, end, base)]
    return [(a, b) for a, b in runs if (own := text[a:b]).isalnum() or 2 * sum(map(str.isalnum, own)) > b - a]


def _outside(start: int, end: int, base: list[Span]) -> list[tuple[int, int]]:
    pieces = []
    for a, _, b in base:
        if a < end and start < b:
            pieces.append((start, a))
            start = max(start, b)
    return [(a, b) for a, b in [*pieces, (start, end)] if b - a >= CANDIDATE_LENGTH]


# The parts of candidate_re by class of character: a run's, those not at its ends, letters and digits.
RUN, INNER, SIGN = (
    np.array([1 <= i <= 95 and bool(of(chr(i + 31))) for i in range(99)])
    for of in (re.compile(r"[A-Za-z0-9+/_.:=-]").match, re.compile(r"[.:]").match, str.isalnum)
)


def runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What candidate_re finds, from the classes of texts with zeros around each: starts and ends."""
    inside = RUN[codes]
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = change[::2], change[1::2]
    long = end - start >= CANDIDATE_LENGTH
    start, end = start[long], end[long]
    loose = np.flatnonzero(INNER[codes[start]] | INNER[codes[end - 1]])
    if len(loose):
        solid = np.flatnonzero(inside & ~INNER[codes])
        after, before = np.append(solid, len(codes)), np.append(-1, solid)
        start[loose] = after[np.searchsorted(solid, start[loose])]
        end[loose] = before[np.searchsorted(solid, end[loose])] + 1
        long = end - start >= CANDIDATE_LENGTH
        start, end = start[long], end[long]
    return start, end


def not_marks(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether letters and digits are more than half of each piece."""
    if not len(start):
        return np.zeros(0, bool)
    signs = np.add.reduceat(SIGN[codes], np.stack([start, end], 1).ravel(), dtype=np.int64)[::2]
    return 2 * signs > end - start


def touched(start: np.ndarray, end: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Whether each piece has a place in common with any span."""
    first, last = (np.sort(np.array(side, np.int64)) for side in zip(*spans, strict=True)) if spans else (np.zeros(0), np.zeros(0))
    return np.searchsorted(first, end) > np.searchsorted(last, start, side="right")


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def value_of(text: str, span: Span) -> tuple[int, int]:
    """Offsets of a base span's secret part."""
    start, kind, end = span
    if kind == 0:
        return assign_re.match(text, start).span(2)
    return start, end


def char_class(char: str) -> int:
    """Letters, digits and marks of ASCII for themselves; one class each for other white space,
    other letters and the rest; 0 is outside the text."""
    code = ord(char)
    if 32 <= code < 127:
        return code - 31
    return 96 if char.isspace() else 97 if char.isalpha() else 98


CLASSES = 99
LENGTH = 2 * CONTEXT + VALUE
GAP = CONTEXT + 2
BLOCK = 1 << 13  # characters convolved at a time


def window_starts(start: int, end: int) -> range:
    return range(start, max(start + 1, end - VALUE // 4), VALUE * 3 // 4)


def windows_of(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for many: which one a window belongs to, its place and the length of its own part."""
    count = np.maximum(1, -((VALUE // 4 - end + start) // (VALUE * 3 // 4)))
    of = np.repeat(np.arange(len(start)), count)
    at = start[of] + VALUE * 3 // 4 * (np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count))
    return of, at, np.minimum(end[of] - at, VALUE)


def windows(text: str, start: int, end: int) -> list[list[int]]:
    """Classes of the characters of a candidate and its context, VALUE of its own in each."""
    out = []
    for at in window_starts(start, end):
        left = [char_class(c) for c in text[max(0, at - CONTEXT) : at]]
        own = [char_class(c) for c in text[at : min(end, at + VALUE)]]
        right = [char_class(c) for c in text[at + len(own) : at + len(own) + CONTEXT]]
        row = [0] * (CONTEXT - len(left)) + left + own + [0] * (VALUE - len(own)) + right
        out.append(row + [0] * (LENGTH - len(row)))
    return out


ASCII_CLASSES = np.array([char_class(chr(i)) for i in range(128)], np.uint8)


def classes_of(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = ASCII_CLASSES[np.minimum(codes, 127)]
    others = np.flatnonzero(codes > 126)
    if len(others):
        kinds, of = np.unique(codes[others], return_inverse=True)
        out[others] = np.array([char_class(chr(c)) for c in kinds.tolist()], np.uint8)[of]
    return out


def joined(texts: list[str]) -> tuple[str, np.ndarray, list[int]]:
    """The texts as one, its classes with GAP zeros before each and more after the last, and each text's place."""
    gap, places, place = "\0" * GAP, [], GAP
    for text in texts:
        places.append(place)
        place += len(text) + GAP
    whole = gap + gap.join([*texts, "\0" * VALUE])
    codes = classes_of(whole)
    for text, at in zip(texts, places, strict=True):
        codes[at - GAP : at] = 0
    codes[place - GAP :] = 0
    return whole, codes, places


def windows_at(codes: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The windows by place and length of their own part, in the classes of texts with GAP zeros
    before and after each."""
    place = np.arange(LENGTH)
    right = place >= CONTEXT + VALUE
    shift = np.where(right, size[:, None] - VALUE, 0)
    seen = codes[at[:, None] - CONTEXT + place + shift]
    seen[(place >= CONTEXT + size[:, None]) & ~right] = 0
    return seen


@dataclass
class Network:
    embedding: np.ndarray
    filters: np.ndarray
    filter_bias: np.ndarray
    output: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = np.inf  # of the score: adds nothing

    def forward(self, x: np.ndarray, kind: type = np.float64):
        x = x.astype(np.intp)
        n = LENGTH - WIDTH + 1
        taps = self.taps(kind)
        pairs = x[:, :-1] * CLASSES + x[:, 1:]
        hidden = taps[0][pairs[:, :n]]
        hidden += taps[1][pairs[:, 2 : n + 2]]
        hidden += taps[2][x[:, 4:]]
        own = slice(CONTEXT - 2, CONTEXT + VALUE - 2)
        inside = hidden[:, own]
        around = np.concatenate([hidden[:, : own.start], hidden[:, own.stop :]], 1)
        pooled = np.maximum(np.concatenate([inside.max(1), around.max(1)], 1), 0)
        return pooled @ self.output + self.bias, pooled, inside, around

    def scores(self, rows: list[list[int]] | np.ndarray) -> np.ndarray:
        """Log odds of each window, calibrated."""
        x = np.asarray(rows, np.uint8).reshape(-1, LENGTH)
        logits = [self.forward(x[i : i + 2048])[0] for i in range(0, len(x), 2048)]
        return self.slope * np.concatenate([np.zeros(0), *logits]) + self.shift

    def scores_at(self, codes: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The same for windows by place and length of their own part, by rising place, in the
        classes of texts with GAP zeros before and after each. Windows of a text share the
        convolution: it differs only where a window leaves room after its own part."""
        taps = self.taps()
        pairs = codes[:-1].astype(np.int32) * CLASSES + codes[1:]
        empty = np.maximum(sum(t[0] for t in taps), 0)
        ends = self.ends(taps)
        z = np.empty(len(at))
        starts = np.arange(0, len(codes), BLOCK)
        bounds = np.searchsorted(at, np.append(starts, len(codes)))
        for first, lo, hi in zip(starts.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if lo < hi:
                start = first - min(first, GAP)
                part = slice(start, first + BLOCK + VALUE + GAP)
                z[lo:hi] = self._block(codes[part], pairs[part], at[lo:hi] - start, size[lo:hi], taps, empty, ends)
        return self.slope * z + self.shift

    def taps(self, kind: type = np.float32) -> list[np.ndarray]:
        """What the filters get from the first two characters under them, from the next two, and
        from the last: by pair of classes and by class."""
        each = [(self.embedding @ self.filters[i * EMBED : (i + 1) * EMBED]).astype(kind) for i in range(WIDTH)]
        each[0] += self.filter_bias.astype(kind)
        pair = lambda a, b: (a[:, None] + b[None]).reshape(CLASSES * CLASSES, FILTERS)
        return [pair(each[0], each[1]), pair(each[2], each[3]), each[4]]

    def ends(self, taps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """What the filters make of the last two characters of a value with room after it, by pair of
        classes, at the two places where they are left alone; and of the first two after that room."""
        first, second, third = taps
        two, one = np.arange(CLASSES * CLASSES), np.arange(CLASSES * CLASSES) % CLASSES
        last = np.maximum(first + second[0] + third[0], first[one * CLASSES] + second[0] + third[0])
        next_ = np.maximum(first[0] + second[0] + third[two // CLASSES], first[0] + second[two // CLASSES] + third[one])
        return last, next_

    def _block(
        self, codes: np.ndarray, pairs: np.ndarray, at: np.ndarray, size: np.ndarray, taps: list, empty: np.ndarray, ends: tuple
    ) -> np.ndarray:
        n = len(codes) - WIDTH + 1
        most_first = np.zeros((n + 2, FILTERS), np.float32)
        hidden = most_first[2:]
        np.take(taps[0], pairs[:n], axis=0, out=hidden, mode="clip")
        hidden += np.take(taps[1], pairs[2 : n + 2], axis=0, mode="clip")
        hidden += np.take(taps[2], codes[4 : n + 4], axis=0, mode="clip")
        np.maximum(hidden, 0, out=hidden)
        # most[k][c]: the maximum over 2**k places from that with c in the middle.
        most = [most_first]
        for k in range(max(4, int(size.max()).bit_length() - 1)):
            most.append(np.maximum(most[-1][: -(1 << k)], most[-1][1 << k :]))
        most_of = lambda k, a, length: np.maximum(most[k][a], most[k][a + length - (1 << k)])
        around = np.maximum(most_of(4, at - CONTEXT + 2, CONTEXT - 2), most_of(4, at + size + 2, CONTEXT - 4))
        inside = np.empty_like(around)
        length = size - 2
        level = np.frexp(length)[1] - 1
        for k in range(6):
            if len(own := np.flatnonzero(level == k)):
                inside[own] = most_of(k, at[own], length[own])
        roomy = size <= VALUE - 4
        if roomy.all():
            self._roomy_edges(codes, pairs, at, size, taps, ends, inside, around)
        else:
            for which, edges in ((np.flatnonzero(roomy), self._roomy_edges), (np.flatnonzero(~roomy), self._edges)):
                own, out = inside[which], around[which]
                edges(codes, pairs, at[which], size[which], taps, ends, own, out)
                inside[which], around[which] = own, out
        short = size + 2 <= VALUE - 3
        np.maximum(inside, np.where(short[:, None], empty, 0), out=inside)
        return inside @ self.output[:FILTERS] + around @ self.output[FILTERS:] + self.bias

    # Places whose characters are not neighbours in the text: the end of a value and what follows it.

    def _roomy_edges(self, codes, pairs, at, size, taps, ends, inside, around) -> None:
        """Raise the maxima by those places of windows that leave room for no filter to see both sides."""
        first, second, third = taps
        end = at + size
        take = lambda table, rows: np.take(table, rows, axis=0, mode="clip")
        total = take(first, pairs[end - 4])
        total += take(second, pairs[end - 2])
        total += third[0]
        np.maximum(inside, total, out=inside)
        total = take(first, pairs[end - 3])
        total += take(second[::CLASSES] + third[0], codes[end - 1])
        np.maximum(inside, total, out=inside)
        np.maximum(inside, take(ends[0], pairs[end - 2]), out=inside)
        np.maximum(inside, take(ends[1], pairs[end]), out=inside)
        total = take(first[0] + second, pairs[end])
        total += take(third, codes[end + 2])
        np.maximum(around, total, out=around)
        total = take(first[:CLASSES], codes[end])
        total += take(second, pairs[end + 1])
        total += take(third, codes[end + 3])
        np.maximum(around, total, out=around)

    def _edges(self, codes, pairs, at, size, taps, ends, inside, around) -> None:
        """The same from the windows themselves."""
        seen = windows_at(codes, at, size)
        edges = np.minimum(CONTEXT + size[:, None] + np.arange(-2, 2), CONTEXT + VALUE - 1)
        after = CONTEXT + VALUE + np.arange(-2, 2)
        line = np.arange(len(at))[:, None]

        def edge(centers: np.ndarray) -> np.ndarray:
            under = [seen[line, centers - 2 + i].astype(np.int32) for i in range(WIDTH)]
            total = taps[0][under[0] * CLASSES + under[1]]
            total += taps[1][under[2] * CLASSES + under[3]]
            total += taps[2][under[4]]
            return np.maximum(total.max(1), 0)

        np.maximum(inside, np.maximum(edge(edges), edge(after[None, :2])), out=inside)
        np.maximum(around, edge(after[None, 2:]), out=around)


LETTERS, DIGITS = (np.flatnonzero([1 <= i <= 95 and of(chr(i + 31)) for i in range(96)]) for of in (str.isalpha, str.isdigit))


def twins(secrets: np.ndarray, plain: np.ndarray, rng: np.random.Generator, times: int = TWINS) -> np.ndarray:
    """Bare windows of each secret's: a part of it among what is around plain findings. A part
    without both a letter and a digit could be a word or a number, and is left out."""
    rows = np.repeat(secrets, times, 0)
    out = plain[rng.integers(0, len(plain), len(rows))].copy() if len(plain) else np.zeros_like(rows)
    own = rows[:, CONTEXT : CONTEXT + VALUE]
    length = (own > 0).sum(1)
    size = rng.integers(np.minimum(CANDIDATE_LENGTH, length), length + 1)
    start = rng.integers(0, length - size + 1)
    place = np.arange(VALUE)
    part = np.take_along_axis(own, np.minimum(place + start[:, None], VALUE - 1), 1)
    signs = np.concatenate([LETTERS, DIGITS])
    other = np.isin(part, signs) & (np.arange(len(rows)) % 2 == 1)[:, None]
    part = np.where(other, rng.choice(signs, part.shape), part)
    part = np.where(place < size[:, None], part, 0)
    out[:, CONTEXT : CONTEXT + VALUE] = part
    return out[np.isin(part, LETTERS).any(1) & np.isin(part, DIGITS).any(1)]


def shouted(plain: np.ndarray) -> np.ndarray:
    """Every second plain window with its own letters as capitals, which make no secret either."""
    out = plain[::2].copy()
    own = out[:, CONTEXT : CONTEXT + VALUE]
    small = np.isin(own, LETTERS[len(LETTERS) // 2 :])
    out[:, CONTEXT : CONTEXT + VALUE] = np.where(small, own - 32, own)
    return out


def held_back(y: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Rows of one value in HELD_BACK of each label, of one value at least where there are two.

    `values` are digests; all rows of a value are on one side.
    """
    back = np.zeros(len(y), bool)
    for label in (0, 1):
        names = np.unique(values[y == label])
        listed = listed_back(names.tolist())
        back |= (y == label) & np.isin(values, [v for v in names.tolist() if is_back(v, listed)])
    return back


def listed_back(values: list[str]) -> list[str] | None:
    """The values to hold back where their digests do not tell both sides apart, else None."""
    if 0 < sum(is_back(v) for v in values) < len(values):
        return None
    return values[: len(values) // 2][: max(1, len(values) // HELD_BACK)]


def is_back(value: str, listed: Collection[str] | None = None) -> bool:
    return int(value[:8], 16) % HELD_BACK == 0 if listed is None else value in listed


def value_is_back(value: str, listed: Collection[str] | None = None) -> bool:
    """`is_back` of the value's digest, which is not written out where its first bytes decide."""
    if listed is None:
        return int.from_bytes(hashlib.md5(value.encode("utf-8", "surrogatepass")).digest()[:4], "big") % HELD_BACK == 0
    return is_back(digest_of(value), listed)


def digest_of(value: str) -> str:
    return hashlib.md5(value.encode("utf-8", "surrogatepass")).hexdigest()


def train(x: np.ndarray, y: np.ndarray, values: np.ndarray | None = None, seed: int = 7) -> Network:
    """A network fitted by Adam to the findings and the bare twins of secrets. The values held back
    calibrate it and set its threshold. Without `values` equal windows are one."""
    rng = np.random.default_rng(seed)
    if values is None:
        values = np.array([hashlib.md5(row.astype(np.uint8).tobytes()).hexdigest() for row in x])
    back = held_back(y, values)
    sides = []
    for side, times in ((~back, TWINS), (back, JUDGED_TWINS)):
        plain = x[side & (y == 0)]
        bare, loud = twins(x[side & (y == 1)], plain, rng, times), shouted(plain)
        labels = np.repeat([1, 0], [len(bare), len(loud)])
        sides.append((np.concatenate([x[side], bare, loud]), np.concatenate([y[side], labels]), bare))
    (x, y, _), (x_back, y_back, bare) = sides
    learn = np.arange(len(x))
    net = Network(
        rng.normal(0, 0.3, (CLASSES, EMBED)), rng.normal(0, 0.2, (WIDTH * EMBED, FILTERS)),
        np.zeros(FILTERS), rng.normal(0, 0.2, 2 * FILTERS), 0.0,
    )
    adam = Adam(net, RATE)
    weight = np.where(y == 1, 0.5 / max(1, y[learn].sum()), 0.5 / max(1, (1 - y[learn]).sum())) * len(learn)
    for _ in range(EPOCHS):
        rng.shuffle(learn)
        for start in range(0, len(learn), BATCH):
            rows = learn[start : start + BATCH]
            adam.step(x[rows], y[rows], weight[rows])
    z = net.forward(x_back)[0]
    net.slope, net.shift = _platt(z, y_back, np.ones(len(z)))
    if len(bare):
        net.threshold = float(np.sort(net.scores(bare))[int((1 - RECALL) * len(bare))])
    return net


WEIGHTS = ("embedding", "filters", "filter_bias", "output", "bias")


class Adam:
    """Steps of Adam that change a network."""

    def __init__(self, net: Network, rate: float):
        self.net, self.rate, self.steps = net, rate, 0
        self.moments = {k: (np.zeros_like(getattr(net, k), float), np.zeros_like(getattr(net, k), float)) for k in WEIGHTS}

    def step(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        self.steps += 1
        for k, g in zip(WEIGHTS, _gradients(self.net, x, y, weight, np.float32), strict=True):
            m, v = self.moments[k]
            m = 0.9 * m + 0.1 * g
            v = 0.99 * v + 0.01 * g**2
            self.moments[k] = (m, v)
            change = self.rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.99**self.steps)) + 1e-8)
            setattr(self.net, k, getattr(self.net, k) - change)


def _gradients(net: Network, x: np.ndarray, y: np.ndarray, weight: np.ndarray, kind: type = np.float64):
    z, pooled, inside, around = net.forward(x, kind)
    error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(x)
    to_pooled = error[:, None] * net.output * (pooled > 0)
    # Only the place of each maximum counts: what every filter gets from each class at each tap.
    first, around = CONTEXT - 2, around.argmax(1)
    centers = np.concatenate([inside.argmax(1) + first, np.where(around < first, around, around + VALUE)], 1)
    filters = np.tile(np.arange(FILTERS), 2) * CLASSES
    line, to = np.arange(len(x))[:, None], to_pooled.ravel()
    per_class = np.stack([
        np.bincount((filters + x[line, centers + i]).ravel(), to, FILTERS * CLASSES).reshape(FILTERS, CLASSES)
        for i in range(WIDTH)
    ])
    to_filters = np.concatenate([(seen @ net.embedding).T for seen in per_class])
    to_embedding = sum(seen.T @ net.filters[i * EMBED : (i + 1) * EMBED].T for i, seen in enumerate(per_class))
    to_bias = to_pooled[:, :FILTERS].sum(0) + to_pooled[:, FILTERS:].sum(0)
    return to_embedding, to_filters, to_bias, pooled.T @ error, error.sum()


def _platt(z: np.ndarray, y: np.ndarray, count: np.ndarray) -> tuple[float, float]:
    """Platt's slope and shift, of scores that are there `count` times."""
    true, false = count[y == 1].sum(), count[y == 0].sum()
    if not (true and false):
        return 1.0, 0.0
    target = np.where(y == 1, (true + 1) / (true + 2), 1 / (false + 2))
    w = np.array([1.0, 0.0])
    a = np.stack([z, np.ones_like(z)], 1)

    def loss(w: np.ndarray) -> float:
        return float((count * (np.logaddexp(0, a @ w) - target * (a @ w))).sum() + ((w - [1, 0]) ** 2).sum() / 2)

    for _ in range(50):  # Newton's steps, halved until they lower the loss
        p = 1 / (1 + np.exp(-np.clip(a @ w, -500, 500)))
        curve = (a * (count * p * (1 - p))[:, None]).T @ a + np.eye(2)
        step = np.linalg.solve(curve, a.T @ (count * (target - p)) - (w - [1, 0]))
        while np.abs(step).max() > 1e-9 and loss(w + step) > loss(w):
            step = step / 2
        w = w + step
    # Else the held-back part tells nothing of the order.
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)


def sample(docs: DataFrame) -> DataFrame:
    """Texts of TRAIN_DOCS documents at most, the first by a hash of the id."""
    picked = docs.where("doc_id is not null").select("doc_id").distinct()
    picked = picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
    return texts.join(F.broadcast(picked), "doc_id")  # TRAIN_DOCS ids at most


def secrets(text: str) -> list[tuple[int, int]]:
    return [value_of(text, span) for span in base_spans(text)]


def plain(text: str) -> list[tuple[int, int, bool]]:
    """Offsets of candidates that touch no base span, and whether a keyword is before them."""
    base, out = base_spans(text), []
    if not base and keyword_re.search(text) is None:
        return [(start, end, False) for start, end in candidates(text)]
    keyed = keyword_re.search(text) is not None
    for start, end in candidates(text):
        if not any(start < b and a < end for a, _, b in base):
            out.append((start, end, keyed and keyword_re.search(text, max(0, start - CONTEXT), start) is not None))
    return out


def findings(text: str) -> list[tuple[list[int], int, bool]]:
    """(window, label, keyword near) of the labelled findings of a text."""
    out = [(row, 1, True) for start, end in secrets(text) for row in windows(text, start, end)]
    return out + [(row, 0, near) for start, end, near in plain(text) for row in windows(text, start, end)]


FINDING = T.StructType([
    T.StructField("digest", T.StringType()), T.StructField("kind", T.IntegerType()),
    T.StructField("value", T.StringType()), T.StructField("codes", T.ArrayType(T.IntegerType())),
])
PLAIN_SHORT, SECRET, PLAIN_LONG, PLAIN_DIGIT = 0, 1, 2, 3
MOST = {SECRET: TRAIN_SECRETS, PLAIN_SHORT: TRAIN_WORDS, PLAIN_LONG: TRAIN_PLAIN, PLAIN_DIGIT: TRAIN_PLAIN}


def _kind(value: str, secret: bool) -> int:
    if secret:
        return SECRET
    if len(value) >= LONG_CANDIDATE:
        return PLAIN_LONG
    return PLAIN_SHORT if value.isalpha() else PLAIN_DIGIT


def _first_findings(texts: DataFrame, secret: bool) -> list:
    """The first findings of each kind by digest, MOST of them. Tasks send no more than these."""

    def found(batches):
        import pandas as pd

        first: dict[int, dict[str, tuple[str, list[int]]]] = {}
        most: dict[int, str] = {}  # digests beyond are not among the first
        for batch in batches:
            for text in batch["text"]:
                for start, end in secrets(text) if secret else [(a, b) for a, b, near in plain(text) if not near]:
                    kind = _kind(text[start:end], secret)
                    kept = first.setdefault(kind, {})
                    value = digest_of(text[start:end])
                    for row in windows(text, start, end):
                        digest = hashlib.md5(bytes(row)).hexdigest()
                        if digest < most.get(kind, "g"):
                            kept[digest] = value, row
                    if len(kept) > 2 * MOST[kind]:
                        first[kind] = dict(sorted(kept.items())[: MOST[kind]])
                        most[kind] = max(first[kind])
        rows = [(digest, kind, *x) for kind, kept in first.items() for digest, x in sorted(kept.items())[: MOST[kind]]]
        if rows:
            yield pd.DataFrame(rows, columns=["digest", "kind", "value", "codes"])

    seen = stored(texts.select("text").mapInPandas(found, FINDING).distinct(), "findings")
    kinds = (SECRET,) if secret else (PLAIN_SHORT, PLAIN_LONG, PLAIN_DIGIT)
    return [r for k in kinds for r in seen.where(F.col("kind") == k).orderBy("digest").limit(MOST[k]).collect()]


def fit(docs: DataFrame) -> Network | None:
    texts = docs.where("doc_id is not null").select(F.col("text").cast("string").alias("text")).where("text is not null")
    first = [_first_findings(sample(docs), False) or _first_findings(texts, False), _first_findings(texts, True)]
    if not all(first):
        return None
    rows = [r for part in first for r in part]
    x = np.array([r.codes for r in rows], np.uint8)
    y = np.array([int(r.kind == SECRET) for r in rows], np.int64)
    values = np.array([r.value for r in rows])
    net = train(x, y, values)
    few = docs.where("doc_id is not null").select("doc_id").distinct().limit(TRAIN_DOCS + 1).count() <= TRAIN_DOCS
    if few and all(sum(r.kind == k for r in rows) < most for k, most in MOST.items()):
        return net  # these were all findings
    return judged(*learnt(texts, net, x, y, values))


def findings_of(texts: list[str], is_held: Callable[[str, int], bool]) -> tuple[np.ndarray, ...]:
    """Classes of the texts, with GAP zeros before and after each, and the windows of their labelled
    findings without a keyword near, by rising place: place, length, label, and whether they are held back."""
    whole, codes, places = joined(texts)
    spans, found, keywords = [], [], []
    for text, place in zip(texts, places, strict=True):
        for span in base_spans(text):
            spans.append((place + span[0], place + span[2]))
            a, b = value_of(text, span)
            found.append((place + a, place + b))
        if may_have_keyword(text):
            keywords += [(place + m.start(), place + m.end(1)) for m in any_keyword_re.finditer(text)]
    start, end = runs(codes)
    keep = not_marks(codes, start, end) & ~touched(start, end, spans)
    if keywords:  # a keyword near: the last that ends before, as none is within another
        begin, stop = np.array(keywords, np.int64).T
        last = np.searchsorted(stop, start, side="right") - 1
        keep &= (last < 0) | (begin[last] < start - CONTEXT)
    start, end = start[keep], end[keep]
    values = [whole[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
    known = {value: is_held(value, 0) for value in set(values)}
    held = [known[value] for value in values] + [is_held(whole[a:b], 1) for a, b in found]
    y = np.repeat([0, 1], [len(start), len(found)])
    hidden = np.array(found, np.int64).reshape(-1, 2)
    of, at, size = windows_of(np.append(start, hidden[:, 0]), np.append(end, hidden[:, 1]))
    order = np.argsort(at, kind="stable")
    of = of[order]
    return codes, at[order], size[order], y[of], np.array(held, bool)[of]


def _batches(new: tuple[np.ndarray, np.ndarray], kept: list[np.ndarray], rng: np.random.Generator) -> Iterator[tuple]:
    """Batches of every new window of both labels, filled up with kept ones."""
    sizes = BATCH_PLAIN, BATCH_SECRET
    count = max(-(-len(x) // size) for x, size in zip(new, sizes, strict=True))
    orders = [rng.permutation(len(x)) for x in new]
    for i in range(count):
        sides = []
        for x, order, old, size in zip(new, orders, kept, sizes, strict=True):
            side = x[order[i::count]]
            if len(side) < size and len(old):
                side = np.concatenate([side, old[rng.integers(0, len(old), size - len(side))]])
            sides.append(side)
        n = [len(side) for side in sides]
        weight = np.repeat([0.5 * sum(n) / max(1, k) for k in n], n)
        yield np.concatenate(sides), np.repeat([0, 1], n), weight


PLAIN_SCORE, SECRET_SCORE, BARE_SCORE = 0, 1, 2
LEARNT = T.StructType([
    T.StructField("seen", T.LongType()), T.StructField("weights", T.ArrayType(T.DoubleType())),
    T.StructField("kind", T.IntegerType()), T.StructField("codes", T.BinaryType()), T.StructField("step", T.LongType()),
])
LEARNT_ARROW = pa.schema([
    ("seen", pa.int64()), ("weights", pa.list_(pa.float64())), ("kind", pa.int32()), ("codes", pa.binary()), ("step", pa.int64()),
])


def steps_of(z: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(z, -LARGEST, LARGEST) * STEPS).astype(np.int64)


def learnt(texts: DataFrame, net: Network, x: np.ndarray, y: np.ndarray, values: np.ndarray) -> tuple[Network, DataFrame]:
    """The mean of the networks to which tasks come from `net` by all findings of their texts, and what is
    held back: windows (codes) of secrets and of their bare twins, and numbers (seen) of plain
    findings by step of their score. x, y and values are those that `net` has learnt from."""
    listed = {k: listed_back(np.unique(values[y == k]).tolist()) for k in (0, 1)}
    back = held_back(y, values)
    load = shipped(texts.sparkSession, (net, x[(y == 0) & ~back], x[(y == 1) & ~back], listed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, old_plain, old_secrets, listed = load()
        net.slope, net.shift = 1.0, 0.0
        rng, adam, seen, scored = np.random.default_rng(7), Adam(net, PASS_RATE), 0, Counter()
        kept = [np.concatenate([old_plain, shouted(old_plain)]), np.concatenate([old_secrets, twins(old_secrets, old_plain, rng)])]
        is_held = lru_cache(1 << 17)(lambda value, label: value_is_back(value, listed[label]))
        for batch in batches:
            for chunk in chunks(batch.column(0).to_pylist()):
                codes, *every = findings_of(chunk, is_held)
                for part in (slice(i, i + AT_ONCE) for i in range(0, len(every[0]), AT_ONCE)):
                    at, size, y, back = (column[part] for column in every)
                    z = net.scores_at(codes, at, size)
                    scored.update(steps_of(z[back & (y == 0)]).tolist())
                    window = lambda which: windows_at(codes, at[which], size[which])  # noqa: B023, E731
                    if (judges := back & (y == 1)).any():
                        hidden, around = window(judges), back & (y == 0)
                        bare = twins(hidden, window(around) if around.any() else old_plain, rng, JUDGED_TWINS)
                        for kind, rows in ((SECRET_SCORE, hidden), (BARE_SCORE, bare)):
                            yield pa.RecordBatch.from_pylist([{"kind": kind, "codes": r.tobytes()} for r in rows], schema=LEARNT_ARROW)
                    own, hidden = window(~back & (y == 0) & (z > -MARGIN)), window(~back & (y == 1))
                    new = np.concatenate([own, shouted(own)]), np.concatenate([hidden, twins(hidden, own if len(own) else old_plain, rng)])
                    for rows in _batches(new, kept, rng):
                        adam.step(*rows)
                    kept = [np.concatenate([now[: KEPT // 2], old])[:KEPT] for now, old in zip(new, kept, strict=True)]
                    seen += int((~back).sum())
        if seen:
            weights = np.concatenate([np.ravel(getattr(net, k)) for k in WEIGHTS])
            yield pa.RecordBatch.from_pylist([{"seen": seen, "weights": weights.tolist()}], schema=LEARNT_ARROW)
        if scored:
            counts = [{"seen": n, "kind": PLAIN_SCORE, "step": step} for step, n in scored.items()]
            yield pa.RecordBatch.from_pylist(counts, schema=LEARNT_ARROW)

    found = stored(texts.select("text").mapInArrow(run, LEARNT), "learnt")
    rows = found.where("weights is not null").select("seen", "weights").collect()  # one of each task
    if rows:
        mean = np.average([r.weights for r in rows], 0, [r.seen for r in rows])
        shapes = [np.shape(getattr(net, k)) for k in WEIGHTS]
        parts = np.split(mean, np.cumsum([int(np.prod(shape)) for shape in shapes])[:-1])
        made = [part.reshape(shape) for part, shape in zip(parts, shapes, strict=True)]
        net = Network(*made[:-1], float(made[-1]))
    return net, found.where("kind is not null").select("kind", "codes", "step", "seen")


def judged(net: Network, held: DataFrame) -> Network:
    """The network calibrated by what is held back, with the threshold that keeps RECALL of the bare twins."""
    load = shipped(held.sparkSession, net)

    def score(batches):
        import pandas as pd

        net = load()
        for batch in batches:
            x = np.frombuffer(b"".join(batch["codes"]), np.uint8).reshape(-1, LENGTH)
            z = [net.forward(x[i : i + 2048], np.float32)[0] for i in range(0, len(x), 2048)]
            yield pd.DataFrame({"kind": batch["kind"], "step": steps_of(np.concatenate(z)), "seen": 1})

    windows = held.where("codes is not null").select("kind", "codes").mapInPandas(score, "kind int, step long, seen long")
    scores = held.where("codes is null").select("kind", "step", "seen").unionByName(windows)
    counts = scores.groupBy("kind", "step").agg(F.sum("seen").alias("seen"))
    rows = sorted(counts.collect())  # 2 * LARGEST * STEPS + 1 steps of three kinds at most
    if not rows:
        return net
    kind, step, n = np.array(rows, np.int64).T
    net.slope, net.shift = _platt((step + 0.5) / STEPS, np.where(kind == PLAIN_SCORE, 0, 1), n.astype(float))
    bare, below = step[kind == BARE_SCORE], np.cumsum(n[kind == BARE_SCORE])
    if len(bare):
        at = bare[np.searchsorted(below, int((1 - RECALL) * below[-1]), side="right")]
        net.threshold = float(net.slope * at / STEPS + net.shift)
    return net


def _left_of(start: np.ndarray, end: np.ndarray, cut: np.ndarray, places: list[int], base: list[list[Span]]) -> tuple:
    """The runs with what base spans leave of those that are `cut`, by rising place."""
    pieces = []
    for a, b in zip(start[cut].tolist(), end[cut].tolist(), strict=True):
        i = bisect_right(places, a) - 1
        pieces += [(places[i] + x, places[i] + y) for x, y in _outside(a - places[i], b - places[i], base[i])]
    left = np.array(pieces, np.int64).reshape(-1, 2)
    start, end = np.append(start[~cut], left[:, 0]), np.append(end[~cut], left[:, 1])
    order = np.argsort(start, kind="stable")
    return start[order], end[order]


def scanned(docs: DataFrame, net: Network | None, *, text: str = "text", without: list[str] | None = None) -> DataFrame:
    """docs with the numbers of spans by kind, base_sha256 and spans (kind:start:end by start,
    then kind, in code points)."""
    load = shipped(docs.sparkSession, net)

    def make(values: list) -> dict[str, list]:
        net = load()
        texts = [v or "" for v in values]
        base = [base_spans(t) for t in texts]
        every = [list(spans) for spans in base]
        if net is not None:
            _, codes, places = joined(texts)
            start, end = runs(codes)
            spans = [(p + a, p + b) for p, found in zip(places, base, strict=True) for a, _, b in found]
            if spans:
                start, end = _left_of(start, end, touched(start, end, spans), places, base)
            keep = not_marks(codes, start, end)
            start, end = start[keep], end[keep]
            of, at, size = windows_of(start, end)
            if len(at):
                sure = np.unique(of[net.scores_at(codes, at, size) >= net.threshold])
                texts_of = np.searchsorted(places, start[sure], side="right") - 1
                for i, a, b in zip(texts_of.tolist(), start[sure].tolist(), end[sure].tolist(), strict=True):
                    every[i].append((a - places[i], 3, b - places[i]))
        count = lambda kind: [sum(s[1] == kind for s in spans) for spans in every]
        return {
            "n_assign": count(0), "n_access": count(1), "n_hex": count(2), "n_cnn": count(3),
            "base_sha256": [hashlib.sha256(written(s).encode()).hexdigest() for s in base],
            "spans": [written(sorted(s)) for s in every],
        }

    return add_columns(text_column(docs, text), text, make, FIELDS, without=without or [])
