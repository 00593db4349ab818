"""Language of a text from averaged hashed subword embeddings and a linear softmax.

Subwords are the runs of 2 to 4 characters of each lower-cased word between its boundary marks.
Each is hashed to a bucket with an embedding; a text is the mean of its subwords' embeddings, and
a linear softmax over it gives the languages. Both are trained by stochastic gradient descent.
As the softmax is linear, a trained bucket is kept as its contribution to each language.

The scores are calibrated by a temperature fitted on documents held back from training, and a
prediction is marked rejected where its score is below the level that keeps REJECT_ACCURACY.

Training takes TRAIN_DOCS documents at most, chosen by a hash of their id with a fair share for
each language, from texts of TRAIN_BYTES at most; both bounds are the same at every size. Training,
calibration and prediction read whole texts.

Defined cases: a null text and one without a letter are `und` with score 1; without any training
row every text is `und` with score 0; rows without an id or a language are not trained on; a
repeated id is trained on once. Columns named like a result are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import add_columns, chunks, shipped, skewed_join, stored, text_column

TRAIN_DOCS = 4000
TRAIN_BYTES = 256 << 10
MAX_BROADCAST_LANGS = 10_000
BUCKETS = 1 << 15
DIM = 16
SUBWORDS = (2, 3, 4)
VISITS = 16_000  # documents looked at in training, some of them again and again
RATE = 2.0
HELD_BACK = 5  # one in so many training documents calibrates
REJECT_ACCURACY = 0.99
UNKNOWN = "und"

FIELDS = [
    T.StructField("lang_pred", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("rejected", T.BooleanType()),
]


def letter_codes() -> np.ndarray:
    """For each code point below 65536 its lower-case letter, or 0 if it is no letter."""
    codes = np.zeros(65536, np.uint32)
    for i in range(65536):
        if chr(i).isalpha():
            low = chr(i).lower()
            codes[i] = ord(low) if len(low) == 1 else i
    return codes


def subwords(texts: list, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords of the texts and each text's number of them, by text."""
    joined = " ".join((t or "") + " " for t in texts)
    raw = np.frombuffer((" " + joined).encode("utf-32-le", "surrogatepass"), np.uint32)
    lower = np.where(raw < 65536, codes[np.minimum(raw, 65535)], 0).astype(np.uint64)
    beyond = np.flatnonzero(raw >= 65536)
    if beyond.size:
        distinct, place = np.unique(raw[beyond], return_inverse=True)
        lower[beyond] = np.array([ord(chr(c).lower()) if chr(c).isalpha() else 0 for c in distinct])[place]
    letter = lower > 0
    ends = np.cumsum([len(t or "") + 2 for t in texts])
    text_of = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(ends, prepend=0))
    found, owners = [], []
    for n in SUBWORDS:
        m = len(lower) - n + 1
        if m <= 0:
            continue
        # letters inside, and a letter or a word's boundary at either end
        inside = letter[:m] | letter[1 : m + 1] if n == 2 else letter[1 : m + 1].copy()
        for i in range(2, n - 1):
            inside &= letter[i : i + m]
        at = np.flatnonzero(inside)
        h = np.full(len(at), n, np.uint64)
        for i in range(n):
            h = (h ^ lower[at + i]) * np.uint64(0x9E3779B97F4A7C15)
        found.append((h >> np.uint64(64 - 15)).astype(np.int32))
        owners.append(text_of[np.minimum(at, len(text_of) - 1)])
    bucket, owner = np.concatenate(found), np.concatenate(owners)
    return bucket, owner


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # contribution of each bucket to each language
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0
    weights: np.ndarray | None = None  # with more languages than DIM, where table has the embeddings

    def logits(self, texts: list, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logits by text, and its number of subwords."""
        bucket, owner = subwords(texts, codes)
        counts = np.bincount(owner, minlength=len(texts))
        sums = np.stack([np.bincount(owner, column[bucket], len(texts)) for column in self.table.T], axis=1)
        mean = sums / np.maximum(counts, 1)[:, None]
        return (mean if self.weights is None else mean @ self.weights) + self.bias, counts


def train(texts: list[str], langs: list[str], seed: int = 7) -> Model | None:
    if not texts:
        return None
    names = sorted(set(langs))
    number = {name: i for i, name in enumerate(names)}
    y = np.array([number[x] for x in langs])
    codes = letter_codes()
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 0.1, (BUCKETS, DIM))
    weights, bias = rng.normal(0, 0.1, (DIM, len(names))), np.zeros(len(names))
    back = np.arange(len(texts)) % HELD_BACK == HELD_BACK - 1
    learn = np.flatnonzero(~back) if back.any() else np.arange(len(texts))
    for _ in range(-(-VISITS // len(learn))):
        rng.shuffle(learn)
        for start in range(0, len(learn), 32):
            rows = learn[start : start + 32]
            bucket, owner = subwords([texts[i] for i in rows], codes)
            if not len(bucket):
                continue
            n = np.maximum(np.bincount(owner, minlength=len(rows)), 1)[:, None]
            used, where = np.unique(bucket, return_inverse=True)
            share = np.bincount(where * len(rows) + owner, minlength=len(used) * len(rows)).reshape(len(used), -1) / n.T
            mean = share.T @ embedding[used]
            error = softmax(mean @ weights + bias)
            error[np.arange(len(rows)), y[rows]] -= 1
            error /= len(rows)
            to_embedding = share @ (error @ weights.T)
            weights -= RATE * mean.T @ error
            bias -= RATE * error.sum(0)
            embedding[used] -= RATE * 20 * to_embedding
    model = Model(names, embedding @ weights, bias) if len(names) <= DIM else Model(names, embedding, bias, weights=weights)
    return _calibrated(model, [texts[i] for i in np.flatnonzero(back)], y[back], codes)


def _calibrated(model: Model, texts: list[str], y: np.ndarray, codes: np.ndarray) -> Model:
    if not len(y):
        return model
    logits = np.concatenate([model.logits(part, codes)[0] for part in chunks(texts)])
    grid = np.geomspace(0.3, 20, 60)
    loss = [-np.log(softmax(logits / t)[np.arange(len(y)), y] + 1e-9).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    p = softmax(logits / model.temperature)
    right, best = p.argmax(1) == y, p.max(1)
    order = np.argsort(-best)
    accuracy = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    enough = np.flatnonzero(accuracy >= REJECT_ACCURACY)
    model.reject_below = float(best[order][enough[-1]]) if len(enough) else 1.0
    return model


def sample(docs: DataFrame) -> DataFrame:
    """(text, lang) of TRAIN_DOCS documents at most, with a fair share for each language.

    A document's turn is a uniform number from its id times the documents of its language, so
    the first turns of all languages come at the same pace. Their counts are broadcast up to
    MAX_BROADCAST_LANGS languages; beyond that documents are shuffled to them but for those of
    frequent ones.
    """
    short = docs.where(F.octet_length(F.col("text").cast("string")) <= TRAIN_BYTES)
    known = short.where("doc_id is not null and lang is not null").groupBy("doc_id").agg(F.min("lang").alias("lang"))
    langs = stored(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    uniform = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / float(1 << 53)
    if langs.count() <= MAX_BROADCAST_LANGS:
        counted = known.join(F.broadcast(langs), "lang")
    else:
        counted = skewed_join(stored(known, "known"), langs, "lang", "n")
    turns = counted.withColumn("turn", uniform * F.col("n"))
    picked = turns.orderBy("turn", "doc_id").limit(TRAIN_DOCS).select("doc_id", "lang")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(F.octet_length("text") <= TRAIN_BYTES)
    chosen = texts.join(F.broadcast(picked), "doc_id")  # TRAIN_DOCS rows at most
    return chosen.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("lang").alias("lang"))


def fit(docs: DataFrame) -> Model | None:
    rows = sorted(sample(docs).collect(), key=lambda r: r.doc_id)
    return train([r.text for r in rows], [r.lang for r in rows])


def identified(docs: DataFrame, model: Model | None, *, text: str = "text", without: list[str] | None = None) -> DataFrame:
    """docs with lang_pred, score and rejected."""
    load = shipped(docs.sparkSession, model)
    own: list[np.ndarray] = []

    def make(values: list) -> dict[str, list]:
        if not own:
            own.append(letter_codes())
        model = load()
        if model is None:
            n = len(values)
            return {"lang_pred": [UNKNOWN] * n, "score": [0.0] * n, "rejected": [True] * n}
        logits, counts = model.logits(values, own[0])
        p = softmax(logits / model.temperature)
        best, score = p.argmax(1), p.max(1)
        langs = [model.langs[i] for i in best]
        rejected = score < model.reject_below
        for i in np.flatnonzero(counts == 0):  # any letter has subwords
            langs[i], score[i], rejected[i] = UNKNOWN, 1.0, True
        return {"lang_pred": langs, "score": score.tolist(), "rejected": rejected.tolist()}

    return add_columns(text_column(docs, text), text, make, FIELDS, without=without or [])
