"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

A line is a chain of words tagged toxic or not. Each word's emission is the sum of the weights of
its features (the word, its prefixes and endings, its shape); transitions are a 2 x 2 table. The
words of the training documents are labelled first: a word is toxic where a feature of it is far
more frequent among toxic documents than among clean ones. Forward and backward passes give the
marginal of each word; a logistic model over their sum and maximum gives a document's score.

Training takes at most TRAIN_DOCS documents of each label, chosen by a hash of their id, and of
their chains TRAIN_LINES at most, half of them with a toxic word as far as there are so many; the
bounds keep the driver's part the same at every size. Scoring covers every word of every text.

Defined cases: a null or empty text has no marginals and gets the model's score for none; rows
without an id are never trained on; a repeated id is trained on once, toxic if any label says so;
without labels of both kinds every score is 0. Rows keep their columns, but for those named like
a result.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import add_columns, chunks, shipped, text_column

TRAIN_DOCS = 2000
TRAIN_LINES = 4000
CHAIN_WORDS = 48
CACHE_BYTES = 64 << 20
WORD_BYTES = 150  # of an entry beside the word's characters
THRESHOLD = 0.7
STEPS = 150
EDGE = "#*$%&|<>!?.,;:()[]{}\"'`~@/\\+=^_-0123456789«»„“”‘’…–—"

FIELDS = [
    T.StructField("score", T.DoubleType()),
    T.StructField("predicted", T.IntegerType()),
    T.StructField("n_toxic_words", T.LongType()),
    T.StructField("toxic_spans", T.StringType()),
]


def features(token: str) -> list[str]:
    """Features of a word as it stands in a text, marks at its edges apart."""
    word = token.lower().strip(EDGE)
    found = ["w " + word, "s " + word[-3:], "shape " + ("A" if token.isupper() and len(word) > 1 else "a" if word else "-")]
    found += ["p " + word[:n] for n in (3, 4, 5, 6) if len(word) > n]
    return found


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    transitions: np.ndarray  # factors [from, to], 0 plain and 1 toxic
    document: np.ndarray  # bias, weight of the sum, weight of the maximum

    def emission(self, token: str) -> float:
        get = self.weights.get
        return self.bias + sum([get(f, 0.0) for f in features(token)])


def spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For chains of these sizes laid end to end: each word's place when all first words come
    first, then all second ones and so on, longest chain first; starts and counts by step."""
    rank = np.empty(len(sizes), np.int64)
    rank[np.argsort(-sizes, kind="stable")] = np.arange(len(sizes))
    counts = np.bincount(sizes, minlength=1)[::-1].cumsum()[::-1][1:]  # chains longer than t
    starts = np.concatenate([[0], np.cumsum(counts)])
    chain = np.repeat(np.arange(len(sizes)), sizes)
    step = np.arange(len(chain)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return starts[step] + rank[chain], starts, counts


def passes(x: np.ndarray, starts: np.ndarray, counts: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward odds of toxic against plain; x: emission factors, in spread order."""
    forward, backward = x.copy(), np.ones_like(x)
    for t in range(1, len(counts)):
        here = slice(starts[t], starts[t + 1])
        r = forward[starts[t - 1] : starts[t - 1] + counts[t]]
        forward[here] *= (a[0, 1] + a[1, 1] * r) / (a[0, 0] + a[1, 0] * r)
    for t in range(len(counts) - 1, 0, -1):
        here = slice(starts[t], starts[t + 1])
        r = x[here] * backward[here]
        backward[starts[t - 1] : starts[t - 1] + counts[t]] = (a[1, 0] + a[1, 1] * r) / (a[0, 0] + a[0, 1] * r)
    return forward, backward


def factors(emissions: np.ndarray) -> np.ndarray:
    return np.exp(np.clip(emissions, -30, 30))


def lines_of(texts: list) -> tuple[list[str], np.ndarray, np.ndarray]:
    """All words, the sizes of the non-empty lines, and each document's number of words."""
    words: list[str] = []
    sizes, per_doc = [], []
    for text in texts:
        before = len(words)
        for line in (text or "").split("\n"):
            found = line.split()
            if found:
                words += found
                sizes.append(len(found))
        per_doc.append(len(words) - before)
    return words, np.array(sizes, np.int64), np.array(per_doc, np.int64)


class Tagger:
    """Marginals of texts under a model; remembers the emissions of words of CACHE_BYTES together,
    and of those of the texts at hand."""

    def __init__(self, model: Model):
        self.model, self.known, self.bytes = model, {}, 0

    def emissions(self, words: list[str]) -> np.ndarray:
        known, emission = self.known, self.model.emission
        if self.bytes > CACHE_BYTES:
            known.clear()
            self.bytes = 0
        for word in set(words).difference(known):
            known[word] = emission(word)
            self.bytes += WORD_BYTES + 4 * len(word)
        return np.fromiter(map(known.__getitem__, words), np.float64, len(words))

    def marginals(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Probability of toxic for each word of the texts, and the number of words by text."""
        words, sizes, per_doc = lines_of(texts)
        if not words:
            return np.empty(0), per_doc
        place, starts, counts = spread(sizes)
        x = np.empty(len(words))
        x[place] = factors(self.emissions(words))
        forward, backward = passes(x, starts, counts, self.model.transitions)
        odds = (forward * backward)[place]
        return odds / (1 + odds), per_doc

    def summary(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows (1, log of 1 + sum, maximum) by text, with the marginals and word counts."""
        p, per_doc = self.marginals(texts)
        rows = np.zeros((len(texts), 3))
        rows[:, 0] = 1
        full = np.flatnonzero(per_doc)
        if full.size:
            at = (np.cumsum(per_doc) - per_doc)[full]
            rows[full, 1] = np.log1p(np.add.reduceat(p, at))
            rows[full, 2] = np.maximum.reduceat(p, at)
        return rows, p, per_doc


def spans(text: str, p: np.ndarray) -> list[tuple[int, int]]:
    """Code-point offsets of runs of words more likely toxic than not."""
    found: list[tuple[int, int]] = []
    last = -2
    for i, word in enumerate(re.finditer(r"\S+", text)):
        if p[i] >= 0.5:
            found.append((found.pop()[0] if last == i - 1 else word.start(), word.end()))
            last = i
    return found


def cues(texts: list[str], toxic: np.ndarray) -> set[str]:
    """Features of words far more frequent among toxic documents than among clean ones."""
    seen: dict[str, list[int]] = {}
    for text, label in zip(texts, toxic, strict=True):
        words = {w.lower().strip(EDGE) for w in text.split()}
        for f in {f for w in words if len(w) > 2 for f in features(w) if f[0] in "wp" and len(f) > 4}:
            seen.setdefault(f, [0, 0])[int(label)] += 1
    total = np.bincount(toxic, minlength=2)
    least = max(4, 0.02 * total[1])
    return {
        f for f, (clean, bad) in seen.items()
        if bad >= least and (bad + 0.5) / (total[1] + 1) >= 20 * (clean + 0.5) / (total[0] + 1)
    }


def train(texts: list[str], labels: list[int], seed: int = 7) -> Model | None:
    """A model from documents and their labels; None unless both labels are there."""
    pairs = sorted(dict(zip(texts, labels, strict=True)).items())  # copies count once
    texts, toxic = [t for t, _ in pairs], np.array([y for _, y in pairs], np.int64)
    if len(set(toxic.tolist())) < 2:
        return None
    marks = cues(texts, toxic)
    chains: list[list[str]] = []
    for text, label in zip(texts, toxic, strict=True):
        for line in text.split("\n"):
            words = line.split()
            chains += [(label, words[i : i + CHAIN_WORDS]) for i in range(0, len(words), CHAIN_WORDS)]
    bad = {w for _, chain in chains for w in chain if not marks.isdisjoint(features(w))}
    rng = np.random.default_rng(seed)
    rng.shuffle(chains)
    with_bad = [c for y, c in chains if y and not bad.isdisjoint(c)][: TRAIN_LINES // 2]
    plain = [c for y, c in chains if not (y and not bad.isdisjoint(c))][: TRAIN_LINES // 2]
    kept = with_bad + plain
    words = [w for chain in kept for w in chain]
    y = np.array([w in bad and i < len(with_bad) for i, chain in enumerate(kept) for w in chain], float)
    model = _fit_chains(words, np.array([len(c) for c in kept], np.int64), y)
    tagger = Tagger(model)
    rows = np.concatenate([tagger.summary(part)[0] for part in chunks(texts)])
    model.document = _fit_logistic(rows, toxic)
    return model


def _fit_chains(words: list[str], sizes: np.ndarray, y: np.ndarray) -> Model:
    """Maximum likelihood with an L2 penalty by Adam, over all chains in each step."""
    distinct = sorted(set(words))
    number = {w: i for i, w in enumerate(distinct)}
    by_word = np.array([number[w] for w in words])
    of_word = [features(w) for w in distinct]
    names: dict[str, int] = {}
    pairs = np.array([(i, names.setdefault(f, len(names))) for i, fs in enumerate(of_word) for f in fs])
    place, starts, counts = spread(sizes)
    tags = np.empty_like(y)
    tags[place] = y
    later = np.concatenate([np.arange(starts[t], starts[t + 1]) for t in range(1, len(counts))] or [np.empty(0, int)])
    earlier = np.concatenate([np.arange(starts[t - 1], starts[t - 1] + counts[t]) for t in range(1, len(counts))] or [np.empty(0, int)])
    observed = np.array([[((1 - tags[earlier]) * (1 - tags[later])).sum(), ((1 - tags[earlier]) * tags[later]).sum()],
                         [(tags[earlier] * (1 - tags[later])).sum(), (tags[earlier] * tags[later]).sum()]])
    theta = np.zeros(len(names) + 5)  # features, bias, transitions
    theta[len(names)] = -2
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        weights, bias, a = theta[: len(names)], theta[len(names)], np.exp(theta[-4:]).reshape(2, 2)
        per_word = np.bincount(pairs[:, 0], weights[pairs[:, 1]], len(distinct)) + bias
        x = np.empty(len(words))
        x[place] = factors(per_word[by_word])
        forward, backward = passes(x, starts, counts, a)
        odds = forward * backward
        error = tags - odds / (1 + odds)
        by_token = np.bincount(by_word, error[place], len(distinct))
        joint = np.empty((len(later), 2, 2))
        left, right = forward[earlier], x[later] * backward[later]
        joint[:, 0, 0], joint[:, 0, 1] = a[0, 0], a[0, 1] * right
        joint[:, 1, 0], joint[:, 1, 1] = left * a[1, 0], left * a[1, 1] * right
        joint /= joint.sum((1, 2), keepdims=True)
        gradient = np.concatenate([
            np.bincount(pairs[:, 1], by_token[pairs[:, 0]], len(names)),
            [error.sum()],
            (observed - joint.sum(0)).ravel(),
        ]) - 0.5 * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    weights = {f: float(theta[i]) for f, i in names.items() if abs(theta[i]) > 1e-3}
    return Model(weights, float(theta[len(names)]), np.exp(theta[-4:]).reshape(2, 2), np.zeros(3))


def _fit_logistic(rows: np.ndarray, y: np.ndarray, penalty: float = 0.02) -> np.ndarray:
    """Newton's steps for a penalised logistic model with equal weight for both labels."""
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    w = np.zeros(rows.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        gradient = rows.T @ (share * (y - p)) - penalty * w
        curve = (rows * (share * p * (1 - p))[:, None]).T @ rows + penalty * np.eye(len(w))
        w = w + np.linalg.solve(curve, gradient)
    return w


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of TRAIN_DOCS labelled documents of each label at most, whole texts."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    picked = known.where("toxic = 1").orderBy(*order).limit(TRAIN_DOCS)
    picked = picked.union(known.where("toxic = 0").orderBy(*order).limit(TRAIN_DOCS))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
    chosen = texts.join(F.broadcast(picked), "doc_id")  # 2 * TRAIN_DOCS rows at most
    return chosen.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("toxic").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    rows = sample(docs, labels).collect()
    return train([r.text for r in rows], [int(r.toxic) for r in rows])


def tagged(docs: DataFrame, model: Model | None, *, text: str = "text", without: list[str] | None = None) -> DataFrame:
    """docs with score, predicted, n_toxic_words and toxic_spans (start:end, comma-joined)."""
    return add_columns(text_column(docs, text), text, _scorer(docs, model), FIELDS, without=without or [])


def clean(docs: DataFrame, model: Model | None, *, text: str = "text") -> DataFrame:
    """The rows of docs that are not predicted toxic."""
    score = _scorer(docs, model)

    def make(values: list) -> dict[str, list]:
        return {"_toxic": score(values)["predicted"]}

    field = T.StructField("_toxic", T.IntegerType())
    kept = add_columns(text_column(docs, text), text, make, [field], keep_if=lambda made: [x == 0 for x in made["_toxic"]])
    return kept.select(docs.columns)


def _scorer(docs: DataFrame, model: Model | None) -> Callable[[list], dict[str, list]]:
    load = shipped(docs.sparkSession, model)
    own: list[Tagger] = []

    def make(values: list) -> dict[str, list]:
        model = load()
        if model is None:
            n = len(values)
            return {"score": [0.0] * n, "predicted": [0] * n, "n_toxic_words": [0] * n, "toxic_spans": [""] * n}
        if not own:
            own.append(Tagger(model))
        rows, p, per_doc = own[0].summary(values)
        score = 1 / (1 + np.exp(-np.clip(rows @ model.document, -30, 30)))
        ends = np.cumsum(per_doc)
        marked: list[list[tuple[int, int]]] = [[]] * len(values)
        hot = np.zeros(len(values), np.int64)
        if p.size:
            hot = np.bincount(np.repeat(np.arange(len(values)), per_doc), p >= 0.5, len(values)).astype(np.int64)
        for i in np.flatnonzero(hot):
            marked[i] = spans(values[i], p[ends[i] - per_doc[i] : ends[i]])
        return {
            "score": score.tolist(),
            "predicted": (score >= THRESHOLD).astype(int).tolist(),
            "n_toxic_words": hot.tolist(),
            "toxic_spans": [",".join(f"{a}:{b}" for a, b in found) for found in marked],
        }

    return make
