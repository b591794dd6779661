"""Quality classifier from weak labels: expectation-maximisation estimates how
accurate overlapping heuristic labellers are, and the posterior labels train a
hashed linear scorer."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import utf8

GOOD, BAD, ABSTAIN = 1, 2, 0
BUCKETS = 1 << 10
#: Posterior-labelled documents that the scorer is fitted on, at most.
TRAINING_ROWS = 8192

# Classes of bytes: white space, lower case and everything beyond ASCII, upper
# case, digits, inner marks, sentence ends, symbols, bars.
SPACE, LOWER, UPPER, DIGIT, MARK, END, SYMBOL, BAR = range(8)


def _class(b: int) -> int:
    c = chr(b)
    if b >= 0x80 or c.islower():
        return LOWER
    if c.isspace() or b < 0x20:
        return SPACE
    if c.isupper():
        return UPPER
    return DIGIT if c.isdigit() else MARK if c in ",;:()'\"-" else END if c in ".!?" else BAR if c == "|" else SYMBOL


_CLASSES = bytes(map(_class, range(256)))


def _vote(value: float, good: tuple[float, float], bad: tuple[float, float]) -> int:
    """GOOD or BAD if the value lies in that range, else ABSTAIN."""
    return BAD if bad[0] <= value <= bad[1] else GOOD if good[0] <= value <= good[1] else ABSTAIN


@dataclass
class Signals:
    """What the labellers and the scorer see of a text: votes, shares of byte
    class trigrams and the number of white-space words."""

    votes: tuple[int, ...]
    shape: np.ndarray
    n: int


#: Names of the labellers, in the order of their votes.
LABELLERS = ("symbols", "shouting", "table", "stutter", "repeated lines", "vocabulary", "sentences", "letters", "word length")


def signals(text: bytes) -> Signals:
    tokens = text.split()
    n = len(tokens)
    if not n:
        return Signals((BAD,) + (ABSTAIN,) * (len(LABELLERS) - 1), np.zeros(512, np.float32), 0)
    shape = text.translate(_CLASSES) + b"\0"
    of = [shape.count(c) for c in range(8)]
    last = lambda c: shape.count(bytes((c, SPACE))) / n
    letters = max(1, of[LOWER] + of[UPPER])
    stutter = sum(map(eq, tokens, tokens[1:]))
    lines = text.split(b"\n")
    doubled = 0
    if len(set(lines)) < len(lines):
        doubled = sum(len(line) * (k - 1) for line, k in Counter(lines).items() if line.strip())
    long = n >= 20
    votes = (
        _vote(last(SYMBOL) + last(BAR), (0, 0.04), (0.15, 1)),
        _vote(of[UPPER] / letters, (0, 0.12), (0.25, 1)) if n > 4 else ABSTAIN,
        _vote(last(BAR), (0, 0), (0.1, 1)),
        _vote(stutter / n, (0, 0.05), (0.2, 1)) if n > 4 else ABSTAIN,
        _vote(doubled / len(text), (0, 0.2), (0.5, 1)),
        _vote(len(set(tokens)) / n, (0.5, 1), (0, 0.4)) if long else ABSTAIN,
        _vote(last(END), (0.02, 0.3), (0.6, 1)) if long else ABSTAIN,
        _vote((of[LOWER] + of[UPPER] + of[SPACE]) / len(text), (0.88, 1), (0, 0.75)) if long else ABSTAIN,
        _vote((len(text) - of[SPACE]) / n, (2.5, 14), (18, 1e9)) if long else ABSTAIN,
    )
    codes = np.frombuffer(shape, np.uint8)
    grams = np.bincount(codes[:-2].astype(np.uint16) * 64 + codes[1:-1] * 8 + codes[2:], minlength=512) if len(codes) > 2 else np.zeros(512)
    return Signals(votes, (grams / max(len(codes), 200)).astype(np.float32), n)


def _pattern(votes: tuple[int, ...]) -> int:
    code = 0
    for v in votes:
        code = code * 3 + v
    return code


def _votes(pattern: int) -> list[int]:
    out = []
    for _ in LABELLERS:
        pattern, v = divmod(pattern, 3)
        out.append(v)
    return out[::-1]


def _bucket(name: bytes) -> int:
    return zlib.crc32(name) % BUCKETS


_GRAM = np.array([_bucket(b"s%d" % g) for g in range(512)])
_VOTE = np.array([[_bucket(b"v%d=%d" % (j, v)) for v in range(3)] for j in range(len(LABELLERS))])


def add_features(s: Signals, into: np.ndarray) -> np.ndarray:
    """Hashed features: shares of class trigrams, and the votes."""
    np.add.at(into, _GRAM, s.shape)
    for j, v in enumerate(s.votes):
        if v != ABSTAIN:
            into[_VOTE[j][v]] += 0.25
    return into


@dataclass
class LabelModel:
    """Prior of bad documents and, by labeller, class (good, bad) and vote, the
    probability of the vote given that the labeller votes.  An abstention says
    nothing."""

    bad: float
    chance: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of good for rows of votes."""
        log = np.log(np.array([1 - self.bad, self.bad]))[None, :]
        for j in range(votes.shape[1]):
            log = log + np.where(votes[:, j, None] == ABSTAIN, 0, np.log(self.chance[j][:, votes[:, j]].T))
        return 1 / (1 + np.exp(np.clip(log[:, 1] - log[:, 0], -500, 500)))


def estimate(votes: np.ndarray, weight: np.ndarray, rounds: int = 100) -> LabelModel:
    """Expectation-maximisation over vote patterns and their numbers of
    documents.  It starts from "two labellers object", or one of those that
    vote; a pseudo-count holds each labeller to better than chance."""
    objections = (votes == BAD).sum(1)
    bad = np.clip(objections / 2, 0.02, 0.98)
    prior = np.array([[0.0, 8.0, 0.2], [0.0, 3.0, 2.0]])  # by class: abstain, good, bad
    model = None
    for _ in range(rounds):
        w = np.stack([(1 - bad) * weight, bad * weight])
        chance = np.stack([
            np.array([[0.0] + [w[c][votes[:, j] == v].sum() for v in (GOOD, BAD)] for c in (0, 1)]) + prior
            for j in range(votes.shape[1])])
        chance = np.maximum(chance / chance.sum(2, keepdims=True), 1e-9)
        model = LabelModel(float((w[1].sum() + 1) / (weight.sum() + 10)), chance)
        now = 1 - model.posterior(votes)
        if np.abs(now - bad).max() < 1e-6:
            break
        bad = now
    return model


def train(x: np.ndarray, y: np.ndarray, rounds: int = 400, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic scorer fitted to soft labels (rows of
    features, probabilities of good) by full-batch gradient steps with momentum."""
    y = y.astype(np.float32)
    share = min(max(float(y.mean()), 0.01), 0.99)
    cost = np.where(y > 0.5, 0.5 / share, 0.5 / (1 - share)).astype(np.float32) / len(y)  # both classes count alike
    w, bias, speed, push = np.zeros(x.shape[1], np.float32), 0.0, np.zeros(x.shape[1], np.float32), 0.0
    for _ in range(rounds):
        error = (1 / (1 + np.exp(-np.clip(x @ w + bias, -30, 30))) - y) * cost
        speed = 0.9 * speed - 1.0 * (x.T @ error + decay * w)
        push = 0.9 * push - 1.0 * float(error.sum())
        w += speed
        bias += push
    return w, bias


@dataclass
class QualityModel:
    labels: LabelModel
    weights: np.ndarray
    bias: float
    threshold: float = 0.5

    def score(self, s: Signals) -> float:
        z = self.bias + float(self.weights[_GRAM] @ s.shape) + 0.25 * sum(
            float(self.weights[_VOTE[j][v]]) for j, v in enumerate(s.votes) if v != ABSTAIN)
        return 1 / (1 + float(np.exp(-min(max(z, -30.0), 30.0))))


def fit(docs: DataFrame, training_rows: int = TRAINING_ROWS) -> QualityModel:
    """The label model from the votes on all documents and the scorer from a
    bounded sample of them.

    Vote patterns are counted in Spark; there are at most 3 ** 9 of them,
    whatever the number of documents.  The scorer is fitted on the
    ``training_rows`` documents with the smallest hash.  Without documents the
    model scores everything 0.5 and so keeps it.
    """
    texts = docs.select(F.col("text").cast("string").alias("text"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            seen.update(_pattern(signals(t).votes) for t in utf8(batch, "text"))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], ["pattern", "n"])

    counted = texts.mapInArrow(vote, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    if not counted:
        return QualityModel(LabelModel(0.5, np.full((len(LABELLERS), 2, 3), 1 / 3)), np.zeros(BUCKETS, np.float32), 0.0)
    counted.sort()
    votes = np.array([_votes(r.pattern) for r in counted])
    weight = np.array([r.n for r in counted], float)
    labels = estimate(votes, weight)

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [signals(t) for t in utf8(batch, "text")]
            good = labels.posterior(np.array([s.votes for s in found])) if found else np.zeros(0)
            rows = [add_features(s, np.zeros(BUCKETS, np.float32)).tobytes() for s in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("order"), pa.array(rows, pa.binary()), pa.array(good, pa.float64())], ["order", "features", "good"])

    order = F.xxhash64("text")
    share = min(1.0, 1.2 * training_rows / float(weight.sum()) + 1e-3)
    wide = texts.withColumn("order", order).where(F.col("order") <= int(-(1 << 63) + share * ((1 << 64) - 1) * 0.999999))
    rows = (
        wide.mapInArrow(sampled, "order long, features binary, good double")
        .orderBy("order").limit(training_rows).collect()
    )
    x = np.stack([np.frombuffer(r.features, np.float32) for r in rows]) if rows else np.zeros((1, BUCKETS), np.float32)
    weights, bias = train(x, np.array([r.good for r in rows] or [0.5]))
    return QualityModel(labels, weights, bias)


def quality_scores(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, n_words, posterior (of the labellers), score (of the scorer, 0 to
    1, higher: better) and predicted (1: keep) for every whole text.

    Null texts count as empty, which one labeller calls bad; repeated rows score
    alike; other columns are not read.  One pass, no shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [signals(t) for t in utf8(batch, "text")]
            scores = np.array([model.score(s) for s in found])
            good = model.labels.posterior(np.array([s.votes for s in found])) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([s.n for s in found], pa.int64()),
                 pa.array(good, pa.float64()), pa.array(scores, pa.float64()),
                 pa.array((scores >= model.threshold).astype(np.int32), pa.int32())],
                ["doc_id", "n_words", "posterior", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_words long, posterior double, score double, predicted int")


def keep_good(docs: DataFrame, model: QualityModel | None = None) -> DataFrame:
    """The documents (all their columns) that the scorer does not reject."""
    model = model or fit(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([model.score(signals(t)) >= model.threshold for t in utf8(batch, "text")], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def quality_report(docs: DataFrame) -> DataFrame:
    """op2: score and decision for every document."""
    return quality_scores(docs, fit(docs))
