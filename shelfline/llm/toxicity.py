"""Toxicity by maximum-scoring segments: token log-odds under a Dirichlet prior,
a linear-time scan for all maximal segments, and scores calibrated by the
extreme-value statistics of clean documents."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, lgamma, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import stored, utf8, words

#: Labelled documents that are learned from, at most (those with the smallest hash).
TRAINING_ROWS = 20_000
#: Features of the model, at most (those of the highest z-score).
MODEL_FEATURES = 50_000
#: Toxic documents that a feature must be in, whatever their number; significance decides beyond.
MIN_DOCS = 3
#: What the signed root of the likelihood ratio of a feature's documents must exceed.
DOCUMENT_Z = 4.0
#: A token is one of its word and these leading parts of it, in characters.
PREFIXES = (3, 4, 5, 6, 7)
EULER = 0.5772156649015329


def token_features(word: bytes) -> list[str]:
    """The whole word (with an end mark), then its leading parts, longest first."""
    text = word.decode("utf-8", "replace")
    return [text + "$", *(text[:k] for k in reversed(PREFIXES) if k <= len(text))]


def held_out(doc_id: Column) -> Column:
    """Whether a document is never learned from: crc32 of its id modulo 3 is 1,
    or it has no id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def maximal_segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, after, score) of a sequence in which
    the listed positions have positive scores and every other one ``drift`` < 0;
    linear in the number of hits (each joins and leaves the stack once)."""
    stack: list[tuple[float, float, int, int, int]] = []  # sum before, sum after, first, after, index to the left
    total, at = 0.0, 0
    for position, score in hits:
        total += drift * (position - at)
        low, total, at = total, total + score, position + 1
        first, after = position, position + 1
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][0] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][1] >= total:
                stack.append((low, total, first, after, j))
                break
            low, _, first, _, left = stack[j]
            del stack[j:]
            j = left
    return [(a, b, high - low) for low, high, a, b, _ in stack]


@dataclass
class ToxicityModel:
    """Log-odds by feature, the score of every word without a positive one, and
    the calibration: normalised scores are score - log(k * words).

    A word's feature is the most specific one in ``weights``; features with
    weight 0 stand there to stop the search before a toxic leading part that the
    word shares by chance."""

    weights: dict[str, float]
    drift: float = -0.02
    k: float = 1.0
    slope: float = 1.0
    offset: float = 0.0
    empty: float = 0.0

    def scorer(self, cached_words: int = 300_000) -> Scorer:
        return Scorer(self, cached_words)

    def normalised(self, n: int, scores: list[float]) -> float:
        """Sum statistic of the best r segments for the r that is most
        surprising: sum of score - log(k n), plus log r! for their order."""
        base = log(max(self.k * n, 1.0))
        best = total = -base
        for r, s in enumerate(sorted(scores, reverse=True), 1):
            total = s - base if r == 1 else total + s - base
            best = max(best, total + lgamma(r + 1) if r > 1 else total)
            if s < base:
                break
        return best

    def probability(self, n: int, scores: list[float]) -> float:
        if not n or not scores:
            return self.empty
        z = self.offset + self.slope * self.normalised(n, scores)
        return 1 / (1 + exp(-min(max(z, -30.0), 30.0)))


class Scorer:
    """A model with a bounded memory of the words it has looked up."""

    def __init__(self, model: ToxicityModel, cached_words: int):
        self.model, self.size = model, cached_words
        self.known: dict[bytes, float] = {}

    def weight(self, word: bytes) -> float:
        weights = self.model.weights
        w = next((weights[f] for f in token_features(word) if f in weights), 0.0)
        if len(word) <= 64:
            if len(self.known) >= self.size:
                self.known.clear()
            self.known[word] = w
        return w

    def hits(self, tokens: list[bytes]) -> list[tuple[int, float]]:
        get, weight = self.known.get, self.weight
        scores = [w if (w := get(t)) is not None else weight(t) for t in tokens]
        return [(i, w) for i, w in enumerate(scores) if w > 0]

    def segments(self, text: bytes) -> tuple[int, list[tuple[int, int, float]]]:
        tokens = words(text)
        return len(tokens), maximal_segments(self.hits(tokens), self.model.drift)


def _feature_counts(train: DataFrame) -> DataFrame:
    """Per feature: toxic and clean tokens, toxic and clean documents it is in."""
    names = ["feature", "toxic", "clean", "toxic_docs", "clean_docs"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens: tuple[Counter, Counter] = (Counter(), Counter())
            in_docs: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(utf8(batch, "text"), batch.column("toxic").to_pylist(), strict=True):
                seen: set[str] = set()
                for word, k in Counter(words(text)).items():
                    for f in token_features(word):
                        tokens[toxic][f] += k
                        seen.add(f)
                in_docs[toxic].update(seen)
            found = list(tokens[0] | tokens[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.string()), *(pa.array([c[f] for f in found], pa.int64())
                                                 for c in (tokens[1], tokens[0], in_docs[1], in_docs[0]))], names)

    counted = train.select("text", "toxic").mapInArrow(count, "feature string" + "".join(f", {n} long" for n in names[1:]))
    return counted.groupBy("feature").agg(*[F.sum(n).alias(n) for n in names[1:]])


def _log_odds(counts: DataFrame, toxic_words: int, clean_words: int, toxic_docs: int, clean_docs: int,
              limit: int) -> dict[str, float]:
    """Log-odds ratios, each class having the corpus as Dirichlet prior, of the
    features that are more frequent in toxic words beyond chance: the signed root
    of their likelihood ratio exceeds what the largest of as many normal
    variables would be, and that of the documents they are in DOCUMENT_Z (tokens
    alone would let a few documents that repeat a word decide).  The weight is half
    a standard error less.  The other features that extend one of them have weight
    0 if they were seen often enough to be told: as toxic tokens alone they would
    be significant."""
    min_z = sqrt(2 * log(max(counts.count(), 2))) + 1
    whole = toxic_words + clean_words
    telling = min_z**2 / (2 * log(whole / toxic_words))  # tokens
    strength = 0.2 * min(toxic_words, clean_words)  # words the prior counts for
    both = F.col("toxic") + F.col("clean")
    prior = both / float(whole) * strength
    a, b = F.col("toxic") + prior, F.col("clean") + prior
    odds = F.log(a / (toxic_words + strength - a)) - F.log(b / (clean_words + strength - b))
    error = F.sqrt(1 / a + 1 / b)
    def root(toxic: str, clean: str, toxic_size: int, clean_size: int) -> Column:
        """Root of the likelihood ratio of the counts against equal rates."""
        seen, size = F.col(toxic) + F.col(clean), toxic_size + clean_size
        gain = lambda n, part: F.when(n > 0, n * F.log(n / (seen * (part / size)))).otherwise(0.0)
        return F.sqrt(F.greatest(F.lit(0.0), 2 * (gain(F.col(toxic), toxic_size) + gain(F.col(clean), clean_size))))

    z = F.when((F.col("toxic_docs") * clean_docs > F.col("clean_docs") * toxic_docs)
               & (root("toxic_docs", "clean_docs", toxic_docs, clean_docs) > DOCUMENT_Z),
               root("toxic", "clean", toxic_words, clean_words)).otherwise(0.0)
    kept = (
        counts.where(F.col("toxic_docs") >= MIN_DOCS)
        .select("feature", odds.alias("odds"), error.alias("error"), z.alias("z"))
        .where((F.col("z") > min_z) & (F.col("odds") > 1 + 0.5 * F.col("error")))
        .orderBy(F.col("z").desc(), "feature").limit(limit)
    )
    weights = {r.feature: r.odds - 0.5 * r.error for r in kept.collect()}
    parts = F.array(*[F.substring("feature", 1, k) for k in PREFIXES])
    plain = (
        counts.select("feature", (F.col("toxic") + F.col("clean")).alias("n"), F.explode(F.array_distinct(parts)).alias("part"))
        .join(F.broadcast(kept.select(F.col("feature").alias("part"))), "part")
        .where(F.col("n") > telling).groupBy("feature").agg(F.first("n").alias("n"))
        .orderBy(F.col("n").desc(), "feature").limit(limit).collect()
    )
    return {r.feature: 0.0 for r in plain} | weights


def _scored(train: DataFrame, model: ToxicityModel) -> DataFrame:
    """Per document: its class, words, hits, best segment and normalised score,
    from all its segments as :func:`toxicity_scores` has them; the last two are
    null without a segment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            tokens = [words(t) for t in utf8(batch, "text")]
            hits = [scorer.hits(t) for t in tokens]
            found = [[s for *_, s in maximal_segments(h, model.drift)] for h in hits]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(list(map(len, tokens)), pa.int64()), pa.array(list(map(len, hits)), pa.int64()),
                 pa.array([max(s, default=None) for s in found], pa.float64()),
                 pa.array([model.normalised(len(t), s) if s else None for t, s in zip(tokens, found, strict=True)], pa.float64())],
                ["toxic", "n", "hits", "best", "normalised"])

    return train.select("text", "toxic").mapInArrow(run, "toxic int, n long, hits long, best double, normalised double")


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps with a small ridge."""
    a = np.stack([x, np.ones_like(x)], 1)
    w = np.array([0.1, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a.T * (p * (1 - p))) @ a + 1e-2 * np.eye(2), a.T @ (p - y) + 1e-2 * w)
        w = w - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 1e-3), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, training_rows: int = TRAINING_ROWS,
        limit: int = MODEL_FEATURES) -> ToxicityModel:
    """The model from at most ``training_rows`` labelled documents that are not
    held out.  A document with several labels is toxic if one says so.

    The sampled labels (id and class) are broadcast to the scan of the
    documents, which is proven small by the bound; their texts are kept in the
    shared folder for the passes over them.  Without toxic or without
    clean training documents every score is 0.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    sample = (
        marked.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(training_rows)
    )
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).where("text is not null")
    train = stored(texts.join(F.broadcast(sample), "doc_id").select("text", "toxic"), "toxicity-training")

    plain = _scored(train, ToxicityModel({})).groupBy("toxic").agg(F.sum("n").alias("n"), F.count("*").alias("docs"))
    sizes = {r.toxic: r for r in plain.collect()}
    if not all(y in sizes and sizes[y].n for y in (0, 1)):
        return ToxicityModel({})
    counts = stored(_feature_counts(train).where(F.col("toxic") + F.col("clean") >= MIN_DOCS), "toxicity-features")
    weights = _log_odds(counts, sizes[1].n, sizes[0].n, sizes[1].docs, sizes[0].docs, limit)
    model = ToxicityModel(weights)
    shares = {r.toxic: (r.hits + 0.5) / (r.n + 1) for r in
              _scored(train, model).groupBy("toxic").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n")).collect()}
    model.drift = min(log((1 - shares[1]) / (1 - shares[0])), -0.005)

    best = [(r.best or 0.0, r.n) for r in _scored(train, model).where("n > 0 and toxic = 0").select("best", "n").collect()]
    # Gumbel: the best score of n clean words is log(k n) plus Euler's constant on average (scores are log-odds, so lambda is 1)
    model.k = exp(min(max(float(np.mean([s - log(n) for s, n in best])) - EULER, -20.0), 0.0))
    rows = _scored(train, model).where("n > 0").select("toxic", "normalised").collect()
    with_hits = [r for r in rows if r.normalised is not None]
    if with_hits:
        model.slope, model.offset = _logistic(
            np.array([r.normalised for r in with_hits]), np.array([float(r.toxic) for r in with_hits]))
    bare = [r.toxic for r in rows if r.normalised is None]
    model.empty = min(0.5, (sum(bare) + 0.05) / (len(bare) + 1))
    return model


SCORE_SCHEMA = "doc_id long, n_words long, score double, segments array<struct<first:long,after:long,score:double>>"


def toxicity_scores(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, n_words, score (0 to 1), segments (maximal segments that clean
    text of that length would show less than once, by position) of every whole
    text.  Null texts count as empty; empty ones get the model's base score.
    One pass, no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        kind = pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64()), ("score", pa.float64())]))
        for batch in batches:
            found = [scorer.segments(t) for t in utf8(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([n for n, _ in found], pa.int64()),
                 pa.array([model.probability(n, [s for *_, s in seg]) for n, seg in found], pa.float64()),
                 pa.array([[{"first": a, "after": b, "score": s} for a, b, s in seg if s > log(max(model.k * n, 1.0))]
                           for n, seg in found], kind)],
                ["doc_id", "n_words", "score", "segments"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCORE_SCHEMA)


def toxicity_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """op7: score and prediction for every document."""
    return toxicity_scores(docs, fit(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), F.size("segments").cast("long").alias("n_segments"))
