"""Importance resampling towards a target distribution.  Word n-grams of a batch are
interned in an open-addressed NumPy table (XXH64 keys, bytes verified); a slot holds the
n-gram's bucket and count, and occurrences reach their gains through their slot ids."""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import WORD_TABLE, broadcast_object, chunks, stored, unused, utf8

#: Text that is interned together.
CHUNK_BYTES = 2_000_000
#: Copies of one result row that one task writes.
COPIES = 4096
SCORE_SCHEMA = "n_words long, n_features long, weight long, score long"
#: Name of the column with the score columns while rows travel whole.
SCORED = "scored"

# The five primes of XXH64.
PRIMES = (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
P1, P2, P3, P4, P5 = (np.uint64(p) for p in PRIMES)


def _turn(h: np.ndarray, bits: int) -> np.ndarray:
    return (h << np.uint64(bits)) | (h >> np.uint64(64 - bits))


class Strings:
    """Byte strings inside one buffer, by start and length."""

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray):
        """``data`` must go on for 8 bytes at least after the last string."""
        self.data, self.start, self.length = data, start, length
        self.by8 = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.start[i]:self.start[i] + self.length[i]].tobytes()

    def xxh64(self) -> np.ndarray:
        """XXH64 (seed 0) of every string; those of 32 bytes and more by the library."""
        start, length = self.start, self.length
        h = P5 + length.astype(np.uint64)
        for j in range(3):
            i = np.flatnonzero(length >= 8 * j + 8)
            word = _turn(self.by8[start[i] + 8 * j] * P2, 31) * P1
            h[i] = _turn(h[i] ^ word, 27) * P1 + P4
        at, left = start + (length & ~7), length & 7
        i = np.flatnonzero(left >= 4)
        h[i] = _turn(h[i] ^ (self.by8[at[i]] & np.uint64(0xFFFFFFFF)) * P1, 23) * P2 + P3
        at = at + (left & 4)
        left = left & 3
        for j in range(3):
            i = np.flatnonzero(left > j)
            h[i] = _turn(h[i] ^ self.data[at[i] + j].astype(np.uint64) * P5, 11) * P1
        h = (h ^ (h >> np.uint64(33))) * P2
        h = (h ^ (h >> np.uint64(29))) * P3
        h ^= h >> np.uint64(32)
        for i in np.flatnonzero(length >= 32):
            h[i] = xxhash.xxh64_intdigest(self.bytes_of(i))
        return h

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether strings ``a`` and ``b``, equal in length pair by pair, are equal byte by byte."""
        out = np.ones(len(a), bool)
        length = self.length[a]
        left, at = np.flatnonzero(length <= 256), 0
        while len(left):
            n = np.minimum(length[left] - at, 8).astype(np.uint64)
            mask = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - n * np.uint64(8))
            differ = ((self.by8[self.start[a[left]] + at] ^ self.by8[self.start[b[left]] + at]) & mask) != 0
            out[left[differ]] = False
            at += 8
            left = left[length[left] > at]
        for i in np.flatnonzero(length > 256):
            out[i] = self.bytes_of(a[i]) == self.bytes_of(b[i])
        return out


class NgramTable:
    """Open-addressed table of the distinct strings of a batch.

    ``slot`` is the slot of every occurrence; ``used`` lists the taken slots, and
    ``bucket`` and ``count`` hold, by slot, the bucket and the occurrences.  All
    occurrences probe at once: those that meet an empty slot claim it, those whose
    slot holds their own key, length and bytes are done, the others go on to the
    next slot.  The table has twice as many slots as there are occurrences.
    """

    def __init__(self, strings: Strings, buckets: int, keys: np.ndarray | None = None):
        n = len(strings.start)
        size = 1 << max(1, 2 * n - 1).bit_length()
        keys = strings.xxh64() if keys is None else keys
        owner = np.full(size, -1, np.int64)
        self.slot = (keys & np.uint64(size - 1)).astype(np.int64)
        left = np.arange(n)
        while len(left):
            at = self.slot[left]
            free = owner[at] < 0
            owner[at[free]] = left[free]
            held = owner[at]
            equal = (keys[held] == keys[left]) & (strings.length[held] == strings.length[left])
            verify = np.flatnonzero(equal & (held != left))
            equal[verify] = strings.same(held[verify], left[verify])
            left = left[~equal]
            self.slot[left] = (self.slot[left] + 1) & (size - 1)
        self.used = np.flatnonzero(owner >= 0)
        self.count = np.bincount(self.slot, minlength=size)
        self.bucket = np.zeros(size, np.int64)
        self.bucket[self.used] = [crc32(strings.bytes_of(i)) % buckets for i in owner[self.used]]


def ngrams(texts: list[bytes], shortest: int, longest: int) -> tuple[np.ndarray, list[tuple[Strings, np.ndarray]]]:
    """Words a text, and for each length from ``shortest`` to ``longest`` the runs of
    so many consecutive words (joined by one space) with the text of each."""
    joined = np.frombuffer(b" ".join([*texts, b" " * 10]).translate(WORD_TABLE), np.uint8)
    letter = joined != 0x20
    first = letter & ~np.concatenate(([False], letter[:-1]))
    last = letter & ~np.concatenate((letter[1:], [False]))
    # each word and one space after it
    kept = letter | np.concatenate(([False], last[:-1]))
    data = np.concatenate((joined[kept], np.zeros(8, np.uint8)))
    start = (np.cumsum(kept) - 1)[first]
    end = (np.cumsum(kept) - 1)[last] + 1
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    cuts = np.searchsorted(np.flatnonzero(first), begins)
    n_words = np.diff(cuts)
    text = np.repeat(np.arange(len(texts)), n_words)
    out = []
    for n in range(shortest, longest + 1):
        whole = np.flatnonzero(text[:len(text) - n + 1] == text[n - 1:]) if n <= len(text) else np.zeros(0, np.int64)
        out.append((Strings(data, start[whole], end[whole + n - 1] - start[whole]), text[whole]))
    return n_words, out


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        texts = utf8(batch, "text")
        for a, b in chunks(texts, CHUNK_BYTES):
            yield batch.slice(a, b - a), texts[a:b]


def bucket_counts(docs: DataFrame, shortest: int = 1, longest: int = 1, buckets: int = 10_000) -> DataFrame:
    """bucket, count of the n-grams of all texts, one row per bucket that occurs.

    Each task sums its own buckets, so at most ``buckets`` rows a task are
    shuffled.  Null text has no words; an empty table gives no row; other columns
    are not read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, texts in _texts(batches):
            for strings, _ in ngrams(texts, shortest, longest)[1]:
                table = NgramTable(strings, buckets)
                np.add.at(total, table.bucket[table.used], table.count[table.used])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["bucket", "count"])

    return (docs.select(F.col("text").cast("string")).mapInArrow(count, "bucket long, count long")
            .groupBy("bucket").agg(F.sum("count").alias("count")))


def gains(raw: DataFrame, target: DataFrame, buckets: int = 10_000) -> np.ndarray:
    """The gain of every bucket, floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))), from the two
    tables of bucket counts.  They have at most ``buckets`` rows each, whatever the input."""
    s, t = ({r.bucket: r["count"] for r in c.collect()} for c in (raw, target))
    over, under = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    return np.array([math.floor(1000 * math.log((t.get(b, 0) + 1.0) * over / ((s.get(b, 0) + 1.0) * under)))
                     for b in range(buckets)], np.int64)


def noise(seed: int, doc_id: int | None) -> int:
    """1000 times a Gumbel variate, rounded down, that depends on the seed and the id
    only; a null id counts as the empty string."""
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def importance(docs: DataFrame, target: DataFrame, shortest: int = 1, longest: int = 1, buckets: int = 10_000,
               seed: int = 2024) -> DataFrame:
    """All columns of ``docs`` (name clashes: the struct takes underscores before its
    name) and the struct ``scored``: n_words, n_features, weight, score.

    weight is the floored mean gain of the text's n-grams (0 without any); score adds
    ``noise``.  Null text has no words; null and repeated ids and repeated rows are
    scored like any other.  Two passes over the texts, no text is shuffled.
    """
    gain = broadcast_object(docs.sparkSession, gains(
        bucket_counts(docs, shortest, longest, buckets), bucket_counts(target, shortest, longest, buckets), buckets))
    text, key, out = unused(docs, "text_", "key_", SCORED)
    plain = docs.withColumns({text: F.col("text").cast("string"), key: F.col("doc_id").cast("long")})
    names = docs.columns
    fields = [f.strip().split(" ")[0] for f in SCORE_SCHEMA.split(",")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_bucket = gain()
        for batch in batches:
            texts = utf8(batch, text)
            for a, b in chunks(texts, CHUNK_BYTES):
                n_words, runs = ngrams(texts[a:b], shortest, longest)
                sums, n = np.zeros(b - a, np.int64), np.zeros(b - a, np.int64)
                for strings, of in runs:
                    table = NgramTable(strings, buckets)
                    slot_gain = of_bucket[table.bucket]
                    np.add.at(sums, of, slot_gain[table.slot])
                    n += np.bincount(of, minlength=b - a)
                weight = np.where(n > 0, sums // np.maximum(n, 1), 0)
                part = batch.slice(a, b - a)
                total = weight + np.array([noise(seed, i) for i in part.column(key).to_pylist()], np.int64)
                scored = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (n_words, n, weight, total)], fields)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(names))), scored], [*names, out])

    return plain.mapInArrow(score, ", ".join(
        [*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), f"`{out}` struct<{SCORE_SCHEMA.replace(' long', ':long')}>"]))


def _offsets(counts: DataFrame, width: int = 256) -> DataFrame:
    """score, before: rows with a higher score.  ``counts`` (score, n) has one row per
    score; scores are whole numbers within a range that the gains and the noise
    bound (some 200,000), whatever the input.  Sums go over slices of the range first."""
    rows = counts.withColumn("slice", F.floor(F.col("score") / width))
    above = Window.orderBy(F.col("slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("slice").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, -1)
    slices = rows.groupBy("slice").agg(F.sum("n").alias("n")).select(
        "slice", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("above"))
    return (rows.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(slices, "slice")
            .select("score", (F.col("above") + F.col("inside")).alias("before")))


def ranked(scores: DataFrame, eligible: Column, percent: int = 10) -> DataFrame:
    """The rows of ``scores`` (doc_id, n_words, n_features, weight, score) with rank: 1, 2,
    ... for the floor(percent * N / 100) highest scores of the N eligible rows, ties to
    smaller doc_id (null last), then fewer features; null for the others.

    Rows are counted per score, so the order of the whole comes from offsets and each
    window holds one score.  Equal rows are one row with a count on the way, however
    many there are.  Empty tables give an empty result.
    """
    columns = scores.columns
    inside = scores.where(eligible)
    drawn = inside.count() * percent // 100
    distinct = inside.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    offsets = _offsets(inside.groupBy("score").agg(F.count(F.lit(1)).alias("n")))
    before = Window.partitionBy("score").orderBy(
        F.col("doc_id").asc_nulls_last(), "n_features", "weight", "n_words").rowsBetween(Window.unboundedPreceding, -1)
    placed = stored(
        distinct.join(offsets, "score")
        .withColumn("first", F.col("before") + F.coalesce(F.sum("copies").over(before), F.lit(0)) + 1)
        .select(*columns, "copies", "first"), "resample-ranks")
    last = F.col("first") + F.col("copies") - 1
    few = placed.where(F.col("copies") <= COPIES).select(*columns, F.explode(F.sequence("first", last)).alias("rank"))
    blocks = (placed.where(F.col("copies") > COPIES)
              .select(*columns, last.alias("last"), F.explode(F.sequence(F.col("first"), last, F.lit(COPIES))).alias("block"))
              .repartition("block"))
    many = blocks.select(*columns, F.explode(F.sequence("block", F.least(F.col("block") + COPIES - 1, "last"))).alias("rank"))
    others = scores.where(~eligible).withColumn("rank", F.lit(None).cast("long"))
    return few.unionByName(many).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).unionByName(others)


def _scores(docs: DataFrame, target: DataFrame, **options: int) -> DataFrame:
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(importance(narrow, target, **options).select("doc_id", f"{SCORED}.*"), "resample-scores")


def resampled(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, **options: int) -> DataFrame:
    """The drawn rows, all columns of ``docs`` and ``scored``: the floor(percent * N /
    100) highest scores of the N rows of at least ``min_words`` words, ties to
    smaller doc_id, then by text.  Nulls, repeated rows and clashing names as in ``importance``."""
    rows = importance(docs, target, **options)
    scored = rows.columns[-1]
    rows = stored(rows, "resample-rows").where(F.col(f"{scored}.n_words") >= min_words)
    scores = rows.select(F.col(f"{scored}.score").alias("score"))
    drawn = scores.count() * percent // 100
    offsets = _offsets(scores.groupBy("score").agg(F.count(F.lit(1)).alias("n")))
    cut = offsets.where(F.col("before") < drawn).orderBy(F.col("before").desc()).first()
    if cut is None:
        return rows.limit(0)
    score = F.col(f"{scored}.score")
    ties = rows.where(score == cut.score).orderBy(F.col("doc_id").asc_nulls_last(), "text").limit(drawn - cut.before)
    return rows.where(score > cut.score).unionByName(ties)


def resample_report(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20) -> DataFrame:
    """op11: doc_id, n_features, weight, score, rank of every document."""
    return ranked(_scores(docs, target), F.col("n_words") >= min_words, percent).select(
        "doc_id", "n_features", "weight", "score", "rank")


#: The same in DuckDB SQL.  CRC32 runs over the bytes of the distinct words, eight shifts a byte.
REPORT_SQL = r"""
WITH RECURSIVE w AS (
  SELECT 0 AS kind, doc_id AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
  UNION ALL
  SELECT 1, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
c AS (SELECT word, hex(encode(word)) AS bytes, 0 AS k, CAST(4294967295 AS bigint) AS crc FROM (SELECT DISTINCT word FROM w)
  UNION ALL
  SELECT word, bytes, k + 1, list_reduce([xor(crc, CAST('0x' || substr(bytes, 2 * k + 1, 2) AS bigint)), 0, 0, 0, 0, 0, 0, 0, 0],
                                         lambda x, y: xor(x >> 1, (x & 1) * 3988292384))
  FROM c WHERE 2 * k < length(bytes)),
b AS (SELECT word, xor(crc, 4294967295) % 10000 AS bucket FROM c WHERE 2 * k = length(bytes)),
o AS (SELECT kind, id, bucket FROM w JOIN b USING (word)),
n AS (SELECT range AS bucket, count(*) FILTER (kind = 0) AS s, count(*) FILTER (kind = 1) AS t FROM range(10000) LEFT JOIN o ON bucket = range GROUP BY 1),
g AS (SELECT bucket, CAST(floor(1000 * ln((t + 1)::double * (sum(s) OVER () + 10000)::double / ((s + 1)::double * (sum(t) OVER () + 10000)::double))) AS bigint) AS gain FROM n),
f AS (SELECT id, count(*) AS n_features, CAST(floor(sum(gain)::double / count(*)) AS bigint) AS weight FROM o JOIN g USING (bucket) WHERE kind = 0 GROUP BY id),
d AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS bigint) AS h FROM documents LEFT JOIN f ON doc_id = id),
r AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0::double))) AS bigint) AS score FROM d)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND row_number() OVER p <= 10 * count(*) FILTER (n_features >= 20) OVER () // 100
            THEN row_number() OVER p END AS rank
FROM r WINDOW p AS (ORDER BY n_features >= 20 DESC, score DESC, doc_id)
"""
