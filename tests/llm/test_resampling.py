import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfline.llm import resampling
from tests.llm.helpers import awkward, docs, empty


def strings(items):
    length = np.array([len(s) for s in items], np.int64)
    data = np.frombuffer(b"".join(items) + bytes(16), np.uint8)
    return resampling.Strings(data, np.cumsum(length) - length, length)


def test_hashes_equal_the_library():
    rng = random.Random(1)
    items = [rng.randbytes(n) for n in [*range(70), 300, 1000] for _ in range(3)]
    assert strings(items).xxh64().tolist() == [xxhash.xxh64_intdigest(s) for s in items]


@pytest.mark.parametrize("keys", [None, "equal", "few"])
def test_table_verifies_bytes(keys):
    rng = random.Random(2)
    items = [rng.choice([b"a", b"b", b"ab", b"x" * 300, b"x" * 299 + b"y", b"abcdefghi", b"abcdefghj"]) for _ in range(500)]
    keys = None if keys is None else np.array([0 if keys == "equal" else len(s) for s in items], np.uint64)
    table = resampling.NgramTable(strings(items), 97, keys)
    assert {s: {table.slot[i] for i, x in enumerate(items) if x == s} for s in set(items)}.keys() == set(items)
    assert len(table.used) == len(set(items))
    for s, n in Counter(items).items():
        slot = {int(table.slot[i]) for i, x in enumerate(items) if x == s}
        assert len(slot) == 1 and table.count[slot.pop()] == n
    assert all(table.bucket[table.slot[i]] == crc32(s) % 97 for i, s in enumerate(items))


def brute(texts, target, shortest, longest, buckets, percent, min_words):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        grams = [" ".join(words[i:i + n]) for n in range(shortest, longest + 1) for i in range(len(words) - n + 1)]
        return words, [crc32(g.encode()) % buckets for g in grams]

    s = Counter(b for _, t in texts for b in features(t)[1])
    t = Counter(b for x in target for b in features(x)[1])
    big, small = sum(s.values()) + buckets, sum(t.values()) + buckets
    rows = []
    for i, text in texts:
        words, own = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * big / ((s[b] + 1) * small))) for b in own) // max(1, len(own))
        h = int(sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(words), len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    drawn = len(able) * percent // 100
    able = [[*r, k + 1 if k < drawn else None] for k, r in enumerate(able)]
    able += [[*r, None] for r in rows if r[1] < min_words]
    return sorted(able, key=str)


@pytest.mark.parametrize("shortest,longest", [(1, 1), (1, 3), (2, 2)])
def test_equals_brute_force(spark, shortest, longest, monkeypatch):
    rng = random.Random(3)
    monkeypatch.setattr(resampling, "CHUNK_BYTES", 500)
    vocabulary = ["The", "cat", "É", "Straße", "dog-house", "x" * 40, "n0", "été", "a_b"]
    texts = [(i, rng.choice([" ", ", "]).join(rng.choices(vocabulary, k=rng.randint(0, 30)))) for i in range(120)]
    texts += [(None, "null id " * 9)] * 3 + [(7, texts[7][1])] * 5 + [(200, None), (201, ""), (202, "--- !")]
    target = [" ".join(rng.choices(["cat", "été", "sat"], k=9)) for _ in range(9)] + [None]
    items = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id long, text string")
    scores = resampling._scores(docs(spark, texts), items, shortest=shortest, longest=longest, buckets=50)
    got = resampling.ranked(scores, F.col("n_words") >= 5, 30).collect()
    assert sorted((list(r[c] for c in ("doc_id", "n_words", "n_features", "weight", "score", "rank")) for r in got), key=str) \
        == brute(texts, target, shortest, longest, 50, 30, 5)


def test_many_equal_rows_keep_their_ranks(spark, monkeypatch):
    monkeypatch.setattr(resampling, "COPIES", 3)
    rows = docs(spark, [(1, "a b c")] * 10 + [(None, "a b")] * 7 + [(2, "c")])
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    out = resampling.ranked(resampling._scores(rows, items), F.lit(True), 100).collect()
    assert sorted(r["rank"] for r in out) == list(range(1, 19))


def test_drawn_rows_keep_all_columns(spark):
    texts = [(i % 40, " ".join(["alpha", "beta", "gamma"][: i % 3 + 1] * (i % 9 + 1))) for i in range(100)]
    items = spark.createDataFrame([(1, "alpha alpha beta")], "item_id long, text string")
    df = docs(spark, texts).withColumn("scored", F.lit("mine")).withColumn("rank", F.lit(1))
    out = resampling.resampled(df, items, percent=25, min_words=3).collect()
    report = resampling.resample_report(df, items, percent=25, min_words=3).where("rank is not null").collect()
    assert sorted(r["_scored"].score for r in out) == sorted(r.score for r in report)
    assert len(out) == sum(len(t.split()) >= 3 for _, t in texts) // 4 and out[0].scored == "mine"


def test_awkward_rows(spark):
    items = spark.createDataFrame([(1, "same text")], "item_id long, text string")
    rows = resampling.resample_report(awkward(spark), items).collect()
    assert len(rows) == 10 and sum(r.n_features == 0 for r in rows) == 3
    assert resampling.resample_report(empty(spark), items).count() == 0
    assert resampling.resample_report(awkward(spark), items.limit(0)).count() == 10
    assert resampling.resampled(empty(spark), items).count() == 0
