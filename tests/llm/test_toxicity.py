import random
import zlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfline.llm import toxicity as T
from tests.llm.helpers import awkward, docs, empty

SF = "/root/testdata/sf0.01"


def brute_segments(scores):
    """Maximal segments by their definition, recursively: the best one, then left and right of it."""
    def go(a, b):
        best = None
        for i in range(a, b):
            for j in range(i + 1, b + 1):
                s = sum(scores[i:j])
                if s > 1e-12 and (best is None or s > best[2] + 1e-12 or (abs(s - best[2]) <= 1e-12 and j - i < best[1] - best[0])):
                    best = (i, j, s)
        return [] if best is None else [*go(a, best[0]), best, *go(best[1], b)]
    return go(0, len(scores))


@settings(max_examples=200, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from([0, 0, 0, 1.013, 2.0171, 3.0313, 0.5057]), max_size=14))
def test_segments_are_the_maximal_ones(values):
    drift = -0.37
    hits = [(i, v) for i, v in enumerate(values) if v]
    found = T.maximal_segments(hits, drift)
    expected = brute_segments([v or drift for v in values])
    assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in expected]
    assert all(abs(x[2] - y[2]) < 1e-9 for x, y in zip(found, expected, strict=True))


def test_held_out_scores(spark):
    docs_, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: r for r in T.toxicity_report(docs_, labels).collect()}
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for i, r in rows.items())
    held = [(rows[r.doc_id].score, r.toxic) for r in labels.collect() if rows[r.doc_id].held_out]
    toxic, clean = [s for s, t in held if t], [s for s, t in held if not t]
    auc = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert auc > 0.9 and sum(s >= 0.7 for s in clean) <= 0.03 * len(clean) and sum(s >= 0.7 for s in toxic) >= 0.6 * len(toxic)


def test_held_out_labels_change_nothing(spark):
    from pyspark.sql import functions as F
    docs_, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("toxic", F.when(T.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert T.fit(docs_, labels) == T.fit(docs_, flipped)


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(9)] + [(3, 1, 1), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    rows = T.toxicity_report(awkward(spark), labels).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [True]
    assert T.toxicity_report(empty(spark), labels).count() == 0
    unlabelled = T.toxicity_report(docs(spark, ["a b", None]), labels.where("false")).collect()
    assert [(r.score, r.predicted) for r in unlabelled] == [(0.0, 0), (0.0, 0)]


def test_rare_toxic_words_are_learned_at_any_size(spark):
    """200 toxic words, one a document: more training documents never unlearn one."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8))
    rare, common = [word() for _ in range(200)], [word() for _ in range(300)]
    ids = (i for i in range(10**6) if zlib.crc32(str(i).encode()) % 3 != 1)
    learned = []
    for size in (8, 11):  # toxic documents of each word; 35 and 47 were asked for
        texts = [([r] * 3, 1) for r in rare for _ in range(size)] + [([], 0)] * (200 * size * 6)
        rows = [(next(ids), " ".join(t + rng.choices(common, k=12)), y) for t, y in texts]
        labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
        weights = T.fit(docs(spark, [(i, t) for i, t, _ in rows]), labels).weights
        assert not any(weights.get(c + "$", 0) > 0 for c in common)
        learned.append({r for r in rare if weights.get(r + "$", 0) > 0})
    assert len(learned[0]) >= 190 and learned[0] <= learned[1]


def test_calibration_sees_all_segments(spark):
    """200 segments of one training document count in the fit as they do in the score."""
    from math import exp
    model = T.ToxicityModel({"bad$": 3.0}, drift=-0.05, k=exp(-20))
    text = ("bad " + "plain " * 100) * 200
    row, = T._scored(spark.createDataFrame([(text, 1)], "text string, toxic int"), model).collect()
    n, segments = model.scorer().segments(text.encode())
    assert len(segments) == 200 == row.hits and row.n == n
    assert row.normalised == model.normalised(n, [s for *_, s in segments]) > model.normalised(n, [s for *_, s in segments[:64]])
