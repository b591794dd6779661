import random

import numpy as np

from shelfline.llm import quality as Q
from tests.llm.helpers import awkward, docs, empty

SF = "/root/testdata/sf0.01"


def test_scores_agree_with_labels_it_never_saw(spark):
    rows = Q.quality_report(spark.read.parquet(f"{SF}/documents.parquet"))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    both = labels.join(rows, "doc_id").select("quality", "predicted").collect()
    assert rows.count() == 1000
    bad = [r.predicted for r in both if r.quality == 0]
    good = [r.predicted for r in both if r.quality == 1]
    assert np.mean(bad) <= 0.1 and np.mean(good) >= 0.98


def test_em_recovers_labeller_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.2  # bad
    hit = np.array([0.9, 0.7, 0.8, 0.6])
    wrong = np.array([0.02, 0.05, 0.1, 0.01])
    votes = np.where(rng.random((20_000, 4)) < np.where(truth[:, None], hit, wrong), Q.BAD, Q.GOOD)
    votes[rng.random((20_000, 4)) < 0.3] = Q.ABSTAIN
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    model = Q.estimate(patterns, n.astype(float))
    assert abs(model.bad - 0.2) < 0.03
    assert np.abs(model.chance[:, 1, Q.BAD] - hit).max() < 0.08 and np.abs(model.chance[:, 0, Q.BAD] - wrong).max() < 0.05
    assert ((model.posterior(votes) < 0.5) == truth).mean() > 0.9


def test_junk_is_told_from_prose(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefghijklmnoprstu", k=rng.randint(2, 8)))
    sentence = lambda: " ".join(word() for _ in range(9)).capitalize() + ". "
    junk = ["BUY NOW!! " * 40, "a### b$$$ c%%% " * 40, "one | two | three | " * 40, "again again again " * 40]
    df = docs(spark, ["".join(sentence() for _ in range(3 + i % 9)) for i in range(80)] + junk * 3)
    kept = Q.keep_good(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == list(range(80))


def test_awkward_rows(spark):
    df = awkward(spark)
    rows = Q.quality_report(df).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert Q.keep_good(df).columns == df.columns
    assert Q.quality_report(empty(spark)).count() == 0 and Q.keep_good(empty(spark)).count() == 0
