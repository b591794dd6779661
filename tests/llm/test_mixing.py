import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from shelfline.llm import mixing as M
from tests.llm.helpers import DOCS, awkward, empty


def fixture(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        source = rng.choice(["a"] * 6 + ["b", "c", "Z", "é", None])
        rows.append((i, " ".join(["w"] * rng.choice([0, 1, 5, 40])), "en", source, 0))
    rows.append((1000, "\x1cx\u2003y z\tq", "en", "one", 0))
    return spark.createDataFrame(rows + [rows[3], rows[3]], DOCS), rows + [rows[3], rows[3]]


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(rows):
    total = {}
    for _, t, _, s, _ in rows:
        total[s] = total.get(s, 0) + size(t)
    names = sorted((s for s in total if s is not None), key=lambda s: s.encode("utf-8")) + ([None] if None in total else [])
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    target, left = {}, float(sum(total.values()))
    while True:
        open_ = [s for s in names if s not in target]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = [s for s in open_ if share[s] > 3 * total[s]]
        if not full:
            return total, target | share
        for s in full:
            target[s] = 3.0 * total[s]
            left -= target[s]


def test_targets_and_words_taken(spark):
    df, rows = fixture(spark)
    out = M.mix_report(df).collect()
    assert len(out) == len(rows)
    total, target = brute_targets(rows)
    source = {r[0]: r[3] for r in rows}
    sizes = {r[0]: size(r[1]) for r in rows}
    taken = {}
    for r in out:
        s = source[r.doc_id]
        assert r.size == sizes[r.doc_id] and r.source_size == total[s] and r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 3 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    again = M.mix_report(df.repartition(7)).collect()
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, again), key=str)


def test_positions_follow_the_schedule(spark):
    """Taken words by position grow as the integrated weight schedule says."""
    rows = [(i, "w " * 3, "en", "a" if i % 2 else "c", 0) for i in range(4000)]
    plan = M.curriculum(spark.createDataFrame(rows, DOCS)).collect()
    for source, rates in (("a", M.SCHEDULE[0]), ("c", M.SCHEDULE[1])):
        own = [(c.position, c.words) for r in plan if r.source == source for c in r.copies]
        total = sum(w for _, w in own)
        done = 0.0
        for k, rate in enumerate(rates):
            done += rate / len(rates)
            assert sum(w for p, w in own if p <= (k + 1) / len(rates)) / total == pytest.approx(done, abs=0.01)
    with pytest.raises(ValueError):
        M.curriculum(spark.createDataFrame(rows[:1], DOCS), schedule=((1.0, 2.0),))


def test_mix_has_the_planned_copies(spark):
    df, _ = fixture(spark)
    plan = {}
    for r in M.curriculum(df).collect():
        for c in r.copies:
            plan.setdefault(r.doc_id, []).append((round(c.position, 9), c.words))
    rows = M.mixed(df).collect()
    assert [r.mix_position for r in rows] == sorted(r.mix_position for r in rows)
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((round(r.mix_position, 9), r.mix_words))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in plan.items()}


def test_awkward_rows(spark):
    out = M.mix_report(awkward(spark)).collect()
    assert len(out) == 10 and sum(r.taken for r in out) == sum(r.size for r in out)
    assert M.mix_report(empty(spark)).count() == 0 and M.mixed(empty(spark)).count() == 0
    bare = spark.createDataFrame([(1, None, "en", "a", 0), (2, "", "en", None, 0)], DOCS)
    assert [(r.target, r.taken) for r in M.mix_report(bare).collect()] == [(0.0, 0), (0.0, 0)]


def test_report_equals_its_sql(spark):
    df, rows = fixture(spark)
    many = df.where("doc_id = 3").crossJoin(spark.range(1300)).drop("id")  # more equal rows than a block holds
    df = df.unionByName(many).unionByName(df.where("doc_id < 40").selectExpr("cast(null as long) doc_id", "text", "lang", "source", "n_chars"))
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    expected = con.execute(M.REPORT_SQL).to_arrow_table().to_pylist()
    out = [r.asDict() for r in M.mix_report(df).collect()]
    assert sorted(map(repr, (sorted(r.items()) for r in out))) == sorted(map(repr, (sorted(r.items()) for r in expected)))


def test_mix_is_stable_for_shared_ids(spark):
    """Two sources with texts of one size under one id, null ids, and rows that differ in another column."""
    rows = [(i, f"{s} {i} w w", "en", s, 0) for i in range(150) for s in "ab"]
    rows += [(None, f"n{i} w", "en", "b", 0) for i in range(100)] + [(7, "x y", "en", "b", k % 3) for k in range(6)]
    df = spark.createDataFrame(rows, DOCS)
    first = sorted(map(str, M.mixed(df).collect()))
    assert first == sorted(map(str, M.mixed(df.repartition(5, "text")).collect()))
    assert first == sorted(map(str, M.mixed(df.orderBy("n_chars", F.desc("text"))).collect()))
    taken = {}
    for r in M.mixed(df).collect():
        taken[r.source] = taken.get(r.source, 0) + r.mix_words
    target = {r.source: r.target for r in M.curriculum(df).select("source", "target").distinct().collect()}
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)


def test_no_hot_slice_for_null_ids(spark):
    rows = [(None if i % 2 else i, f"text {i}", "en", "a", 0) for i in range(2000)]
    placed = M._placed(spark.createDataFrame(rows, DOCS), F.lit(""), M.WEIGHTS, M.REPEATS)
    slices = placed.groupBy(F.col("start")).count()
    assert slices.count() == 2000  # every text has a place of its own
    hashed = spark.createDataFrame(rows, DOCS).select(F.substring(F.md5(F.concat_ws(
        ":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5("text"), F.lit("0"))), 1, M.SLICE_DIGITS).alias("slice"))
    assert hashed.groupBy("slice").count().agg(F.max("count")).first()[0] < 10


def test_mix_of_awkward_rows(spark):
    df = awkward(spark)
    out = M.mixed(df)
    assert out.columns == [*df.columns, "mix_position", "mix_words"]
    assert sum(r.mix_words for r in out.select("mix_words").collect()) == sum(r.size for r in M.mix_report(df).collect())
