"""Digests by day and dense ids."""

import datetime as dt

from shelfline.operators.digests import changed_days, day_digests
from shelfline.operators.ids import dense_ids
from shelfline.plans import jobs
from shelfline.session import fresh_path
from shelfline.sinks import parquet
from shelfline.sources.layout import Lake
from shelfline.config import RAW_TX

D = [dt.date(2025, 1, i) for i in range(1, 8)]
SCHEMA = "k long, a string, b string, date date"


def changes(spark, before, after):
    old, new = (day_digests(spark.createDataFrame(r, SCHEMA)) for r in (before, after))
    return {r.date: r.status for r in changed_days(new, old).collect()}


def test_exactly_the_days_concerned(spark):
    rows = [(i, f"x{i}", None, D[i % 4]) for i in range(40)] + [(99, "y", "z", None)]
    assert changes(spark, rows, rows[::-1]) == {}
    altered = [(i, "other" if i == 5 else a, b, d) for i, a, b, d in rows]
    assert changes(spark, rows, altered) == {D[1]: "changed"}
    assert changes(spark, rows, [r for r in rows if r[0] != 6]) == {D[2]: "changed"}
    assert changes(spark, rows, [(*r[:3], D[5]) if r[0] == 7 else r for r in rows]) == {D[3]: "changed", D[5]: "new"}
    assert changes(spark, rows, [r for r in rows if r[3] != D[0]]) == {D[0]: "gone"}
    assert changes(spark, rows, [*rows, rows[0], rows[0]]) == {D[0]: "changed"}  # repeated twice
    assert changes(spark, rows, [(k, b, a, d) if k == 4 else (k, a, b, d) for k, a, b, d in rows]) == {D[0]: "changed"}
    assert changes(spark, rows, rows[:-1]) == {None: "gone"}
    assert changes(spark, [], []) == {}


def test_transform_runs_changed_days_only(spark, monkeypatch):
    lake = Lake(fresh_path(spark, "changed-lake"))
    sales = [(i, i, D[i % 3]) for i in range(9)]

    def put(rows):
        for t in jobs.TX_KEYS:
            parquet.write_partitioned(spark.createDataFrame(rows, "sale_id long, v long, date date"), lake.table(RAW_TX, t))

    ran = []
    monkeypatch.setattr(jobs, "transform_daily", lambda spark, lake, *, day, **o: ran.append((day, o)))
    put(sales)
    assert jobs.transform_changed(spark, lake, cap=5.0) == D[:3] and ran == [(d, {"cap": 5.0}) for d in D[:3]]
    assert jobs.transform_changed(spark, lake) == []
    put([(i, -v if i == 4 else v, D[4] if i == 5 else d) for i, v, d in sales])
    assert jobs.transform_changed(spark, lake) == [D[1], D[2], D[4]] and jobs.transform_changed(spark, lake) == []


def test_dense_ids(spark):
    keys = [None, *range(-500, 500)]
    df = spark.createDataFrame([(k, "x") for k in keys + keys], "k long, v string")
    for parts in (3, 8):
        out = dense_ids(df.repartition(parts), ["k"], "id", start=10)
        assert [(r.id, r.k) for r in out.orderBy("id").collect()] == [(10 + i, k) for i, k in enumerate(keys)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "SinglePartition" not in plan
    assert dense_ids(df.where("false"), ["k"], "id").count() == 0
    assert dense_ids(df, ["v", "k"], "id").count() == len(keys)
