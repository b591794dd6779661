from hypothesis import given, settings
from hypothesis import strategies as st

from shelfline import operators as op
from shelfline.operators import dedup
from tests.conftest import rows


def test_dedup_keeps_smallest_row(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", 3.0), (1, None, 9.0), (2, "c", None), (2, "c", None)],
                               "k long, s string, v double")
    out = op.dedup_by_key(df, "k")
    assert out.columns == ["k", "s", "v"]
    assert rows(out) == [(1, None, 9.0), (2, "c", None)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3)), min_size=1, max_size=40))
def test_dedup_idempotent_and_one_per_key(spark, data):
    df = spark.createDataFrame(data, "k long, v long")
    once = op.dedup_by_key(df, "k")
    assert rows(op.dedup_by_key(once, "k")) == rows(once)
    assert rows(once) == sorted({k: min(v for kk, v in data if kk == k) for k, _ in data}.items())


def test_upsert_update_insert_keep(spark):
    target = spark.createDataFrame([(1, "old"), (2, "keep")], "k long, v string")
    source = spark.createDataFrame([(1, "new"), (3, "ins")], "k long, v string")
    once = op.upsert(target, source, "k")
    assert rows(once) == [(1, "new"), (2, "keep"), (3, "ins")]
    assert rows(op.upsert(once, source, "k")) == rows(once)


def test_upsert_duplicate_source_keys(spark):
    target = spark.createDataFrame([(1, "old")], "k long, v string")
    source = spark.createDataFrame([(1, "b"), (1, "a")], "k long, v string")
    assert rows(op.upsert(target, source, "k")) == [(1, "a")]
    try:
        op.upsert(target, source, "k", strict=True)
    except ValueError:
        pass
    else:
        raise AssertionError("strict upsert must refuse duplicate keys")


def test_replace_partitions_and_append(spark):
    import datetime as dt
    d1, d2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
    target = spark.createDataFrame([(d1, 1), (d1, 2), (d2, 3)], "date date, v long")
    source = spark.createDataFrame([(d1, 9)], "date date, v long")
    assert rows(op.replace_partitions(target, source)) == [(d1, 9), (d2, 3)]
    assert rows(op.append_rows(target, source)) == [(d1, 1), (d1, 2), (d1, 9), (d2, 3)]


def test_audit_counts(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.date(2025, 1, 1),), (dt.date(2025, 1, 1),), (dt.date(2025, 1, 5),)], "date date")
    assert rows(op.audit_counts(df)) == [(3, 2, dt.date(2025, 1, 1), dt.date(2025, 1, 5))]


def test_join_split_hot_matches_plain_join(spark):
    from pyspark.sql import functions as F

    from shelfline.operators.skew import hot_keys, join_split_hot
    # key 0 holds a third of the left rows and has two right rows; key 1 is
    # hot but has no right row (kept by the left join, dropped by the inner)
    left = spark.range(3000).select(F.when(F.col("id") < 1000, 0).when(F.col("id") < 1500, 1)
                                    .otherwise(F.col("id") % 300 + 2).alias("k"), F.col("id").alias("v"))
    right = spark.createDataFrame([(0, "a"), (0, "b")] + [(k, f"r{k}") for k in range(2, 300)], "k long, w string")
    assert sorted(r.k for r in hot_keys(left, "k", 100).collect()) == [0, 1]
    for how in ("inner", "left"):
        split = join_split_hot(left, right, "k", how, hot=hot_keys(left, "k", 100), salt_by="v")
        plain = left.join(right, "k", how)
        assert sorted(split.columns) == sorted(plain.columns)
        assert split.count() == plain.count()
        assert split.exceptAll(plain.select(*split.columns)).count() == 0


def test_repeated_keys_by_lists_of_hashes(spark, monkeypatch):
    monkeypatch.setattr(dedup, "HASHES", 50)  # several lists a task
    keys = [str(i) for i in range(400)] + ["7"] * 300 + ["399", None, None]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, v long").repartition(5)
    repeated = dedup.repeated_keys(df, "k")
    assert repeated.count() == 3
    once, again = dedup.split_repeated(df, "k", repeated)
    assert once.count() == 398 and again.count() == 301 + 2 + 2
    assert {r.k for r in again.collect()} == {"7", "399", None}
    assert dedup.repeated_keys(once, "k").count() == 0 and dedup.repeated_keys(df.where("false"), "k").count() == 0


def test_hashes_are_shuffled_in_lists():
    import numpy as np
    import pyarrow as pa
    hashes = np.array([5, 5, 5, (3 << 32) + 1, (3 << 32) + (1 << 31), 2], np.int64)
    out = [b for b in dedup._grouped_hashes(iter([pa.RecordBatch.from_arrays([pa.array(hashes)], ["_hash"])]))]
    assert [r for b in out for r in b.to_pylist()] == [
        {"_group": 0, "_numbers": [2, 5, 5]}, {"_group": 3, "_numbers": [1, -(1 << 31)]}]
