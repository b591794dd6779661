import datetime as dt
import time

import pytest
from pyspark.errors import AnalysisException

from shelfline.schemas import STORES
from shelfline.session import SHUFFLE_CLEANUP, fresh_path
from shelfline.sinks import SnapshotTable, parquet
from shelfline.sources import files
from shelfline.sources.jdbc import JdbcSource
from shelfline.sources.layout import Lake
from tests.conftest import rows

D1, D2, D3 = dt.date(2025, 10, 19), dt.date(2025, 10, 20), dt.date(2025, 10, 21)


def test_lake_paths():
    lake = Lake("abfss://c@a.dfs.core.windows.net/")
    assert lake.path("raw", "transactions", "sales") == "abfss://c@a.dfs.core.windows.net/raw/transactions/sales"
    assert lake.path("raw", "reference", "products", "2025-07").endswith("products/version=2025-07")


def test_csv_with_quoted_commas(spark):
    p = fresh_path(spark, "stores-csv")
    import os
    local = p[len("file:"):] if p.startswith("file:") else p
    os.makedirs(local)
    with open(f"{local}/stores.csv", "w") as f:
        f.write('store_id,name,address,town,number_of_employees\n'
                'S001,Store Elm,1 Elm St,Tunis,11\n'
                'S008,"Store Murphy, Carey and Sons",2 Isle,Gabes,13\n')
    declared = files.read_csv(spark, p, STORES)
    assert rows(declared, "store_id", "name", "number_of_employees") == [
        ("S001", "Store Elm", 11), ("S008", "Store Murphy, Carey and Sons", 13)]
    inferred = files.read_csv(spark, p)
    assert inferred.schema["number_of_employees"].dataType.typeName() == "integer"


def _days(spark):
    return spark.createDataFrame([(D1, 1), (D2, 2), (D2, 3), (D3, 4)], "date date, v long")


def test_replace_day_is_idempotent(spark):
    p = fresh_path(spark, "replace")
    parquet.write_partitioned(_days(spark), p, "date")
    fix = spark.createDataFrame([(D2, 20)], "date date, v long")
    parquet.replace_partitions(fix, p, "date")
    parquet.replace_partitions(fix, p, "date")
    assert rows(files.read_parquet(spark, p), "date", "v") == [(D1, 1), (D2, 20), (D3, 4)]
    assert rows(files.read_partition(spark, p, D2), "date", "v") == [(D2, 20)]
    assert files.read_partition(spark, p, dt.date(2030, 1, 1)).count() == 0


def test_write_once_refuses_rerun(spark):
    p = fresh_path(spark, "once")
    parquet.write_once(_days(spark), p)
    with pytest.raises(AnalysisException):
        parquet.write_once(_days(spark), p)


def test_reference_versions(spark):
    root = fresh_path(spark, "ref")
    for v, n in (("2025-06", 1), ("2025-07", 2), ("2025-09", 3)):
        parquet.write_once(spark.createDataFrame([(n,)], "n long"), f"{root}/version={v}")
    assert rows(files.read_version(spark, root)) == [(3,)]
    assert rows(files.read_version(spark, root, "2025-06")) == [(1,)]
    assert rows(files.read_version_as_of(spark, root, "2025-08")) == [(2,)]


def test_snapshot_table_versions_and_time_travel(spark):
    t = SnapshotTable(spark, fresh_path(spark, "snap"))
    assert not t.exists()
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    assert t.merge(a, "k") == 0                       # create on first merge (W7c)
    t0 = t.history()[0].published_at
    assert t.merge(spark.createDataFrame([(2, "B"), (3, "c")], "k long, v string"), "k") == 1
    assert rows(t.read()) == [(1, "a"), (2, "B"), (3, "c")]
    assert rows(t.read(version=0)) == [(1, "a"), (2, "b")]   # version 0 is a real version
    assert rows(t.read(timestamp=t0)) == [(1, "a"), (2, "b")]
    assert t.overwrite(a) == 2 and rows(t.read()) == rows(a)
    with pytest.raises(ValueError):
        t.read(timestamp=dt.datetime(2000, 1, 1))


def test_snapshot_table_partition_writes(spark):
    t = SnapshotTable(spark, fresh_path(spark, "fact"))
    t.append(_days(spark).where("date < '2025-10-21'"), "date")            # creates
    t.append(_days(spark).where("date = '2025-10-21'"), "date")
    t.replace_partitions(spark.createDataFrame([(D1, 10)], "date date, v long"), "date")
    t.replace_partitions(spark.createDataFrame([(D1, 10)], "date date, v long"), "date")
    assert rows(t.read(), "date", "v") == [(D1, 10), (D2, 2), (D2, 3), (D3, 4)]
    assert [h.operation for h in t.history()] == ["overwrite", "append", "replace_partitions", "replace_partitions"]


def test_jdbc_options_split_reads():
    src = JdbcSource("jdbc:postgresql://db/retail", {"user": "u", "driver": "org.postgresql.Driver"},
                     partitioning={"sales": ("sale_id", 0, 1_000_000, 16)})
    o = src.options("sales")
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == \
        ("sale_id", "0", "1000000", "16")
    assert "partitionColumn" not in src.options("payments")


def test_snapshot_changed_in_place_cannot_be_read_as_it_was(spark):
    from shelfline.session import fresh_path
    from shelfline.sinks.tables import SnapshotTable
    t = SnapshotTable(spark, fresh_path(spark, "in-place"))
    t.overwrite(spark.createDataFrame([(1, "a")], "k int, date string"), "date")
    first = t.history()[0].published_at
    assert t.read(version=0).count() == t.read(timestamp=first).count() == 1
    t.append(spark.createDataFrame([(2, "b")], "k int, date string"), "date")
    for how in ({"version": 0}, {"timestamp": first}):
        with pytest.raises(ValueError):
            t.read(**how)
    assert t.read().count() == t.read(timestamp=t.history()[-1].published_at).count() == 2


def test_replace_clears_a_named_partition_without_rows(spark):
    from shelfline.session import fresh_path
    from shelfline.sinks import parquet
    p = fresh_path(spark, "clear")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, part string")
    parquet.write_partitioned(df, p, "part")
    parquet.replace_partitions(df.where("k = 2"), p, "part", ["a", "b", "d"])
    assert sorted(r.k for r in spark.read.parquet(p).collect()) == [2, 3]


def test_format_is_passed_through(spark):
    from shelfline.session import fresh_path
    from shelfline.sinks.tables import FormatTable, SnapshotTable, open_table
    p = fresh_path(spark, "orc-table")
    t = open_table(spark, p, "orc")
    assert isinstance(t, FormatTable) and isinstance(open_table(spark, p), SnapshotTable)
    assert not t.exists()
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, date string")
    t.merge(df, "k", partition_by="date")  # creates the table
    t.append(df.where("k = 2"))
    assert t.exists() and t.read().count() == 3
    t.replace_partitions(df.where("k = 2"))
    assert t.read().count() == 2


def test_jdbc_needs_a_choice_of_parallelism(spark):
    from shelfline.sources.jdbc import JdbcSource
    src = JdbcSource("jdbc:none:", partitioning={"sales": ("sale_id", 0, 100, 4)}, single_partition=frozenset({"stores"}))
    assert src.options("sales")["numPartitions"] == "4"
    with pytest.raises(ValueError):
        src.read(spark, "payments")
    with pytest.raises(ValueError):
        src.read_query(spark, "select 1")


def _shuffle_files(spark):
    at = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    files = at.getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


@pytest.mark.parametrize("write", [
    lambda df, p: parquet.write_partitioned(df, p, "date"),
    lambda df, p: parquet.replace_partitions(df, p, "date", [dt.date(2025, 1, 1)]),
    lambda df, p: parquet.write_once(df.repartition(3, "date"), p),
    lambda df, p: parquet.overwrite(df.repartition(3, "date"), p)])
def test_shuffle_files_of_a_write_go_with_it(spark, write):
    df = spark.range(5000).selectExpr("id", "date_add(DATE'2025-01-01', cast(id % 7 as int)) as date")
    before = _shuffle_files(spark)
    path = fresh_path(spark, "no-shuffle-files")
    write(df, path)
    for _ in range(50):  # they are removed in the background
        if _shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert _shuffle_files(spark) <= before
    assert spark.read.parquet(path).count() == 5000
    assert spark.conf.get(SHUFFLE_CLEANUP, None) != "true"
