import datetime as dt

from shelfline.config import CURATED
from shelfline.plans import jobs
from shelfline.session import fresh_path
from shelfline.streaming import process_new_days
from tests.conftest import rows
from tests.test_jobs import sources  # noqa: F401  (fixture)


def test_new_days_are_processed_once(spark, tmp_lake, sources):  # noqa: F811
    jobs.ingest_full(spark, tmp_lake, sources, version="2025-10")
    ckpt = fresh_path(spark, "ckpt")
    first = process_new_days(spark, tmp_lake, checkpoint=ckpt, median_method="exact")
    assert first == [dt.date(2025, 9, 30), dt.date(2025, 10, 20), dt.date(2025, 10, 21)]
    fact = jobs.table(spark, tmp_lake, CURATED, "fact_sales")
    assert fact.read().count() == 4
    assert process_new_days(spark, tmp_lake, checkpoint=ckpt) == []
    jobs.ingest_daily(spark, tmp_lake, sources, day="2025-10-20")
    assert process_new_days(spark, tmp_lake, checkpoint=ckpt, median_method="exact") == [dt.date(2025, 10, 20)]
    assert rows(fact.read(), "sale_id") == [(1,), (2,), (3,), (4,)]
