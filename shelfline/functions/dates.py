"""Date expressions: calendar date of a sale, yyyymmdd keys, month labels."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sale_date(ts="timestamp") -> Column:
    """Calendar date of a timestamp."""
    return F.to_date(_c(ts))


def date_key(d="date") -> Column:
    """Integer key yyyymmdd of a date (D2 + D3)."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_label(d="date") -> Column:
    """'yyyy-MM' of a date: month start, then formatted (D4 + D5)."""
    return F.date_format(F.date_trunc("month", _c(d)), "yyyy-MM")


def month_of_parts(year="year", month="month") -> Column:
    """'yyyy-MM' built from integer year and month."""
    return F.concat(_c(year).cast("string"), F.lit("-"), F.lpad(_c(month).cast("string"), 2, "0"))


def month_range(month: str) -> tuple[_dt.date, _dt.date]:
    """Half-open [first day, first day of next month) of 'yyyy-MM'.  A range
    predicate on the date column prunes date partitions (F5)."""
    y, m = (int(x) for x in month.split("-"))
    lo = _dt.date(y, m, 1)
    hi = _dt.date(y + (m == 12), m % 12 + 1, 1)
    return lo, hi


def to_day(d) -> _dt.date:
    if isinstance(d, _dt.datetime):
        return d.date()
    if isinstance(d, _dt.date):
        return d
    return _dt.date.fromisoformat(str(d))


def day_window(day, days: int = 1) -> tuple[_dt.datetime, _dt.datetime]:
    """Half-open [day 00:00, day + days 00:00) of an ingest increment."""
    lo = _dt.datetime.combine(to_day(day), _dt.time())
    return lo, lo + _dt.timedelta(days=days)


def in_window(df, column: str, lo, hi) -> Column:
    """``lo <= column < hi`` with the bounds typed like the column, so the
    predicate stays a plain comparison that reaches the scan (or JDBC)."""
    t = df.schema[column].dataType
    return (F.col(column) >= F.lit(lo).cast(t)) & (F.col(column) < F.lit(hi).cast(t))
