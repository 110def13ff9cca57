"""Rows of a time window, from tables that are partitioned by the day of a timestamp.

Files carry no hidden partitioning, so such a table has a column with the day of its timestamp (``DAY_OF``).  A filter on the timestamp alone
reads every file of every day; each window here names the day as well, wherever the table has it, and the scan lists only the folders of
the days it touches.  The endpoint, the second partition column, prunes by itself.  A row without a timestamp has no day and is in no window, so the added
predicate never takes a row away.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import columns as c

# The day column that the table definitions derive from a timestamp.
DAY_OF = {
    "request_timestamp": "request_date",
    "monitoring_timestamp": "monitoring_date",
    "prediction_timestamp": "prediction_date",
    "confirmation_timestamp": "confirmation_date",
}


def days_between(df: DataFrame, ts: str, first: Column | None, last: Column | None, day: str | None = None) -> Column:
    """Condition on the day column of ``ts`` for timestamps from ``first`` to ``last``; true where ``df`` has no such column.

    ``day`` names the column where it is not that of ``DAY_OF``.
    """
    name = day or DAY_OF.get(ts)
    if name not in df.columns:
        return F.lit(True)
    found = F.lit(True)
    if first is not None:
        found = found & (F.col(name) >= F.to_date(first))
    if last is not None:
        found = found & (F.col(name) <= F.to_date(last))
    return found


def _of(df: DataFrame, endpoint: str | None) -> DataFrame:
    return df if endpoint is None else df.where(F.col("endpoint_name") == endpoint)


def last(df: DataFrame, ts: str, as_of: datetime | str, endpoint: str | None = None, day: str | None = None, **span: int) -> DataFrame:
    """Rows in ``(as_of - span, as_of]``; span as days=, hours= or minutes=."""
    upper = c.as_of_literal(as_of)
    lower = upper - F.make_dt_interval(*[F.lit(span.get(k, 0)) for k in ("days", "hours", "minutes")])
    return _of(df.where(days_between(df, ts, lower, upper, day) & c.within_last(ts, as_of, **span)), endpoint)


def half_open(df: DataFrame, ts: str, start: datetime | str, end: datetime | str, endpoint: str | None = None, day: str | None = None) -> DataFrame:
    """Rows in ``[start, end)``; the day of ``end`` is read only if the window reaches into it."""
    until = c.as_of_literal(end) - F.expr("interval 1 microsecond")
    return _of(df.where(days_between(df, ts, c.as_of_literal(start), until, day) & c.half_open(ts, start, end)), endpoint)


def closed(df: DataFrame, ts: str, start: datetime | str, end: datetime | str, endpoint: str | None = None, day: str | None = None) -> DataFrame:
    """Rows in ``[start, end]``."""
    return _of(df.where(days_between(df, ts, c.as_of_literal(start), c.as_of_literal(end), day) & c.closed(ts, start, end)), endpoint)


def since(df: DataFrame, ts: str, start: datetime | str | Column, day: str | None = None) -> DataFrame:
    """Rows from ``start`` on."""
    lower = start if isinstance(start, Column) else c.as_of_literal(start)
    return df.where(days_between(df, ts, lower, None, day) & (F.col(ts) >= lower))


def until(df: DataFrame, ts: str, end: datetime | str | Column, day: str | None = None) -> DataFrame:
    """Rows up to and with ``end``."""
    upper = end if isinstance(end, Column) else c.as_of_literal(end)
    return df.where(days_between(df, ts, None, upper, day) & (F.col(ts) <= upper))
