"""Report dates taken from the data: the last event day and the last season.

Each is a one-row ``max()`` over one column, so the cumulative queries always
run up to the newest rows of their tables.  The SQL forms say the same.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

LAST_DAY_SQL = "(SELECT CAST(MAX(ts) AS DATE) FROM events)"
LAST_SEASON_SQL = "(SELECT CAST(year(MAX(o_orderdate)) AS BIGINT) FROM orders)"


def last_day(t) -> str:
    """The last event day as text (an empty table: the epoch)."""
    found = t.events.agg(F.date_format(F.max("ts"), "yyyy-MM-dd")).first()[0]
    return found or "1970-01-01"


def day_before(day: str) -> str:
    return (dt.date.fromisoformat(day) - dt.timedelta(days=1)).isoformat()


def last_season(t) -> int:
    """The last order year (an empty table: 0)."""
    return t.orders.agg(F.year(F.max("o_orderdate"))).first()[0] or 0
