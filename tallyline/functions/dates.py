"""Date columns: yyyyMMdd integers, gaps and hour parts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_int(ts: str | Column) -> Column:
    """Date or timestamp to an integer such as 20240131.

    Plain arithmetic on the calendar fields: it stays in generated code and needs no formatter.
    """
    d = _col(ts)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_from_int(i: str | Column) -> Column:
    """Integer yyyyMMdd back to a date; null when it is no calendar day."""
    return F.try_to_timestamp(_col(i).cast("string"), F.lit("yyyyMMdd")).cast("date")


def dashed(i: str | Column) -> Column:
    """Integer yyyyMMdd to the text yyyy-MM-dd."""
    return F.date_format(date_from_int(i), "yyyy-MM-dd")


def date_hour_columns(df: DataFrame, times: Mapping[str, str]) -> DataFrame:
    """For each ``prefix -> time column`` add ``prefix_date`` (int) and ``prefix_hour``, drop the time."""
    added = {}
    for prefix, c in times.items():
        added[f"{prefix}_date"] = date_int(c)
        added[f"{prefix}_hour"] = F.hour(c)
    return df.withColumns(added).drop(*times.values())


def day_gap(later: str | Column, earlier: str | Column) -> Column:
    """Whole days from ``earlier`` to ``later``."""
    return F.datediff(_col(later), _col(earlier))


def second_gap(later: str | Column, earlier: str | Column) -> Column:
    """Whole seconds from ``earlier`` to ``later``."""
    return F.timestamp_diff("SECOND", _col(earlier), _col(later))


def on_day(c: str | Column, day: str, days: int = 1) -> Column:
    """Half-open test ``day <= c < day + days`` on literals, so that a scan can use it."""
    start = F.lit(day).cast("timestamp")
    end = F.date_add(F.lit(day).cast("date"), days).cast("timestamp")
    return (_col(c) >= start) & (_col(c) < end)
