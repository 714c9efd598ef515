"""Table scans: stored partitions and parallel JDBC reads."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def range_predicates(col: str, start: str, end: str, step: int, unit: str = "days") -> list[str]:
    """Half-open predicates that cover [start, end) in steps of N days or hours."""
    at, last = datetime.fromisoformat(start), datetime.fromisoformat(end)
    width = timedelta(**{unit: step})
    out = []
    while at < last:
        stop = min(at + width, last)
        out.append(f"{col} >= '{at:%Y-%m-%d %H:%M:%S}' AND {col} < '{stop:%Y-%m-%d %H:%M:%S}'")
        at = stop
    return out


def read_jdbc_ranges(spark: SparkSession, url: str, table: str, col: str, start: str, end: str, step: int,
                     unit: str = "days", properties: Mapping[str, str] | None = None) -> DataFrame:
    """Read a database table with one task per time range."""
    predicates = range_predicates(col, start, end, step, unit)
    return spark.read.jdbc(url, table, predicates=predicates, properties=dict(properties or {}))


def read_range(spark: SparkSession, path: str, col: str, start: str, end: str) -> DataFrame:
    """The same range on files: one filter that the Parquet scan evaluates."""
    t = F.col(col)
    return spark.read.parquet(path).where((t >= F.lit(start).cast("timestamp"))
                                          & (t < F.lit(end).cast("timestamp")))


def read_partition(spark: SparkSession, path: str, start: int | str, end: int | str | None = None,
                   col: str = "stat_date") -> DataFrame:
    """One partition of a partitioned table, or an inclusive range of them."""
    c = F.col(col)
    df = spark.read.parquet(path)
    return df.where(c == start) if end is None else df.where((c >= start) & (c <= end))
