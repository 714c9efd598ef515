"""Named queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.catalog.views import Views
from tallyline.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The event log as DuckDB sees it; every oracle may use it as ``log``.
LOG_SQL = """log AS (
  SELECT e.event_id, e.ts, e.user_id, 'u' || e.user_id AS uid, e.event_type, e.value,
         CAST(regexp_extract(e.props, '[0-9]+') AS INTEGER) AS k,
         'v' || CAST(CAST(regexp_extract(e.props, '[0-9]+') AS INTEGER) // 10 AS VARCHAR) AS version,
         c.c_mktsegment AS channel, c.c_nationkey AS nation
  FROM events e JOIN customer c ON e.user_id = c.c_custkey)"""


def ts_text(c: str) -> str:
    """SQL text of a timestamp with microseconds, as :func:`portable` prints it."""
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


def day_int(c: str) -> str:
    return f"CAST(strftime({c}, '%Y%m%d') AS INTEGER)"


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as text, decimals as doubles: the same in every engine."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None, log: bool = True):
    """Register a query; ``sql`` is its oracle, written behind the ``log`` CTE if ``log`` is set."""
    def add(build: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(build(Views(tune(spark), sf_dir)))
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            text = sql.strip()
            plain = text[:6].upper() == "SELECT"
            if log:
                text = f"WITH {LOG_SQL}{' ' if plain else ', '}{text}"
            elif not plain:
                text = f"WITH {text}"
            ORACLES[name] = text
        return build
    return add
