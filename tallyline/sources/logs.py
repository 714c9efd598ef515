"""Log scans: dated directories of JSON lines, delimited events and raw messages."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.dates import on_day
from tallyline.schemas import log_schema
from tallyline.sinks import files


def date_range(start: str, end: str) -> list[str]:
    """All days from ``start`` to ``end`` (yyyy-MM-dd), both included."""
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    return [(first + timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]


DAY_LAYOUT = "{root}/{day}/{product}"
DATE_LAYOUT = "{root}/{product}/event_date={day}"  # as written by ``split_by_event_date``


def log_dirs(root: str, product: str, start: str, end: str, layout: str = DAY_LAYOUT) -> list[str]:
    """The directory of every day of the range, by default ``root/yyyy-MM-dd/product``."""
    return [layout.format(root=root.rstrip("/"), day=day, product=product) for day in date_range(start, end)]


def read_json_logs(spark: SparkSession, root: str, product: str, start: str, end: str,
                   schema: T.StructType | str, unquoted: bool = False,
                   layout: str = DAY_LAYOUT, missing: str = "error") -> DataFrame:
    """JSON lines of an inclusive date range under an explicit schema.

    ``schema`` is a type or the name of a known log. ``unquoted`` accepts field names without
    quotes. A column an older log lacks is read as null. A day without a directory is an error, or
    a day without rows if ``missing`` is ``skip``; a range without any is always an error.
    """
    if missing not in ("error", "skip"):
        raise ValueError(f"missing is error or skip, not {missing}")
    schema = log_schema(schema) if isinstance(schema, str) and " " not in schema else schema
    paths = log_dirs(root, product, start, end, layout)
    found = [p for p in paths if files.exists(spark, p)]
    if not found or (missing == "error" and len(found) < len(paths)):
        raise FileNotFoundError(f"no log directory {[p for p in paths if p not in found]}")
    return spark.read.schema(schema).option("allowUnquotedFieldNames", unquoted).json(found)


def read_day_logs(spark: SparkSession, root: str, product: str, day: str, schema: T.StructType | str,
                  time: str = "createtime", strict: bool = True, unquoted: bool = True,
                  layout: str = DAY_LAYOUT, missing: str = "error") -> DataFrame:
    """Rows of one day by event time. ``strict`` also reads the next day's directory, where logs
    delivered past midnight lie, and needs both unless ``missing`` is ``skip``."""
    last = (date.fromisoformat(day) + timedelta(days=1 if strict else 0)).isoformat()
    return read_json_logs(spark, root, product, day, last, schema, unquoted, layout, missing).where(on_day(time, day))


def read_delimited_events(spark: SparkSession, path: str | list[str],
                          schema: T.StructType | None = None) -> DataFrame:
    """TAB-separated event log with positional columns."""
    return spark.read.schema(schema or log_schema("delimited_event")).csv(path, sep="\t")


def strip_json_prefix(c: str | Column) -> Column:
    """Drop everything before the first brace of a message."""
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"^[^{]*(?=\{)", "")


# Columns of an API row in output order, and by the last two parts of the method
# name the further columns of its route.
API_COLUMNS = ("device", "udid", "appCode", "appVer", "trackId", "platform", "clnt", "src", "lat", "lng",
               "androidid", "imei", "imsi")
API_ROUTES = {"information.list": ("categoryId",),
              "information.browse": ("informationId",),
              "information.index": ()}


def parse_api_log(df: DataFrame, value: str = "value") -> dict[str, DataFrame]:
    """JSON lines with keys in any letter case, routed by ``method`` to one table per route.

    The line is parsed once into a map with lower-case keys; ``uuid`` stands in for ``udid``.
    """
    parsed = F.from_json(F.col(value), T.MapType(T.StringType(), T.StringType()))
    # keys that differ only in case would clash after lower(); the first of them is kept
    entries = F.transform(F.map_entries(parsed), lambda e: F.struct(F.lower(e["key"]).alias("k"),
                                                                    e["value"].alias("v")))
    rows = df.select(entries.alias("_e"))

    def field(name: str) -> Column:
        return F.try_element_at(F.filter("_e", lambda e: e["k"] == name.lower()), F.lit(1))["v"]

    fields = {c: field(c) for c in API_COLUMNS}
    fields["udid"] = F.coalesce(field("udid"), field("uuid"))
    routes = {}
    for method, extra in API_ROUTES.items():
        columns = [fields[c].alias(c) for c in API_COLUMNS] + [field(c).alias(c) for c in extra]
        routes[method.rsplit(".", 1)[1]] = rows.where(F.substring_index(field("method"), ".", -2) == method).select(*columns)
    return routes
