"""Log lines with a notice of what is wrong: good rows, bad lines and counts of one read.

Lines are parsed once and written once, good rows beside bad lines, so that neither output parses
them again and both always add up to what was read.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.schemas import log_schema
from tallyline.sources.logs import API_ROUTES

_CORRUPT = "_corrupt_line"


class Checked(NamedTuple):
    """``good``: the rows, with the schema's columns. ``bad``: file, line and reason. ``counts``:
    lines, good, bad and blank per file. ``totals``: the same of all files, observed by the write."""

    good: DataFrame
    bad: DataFrame
    counts: DataFrame
    totals: dict[str, int]


def _parsed(schema: T.StructType, fmt: str, options: dict[str, str]) -> Column:
    told = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT} | options
    wide = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields] + [f"{_CORRUPT} string"])
    if fmt not in ("json", "csv"):
        raise ValueError(f"lines are json or csv, not {fmt}")
    return (F.from_json if fmt == "json" else F.from_csv)(F.col("value"), wide, told)


def read_checked(spark: SparkSession, path: str | list[str], schema: T.StructType | str, out: str, fmt: str = "json",
                 required: Sequence[str] = (), **options: str) -> Checked:
    """Read lines of JSON or CSV under a schema (a type, DDL or the name of a known log) into the
    new folder ``out`` and tell good from bad.

    A line is bad if it cannot be parsed, or not into the schema's types, or if one of ``required``
    is null or empty text. Blank lines are neither good nor bad. ``options`` are those of the format,
    such as ``sep``.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema) if " " in schema else log_schema(schema)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    row = lines.withColumn("row", _parsed(schema, fmt, options))
    reason = F.when(F.trim("value") == "", F.lit("blank")).when(F.col(f"row.{_CORRUPT}").isNotNull() | F.col("row").isNull(), F.lit("malformed"))
    for c in required:
        empty = F.col(f"row.{c}").isNull() | (F.col(f"row.{c}").cast("string") == "")
        reason = reason.when(empty, F.lit(f"no {c}"))
    kind = F.when(F.col("reason").isNull(), "good").when(F.col("reason") == "blank", "blank").otherwise("bad")
    told = row.withColumn("reason", reason).withColumn("kind", kind)
    seen = Observation()
    told = told.observe(seen, F.count("*").alias("lines"), *[F.count_if(F.col("kind") == k).alias(k) for k in ("good", "bad", "blank")])
    kept = F.when(F.col("kind") != "good", F.col("value"))
    names = [f.name for f in schema.fields]
    told.select("kind", "file", "reason", kept.alias("line"), F.struct(*[F.col(f"row.{c}").alias(c) for c in names]).alias("row")) \
        .write.partitionBy("kind").parquet(out)
    totals = {k: int(v) for k, v in seen.get.items()}
    written = f"file string, reason string, line string, row {schema.simpleString()}, kind string"
    table = spark.read.schema(written).parquet(out) if totals["lines"] else spark.createDataFrame([], written)
    counts = table.groupBy("file").agg(F.count("*").alias("lines"), *[F.count_if(F.col("kind") == k).alias(k) for k in ("good", "bad", "blank")])
    return Checked(table.where("kind = 'good'").select("row.*"), table.where("kind = 'bad'").select("file", "line", "reason"), counts, totals)


def api_rejects(df: DataFrame, value: str = "value") -> DataFrame:
    """(line, reason) for the API log lines that no route takes: those that are not JSON objects,
    name no method, or name one that is unknown."""
    parsed = F.from_json(F.col(value), T.MapType(T.StringType(), T.StringType()))
    method = F.try_element_at(F.filter(F.map_entries(parsed), lambda e: F.lower(e["key"]) == "method"), F.lit(1))["value"]
    known = F.substring_index(method, ".", -2).isin(*API_ROUTES)
    reason = (F.when(parsed.isNull(), "malformed").when(method.isNull(), "no method").when(~known, "unknown method"))
    return df.select(F.col(value).alias("line"), reason.alias("reason")).where(F.col("reason").isNotNull())
