"""Re-homing of log files by event date, each file exactly once.

A run looks for source files that no earlier run has taken, writes their rows as a folder of its
own, and then one ledger record with the names. The record is what makes the rows count: a run that
fails before it leaves nothing behind but a folder that the next run overwrites, and a file that is
delivered again under its name is known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.sinks import files

LEDGER = "file string, length long"


def _runs(spark: SparkSession, path: str) -> list[str]:
    return [n for n in files.children(spark, f"{path}/ledger") if files.exists(spark, f"{path}/ledger/{n}/_SUCCESS")]


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """(file, length) of all source files taken so far."""
    runs = _runs(spark, path)
    return spark.read.schema(LEDGER).parquet(*[f"{path}/ledger/{n}" for n in runs]) if runs else spark.createDataFrame([], LEDGER)


def rehome_files(spark: SparkSession, source: str, path: str, schema: T.StructType | str, time: str = "createtime") -> int:
    """Move the rows of the JSON files at ``source`` (a folder or pattern) that are new to folders
    of their event date below ``path``; returns how many files were new.

    Running it again, after success or failure, takes no file twice. Rows without a usable time go
    to the folder of a null date and are kept. A taken file that has another length by now was
    changed after it was delivered, which is an error.
    """
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
             .select(F.col("path").alias("file"), "length"))  # the listing alone: contents are not read
    taken = read_ledger(spark, path)
    changed = found.join(taken.withColumnRenamed("length", "was"), "file").where("length <> was").select("file").take(3)
    if changed:
        raise ValueError(f"files were changed after they had been taken: {[r.file for r in changed]}")
    fresh = found.join(taken, "file", "left_anti").orderBy("file").collect()  # names of files, as every scan lists them
    if not fresh:
        return 0
    run = f"run={max([int(n.split('=')[1]) for n in _runs(spark, path)], default=0) + 1:08d}"
    rows = spark.read.schema(schema).json([r.file for r in fresh])
    (rows.withColumn("event_date", F.date_format(time, "yyyy-MM-dd")).hint("rebalance", F.col("event_date"))
     .write.mode("overwrite").partitionBy("event_date").parquet(f"{path}/rows/{run}"))
    spark.createDataFrame([(r.file, r.length) for r in fresh], LEDGER).coalesce(1).write.mode("overwrite").parquet(f"{path}/ledger/{run}")
    return len(fresh)


def read_rehomed(spark: SparkSession, path: str, schema: T.StructType | str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The rows of all runs that count, with ``event_date``; ``first`` and ``last`` (yyyy-MM-dd)
    prune folders."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = T.StructType([*schema.fields, T.StructField("event_date", T.StringType())])
    runs = _runs(spark, path)
    if not runs:
        return spark.createDataFrame([], whole)
    rows = spark.read.schema(whole).option("basePath", f"{path}/rows").parquet(*[f"{path}/rows/{n}" for n in runs]).drop("run")
    if first is not None:
        rows = rows.where(F.col("event_date") >= first)
    return rows if last is None else rows.where(F.col("event_date") <= last)
