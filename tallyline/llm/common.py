"""What the operators of this subpackage share: tables, written intermediate results, row keys."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.session import checkpoint_dir, tune


def text_session(spark: SparkSession) -> SparkSession:
    """The settings of the library, and smaller batches between Spark and Python: a text is a thousand
    times the size of the numbers that the default of 10,000 rows is meant for."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1500")
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which the driver and all executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back, so that later jobs neither repeat its
    work nor lose it with an executor."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: str = "text") -> Column:
    """Tells rows that share an id but not a text apart; rows that share both count as one document."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not use yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def sample_rows(df: DataFrame, n: int, total: int | None = None) -> DataFrame:
    """About ``n`` rows at most, picked by a hash of all their columns, the same ones each time.

    Rows are thinned before they are ordered, so what reaches the driver follows ``n`` and not the
    number of tasks, and equal texts under different ids are picked apart.
    """
    total = df.count() if total is None else total
    mark = F.xxhash64(*df.columns)
    if total > n:
        df = df.where(F.pmod(mark, F.lit(1 << 30)) < F.lit(int(min(1.0, (n + 3 * n ** 0.5) / total) * (1 << 30))))
    return df.orderBy(mark).limit(n)


def dealt(df: DataFrame, *cols: str) -> DataFrame:
    """Repartition by columns into the session's number of shuffle partitions: groups that are small
    in bytes but long to work on would otherwise be gathered into few tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)
