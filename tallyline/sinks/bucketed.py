"""State tables stored by buckets of their key.

A table is a folder of versions. Every version is written by ``bucketBy`` and ``sortBy`` and counts
once its description, written last, is there: a failed run changes nothing, and a version can be
read while the next is made from it. The description holds the bucketing, so that any session can
read the folder as a bucketed table and join it on its key without an exchange.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tallyline.sinks import files

DESCRIPTION = "description.json"
_BY_NEED = "spark.sql.sources.bucketing.autoBucketedScan.enabled"


def _versions(spark: SparkSession, path: str) -> list[str]:
    names = [n for n in files.children(spark, path) if n.startswith("state=")]
    return [n for n in names if files.exists(spark, f"{path}/{n}/{DESCRIPTION}")]


def _name(folder: str) -> str:
    return f"state_{hashlib.md5(folder.encode()).hexdigest()}"


def _quoted(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest version as a bucketed table; ``None`` when there is none."""
    found = _versions(spark, path)
    if not found:
        return None
    folder = f"{path}/{found[-1]}"
    told = json.loads(files.read_text(spark, f"{folder}/{DESCRIPTION}"))
    name = _name(folder)
    if not spark.catalog.tableExists(name):
        keys = _quoted(told["keys"])
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({told['columns']}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                  f"INTO {told['buckets']} BUCKETS LOCATION '{folder}/rows'")
    return spark.table(name)


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int, placed: bool = False, keep: int = 2) -> None:
    """Write ``df`` as the next version and drop all but the last ``keep``.

    ``placed`` says that the rows already lie by buckets, as they do when they were merged with the
    version before; otherwise they are shuffled once, so that every bucket becomes one file.
    """
    spark, keys = df.sparkSession, list(keys)
    numbers = [int(n.split("=")[1]) for n in files.children(spark, path) if n.startswith("state=")]
    folder = f"{path}/state={max(numbers, default=0) + 1:08d}"
    rows = df if placed else df.repartition(buckets, *keys)
    writing = f"{_name(folder)}_writing"
    before = spark.conf.get(_BY_NEED)
    spark.conf.set(_BY_NEED, "false")  # one task reads a bucket and writes it, also where no join asks for it
    try:
        rows.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{folder}/rows").saveAsTable(writing)
    finally:
        spark.conf.set(_BY_NEED, before)
    spark.sql(f"DROP TABLE {writing}")  # the files stay
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    files.write_text(spark, f"{folder}/{DESCRIPTION}", json.dumps({"keys": keys, "buckets": buckets, "columns": columns}))
    for old in _versions(spark, path)[:-keep]:
        spark.sql(f"DROP TABLE IF EXISTS {_name(f'{path}/{old}')}")
        files.delete(spark, f"{path}/{old}")


def update_bucketed(spark: SparkSession, path: str, new: DataFrame, step: Callable[..., DataFrame], keys: Sequence[str], buckets: int) -> DataFrame:
    """One run of a state table: ``step(stored, new, co_located=True)`` becomes the next version,
    ``step(None, new)`` the first. Returns the table."""
    stored = read_bucketed(spark, path)
    if stored is None:
        write_bucketed(step(None, new), path, keys, buckets)
    else:
        write_bucketed(step(stored, new, co_located=True), path, keys, buckets, placed=True)
    return read_bucketed(spark, path)
