"""Sinks and table maintenance on Parquet directories."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.skew import top_per_key
from tallyline.sinks import files


TIMESTAMP_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _write_partitions(df: DataFrame, path: str, col: str, rebalance: bool = True) -> None:
    # AQE's rebalance evens out files: small partitions are merged, a hot one is split
    rows = df.hint("rebalance", F.col(col)) if rebalance else df
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(col).parquet(path))


def replace_range(df: DataFrame, path: str, col: str, start: int | str, end: int | str) -> None:
    """Replace the partitions of ``col`` from ``start`` to ``end`` by the rows of ``df``.

    Partitions that ``df`` fills are swapped when the write commits; those of the range that it
    leaves empty are removed afterwards. Running it again gives the same table.
    """
    spark = df.sparkSession

    def listing() -> dict[str, list[str]]:
        names = [n for n in files.children(spark, path) if n.startswith(f"{col}=")]
        inside = [n for n in names if str(start) <= n.split("=", 1)[1] <= str(end)]
        return {n: files.children(spark, f"{path}/{n}") for n in inside}

    before = listing()
    _write_partitions(df.where((F.col(col) >= start) & (F.col(col) <= end)), path, col)
    after = listing()
    for name, parts in before.items():
        if after.get(name) == parts:  # not rewritten: the new rows hold nothing for it
            files.delete(spark, f"{path}/{name}")


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Complete snapshot versions, oldest first."""
    names = [n for n in files.children(spark, path) if n.startswith("version=")]
    return [n.split("=", 1)[1] for n in names if files.exists(spark, f"{path}/{n}/_SUCCESS")]


def publish_snapshot(df: DataFrame, path: str, run_date: str, keep: int = 3) -> str:
    """Write ``df`` as a version of ``run_date`` (yyyyMMdd) and drop versions ``keep`` days older.

    A version counts once its write has committed, so readers see the old or the new table whole.
    ``df`` may read any stored version: publishing again on one day adds a numbered version beside
    the first instead of overwriting files that are being read.
    """
    spark = df.sparkSession
    again = sum(v[:8] == run_date for v in _versions(spark, path))
    target = f"{path}/version={run_date}" + (f"-{again:04d}" if again else "")
    df.write.mode("overwrite").parquet(target)
    oldest = datetime.strptime(run_date, "%Y%m%d") - timedelta(days=keep)
    for version in _versions(spark, path):
        if version[:8] <= oldest.strftime("%Y%m%d"):
            files.delete(spark, f"{path}/version={version}")
    return target


def read_snapshot(spark: SparkSession, path: str, before: str | None = None) -> DataFrame | None:
    """The newest version, or the newest one older than ``before``; ``None`` when there is none."""
    found = [v for v in _versions(spark, path) if before is None or v < before]
    return spark.read.parquet(f"{path}/version={found[-1]}") if found else None


def restore_snapshot(spark: SparkSession, path: str, run_date: str) -> DataFrame | None:
    """State to recompute ``run_date`` from: the newest version before it. Versions of that day and
    later ones are dropped, so that the redone run is the newest again."""
    for version in _versions(spark, path):
        if version >= run_date:
            files.delete(spark, f"{path}/version={version}")
    return read_snapshot(spark, path, before=run_date)


def overwrite_table(df: DataFrame, path: str) -> None:
    """Replace a whole table; ``df`` must not read ``path``."""
    df.write.mode("overwrite").parquet(path)


def replace_one(df: DataFrame, path: str, col: str) -> int:
    """Write the partitions that ``df`` fills, and return how many rows it had."""
    seen = Observation()
    _write_partitions(df.observe(seen, F.count("*").alias("n")), path, col)
    return int(seen.get["n"])


def replace_partition(df: DataFrame, path: str, stat_date: int, keep_days: int | None = None,
                      col: str = "stat_date") -> None:
    """Replace the partition of ``stat_date`` (yyyyMMdd) and drop those ``keep_days`` or more older.

    The day is swapped when the write commits, so that a failed run leaves the old one; a day without
    rows is removed after it.
    """
    spark = df.sparkSession
    if not replace_one(df.withColumn(col, F.lit(stat_date)), path, col):
        files.delete(spark, f"{path}/{col}={stat_date}")
    if keep_days is None:
        return
    oldest = datetime.strptime(str(stat_date), "%Y%m%d") - timedelta(days=keep_days)
    for name in files.children(spark, path):
        if name.startswith(f"{col}=") and name.split("=", 1)[1] <= oldest.strftime("%Y%m%d"):
            files.delete(spark, f"{path}/{name}")


def latest_per_key(new: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key: the first in ``order``, by default the greatest row by all its values."""
    by = order or [F.desc(c) for c in new.columns if c not in keys]
    return top_per_key(new, keys, by, 1).drop("_rank") if by else new.dropDuplicates(list(keys))


def upsert(current: DataFrame, new: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
           order: Sequence[Column] | None = None) -> DataFrame:
    """Insert new keys; for known ones take only ``update_cols`` from ``new``."""
    new = latest_per_key(new, keys, order)
    a = current.withColumn("_old", F.lit(True)).alias("a")
    b = new.withColumn("_new", F.lit(True)).alias("b")
    joined = a.join(b, list(keys), "full_outer")

    def pick(c: str) -> Column:
        if c not in new.columns:
            return F.col(f"a.{c}")
        if c in update_cols:
            return F.when(F.col("b._new"), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}"))
        return F.when(F.col("a._old"), F.col(f"a.{c}")).otherwise(F.col(f"b.{c}"))

    return joined.select(*[F.col(c) if c in keys else pick(c).alias(c) for c in current.columns])


def insert_ignore(current: DataFrame, new: DataFrame, keys: Sequence[str],
                  order: Sequence[Column] | None = None) -> DataFrame:
    """Add rows of unseen keys; a known key keeps its stored row."""
    fresh = latest_per_key(new, keys, order).join(current.select(*keys), list(keys), "left_anti")
    return current.unionByName(fresh.select(*current.columns))


def replace_into(current: DataFrame, new: DataFrame, keys: Sequence[str],
                 order: Sequence[Column] | None = None) -> DataFrame:
    """Add all new rows; a known key loses its stored row."""
    new = latest_per_key(new, keys, order)
    kept = current.join(new.select(*keys), list(keys), "left_anti")
    return kept.select(*current.columns).unionByName(new.select(*current.columns))


def channel_filter(include: Iterable[str] = (), exclude: Iterable[str] = (), col: str = "chacode") -> Column:
    """Rows of the listed channels; an include list wins over an exclude list."""
    include, exclude = list(include), list(exclude)
    if include:
        return F.col(col).isin(include)
    return ~F.col(col).isin(exclude) if exclude else F.lit(True)


def publish_channels(df: DataFrame, targets: Mapping[str, Mapping[str, Iterable[str]]],
                     col: str = "chacode", date_col: str = "cdate") -> None:
    """Write one result to many targets (path -> include/exclude lists), one partition per day."""
    result = df.persist()
    try:
        for path, lists in targets.items():
            _write_partitions(result.where(channel_filter(col=col, **lists)), path, date_col)
    finally:
        result.unpersist()


def split_by_event_date(df: DataFrame, path: str, time: str = "createtime", fmt: str = "json") -> None:
    """Append log rows to the directory of their own event date. A second run appends again; for
    files that may be delivered twice there is ``sinks.ledger``. Rows without a time go to the
    directory of a null date.

    Rows are balanced over files by date and size, so one hot day is written by many tasks and a
    late straggler day by one.
    """
    dated = df.withColumn("event_date", F.date_format(time, "yyyy-MM-dd"))
    # whole microseconds: text formats would cut a timestamp to milliseconds by default
    (dated.hint("rebalance", F.col("event_date")).write.mode("append").partitionBy("event_date")
     .option("timestampFormat", TIMESTAMP_TEXT).format(fmt).save(path))


def export_table(src: DataFrame, dst: str, where: Column | str | None = None, fmt: str = "parquet") -> None:
    """Append the rows that pass ``where`` to a target."""
    rows = src if where is None else src.where(where)
    rows.write.mode("append").format(fmt).save(dst)


def diff_tables(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows that differ between two builds of a table, with the side and how many copies more.

    Both builds are stacked with opposite signs and counted once.
    """
    stacked = (a.select(*cols, F.lit(1).alias("_sign"))
               .unionByName(b.select(*cols, F.lit(-1).alias("_sign"))))
    diff = stacked.groupBy(*cols).agg(F.sum("_sign").alias("_d")).where(F.col("_d") != 0)
    return diff.select(F.when(F.col("_d") > 0, "left").otherwise("right").alias("side"), *cols,
                       F.abs("_d").alias("copies"))


def recommendations_to_messages(df: DataFrame, order: str = "place") -> DataFrame:
    """One message per user: ``device info:time,info:time`` in the order of a column, such as the
    place or, where places repeat per category, a falling stamp.

    The list of a user is the result of a top-n recommendation and so bounded by n.
    """
    item = F.struct(F.col(order) if order == "place" else -F.col(order), F.concat_ws(":", F.col("info_id").cast("string"),
                                         F.unix_millis("publish_time").cast("string")).alias("m"))
    packed = df.groupBy("device_id").agg(F.array_sort(F.collect_list(item)).alias("_m"))
    body = F.array_join(F.transform("_m", lambda m: m["m"]), ",")
    return packed.select(F.col("device_id").cast("string").alias("key"),
                         F.concat_ws(" ", F.col("device_id").cast("string"), body).alias("value"))


def write_kafka(messages: DataFrame, brokers: str, topic: str) -> None:
    """Send messages (key, value); needs the Kafka connector on the class path."""
    (messages.write.format("kafka").option("kafka.bootstrap.servers", brokers).option("topic", topic).save())


def write_rollups(rolled: DataFrame, path: str) -> None:
    """All roll-up tables in one pass, one directory per rule."""
    rolled.write.mode("overwrite").partitionBy("rule").parquet(path)
