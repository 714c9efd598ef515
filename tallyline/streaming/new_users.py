"""Realtime new users: a snapshot plus one small delta per micro-batch."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from tallyline.functions.dates import date_int
from tallyline.operators.fold import fold, with_source
from tallyline.operators.merge import NEW_USER, merge_new_users
from tallyline.sinks import files
from tallyline.sinks.tables import publish_snapshot, read_snapshot


def _level(spark: SparkSession, path: str, level: int) -> list[str]:
    """Runs of a level whose write has committed, oldest first; level 0 are the deltas."""
    folder = f"{path}/delta" if level == 0 else f"{path}/level/{level}"
    return [f"{folder}/{n}" for n in files.children(spark, folder) if files.exists(spark, f"{folder}/{n}/_SUCCESS")]


def _finished(spark: SparkSession, path: str) -> list[str]:
    """All runs that a read has to open."""
    levels = sorted(int(n) for n in files.children(spark, f"{path}/level"))
    return [name for level in (0, *levels) for name in _level(spark, path, level)]


def merge_runs(spark: SparkSession, path: str, fan: int) -> int:
    """Merge runs by levels: whenever a level has ``fan`` runs, these become one run of the next,
    with one row per user, sorted by user. Returns how many runs are left.

    A read then opens less than ``fan`` runs a level, of which there are about log(batches) to the
    base ``fan``, and a row is rewritten once a level. The merged run is named after its inputs: if
    a crash leaves both, the next call finds it complete and only removes the inputs; until then a
    read folds them twice, which changes nothing.
    """
    level = 0
    while runs := _level(spark, path, level):
        for at in range(0, len(runs) - fan + 1, fan):
            inputs = runs[at:at + fan]
            target = f"{path}/level/{level + 1}/{max(n.rsplit('/', 1)[1] for n in inputs)}-{hashlib.md5(''.join(inputs).encode()).hexdigest()[:8]}"
            if not files.exists(spark, f"{target}/_SUCCESS"):
                (_merge(None, spark.read.parquet(*inputs)).sortWithinPartitions("aid").write.mode("overwrite").parquet(target))
            for name in inputs:
                files.delete(spark, name)
        level += 1
    return len(_finished(spark, path))


def _merge(current: DataFrame | None, deltas: DataFrame) -> DataFrame:
    rows = with_source(current, deltas.drop("create_date"))
    return fold(rows, ["aid"], NEW_USER).withColumn("create_date", date_int("create_time"))


def read_new_users(spark: SparkSession, path: str) -> DataFrame | None:
    """The current table: the newest snapshot merged with all deltas since."""
    current, names = read_snapshot(spark, f"{path}/snapshot"), _finished(spark, path)
    return _merge(current, spark.read.parquet(*names)) if names else current


def stream_new_users(stream: DataFrame, path: str, checkpoint: str, fan: int | None = None, **trigger):
    """Start the query: every batch is folded to one row per user and written as its own delta.

    A batch costs as much as its own rows, not as the table. A replayed batch overwrites its delta,
    and merging is order-free, so a retry changes nothing. Existing users keep their first values;
    area, ip and update time are replaced when the table is read or compacted. With ``fan`` the
    deltas are merged by levels as they come (:func:`merge_runs`), so that they never pile up.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        # batch numbers start again under a new checkpoint; the id of the query keeps them apart
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        merge_new_users(None, batch).write.mode("overwrite").parquet(f"{path}/delta/batch={query}-{batch_id:012d}")
        if fan is not None:
            merge_runs(batch.sparkSession, path, fan)

    writer = stream.writeStream.foreachBatch(write).outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def compact_new_users(spark: SparkSession, path: str, run_date: str, keep: int = 3) -> DataFrame:
    """Fold all finished deltas into a new snapshot, then drop those deltas.

    A delta that is folded twice after a crash between the two steps changes nothing.
    """
    names = _finished(spark, path)
    if names:
        current = read_snapshot(spark, f"{path}/snapshot")
        publish_snapshot(_merge(current, spark.read.parquet(*names)), f"{path}/snapshot", run_date, keep)
        for name in names:
            files.delete(spark, name)
    return read_snapshot(spark, f"{path}/snapshot")
