"""Realtime counts per channel in sliding windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.sinks import files

# State on disk beside the executors, of which a checkpoint stores the changes of a batch only.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def stream_channel_counts(stream: DataFrame, delay: str = "10 minutes", size: str = "10 minutes",
                          slide: str = "5 minutes") -> DataFrame:
    """Messages per channel and window. On a batch DataFrame the watermark has no effect."""
    return (stream.withWatermark("create_time", delay)
            .groupBy(F.window("create_time", size, slide).alias("window"), "channel_code").count())


def start_channel_counts(stream: DataFrame, checkpoint: str, mode: str = "complete", sink: str = "console",
                         name: str | None = None, **trigger):
    """Start the counts. ``complete`` emits every window each time and keeps all state; ``append``
    emits a window once the watermark has passed it, drops later rows and lets its state go."""
    writer = stream_channel_counts(stream).writeStream.format(sink).outputMode(mode)
    if name:
        writer = writer.queryName(name)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def start_stored_counts(stream: DataFrame, path: str, checkpoint: str, **trigger):
    """Start the counts in ``update`` mode into a table that :func:`read_stored_counts` reads.

    A batch writes the windows that it changed, as a folder of its own that a replay overwrites; the
    state of windows that the watermark has passed is dropped. The state is kept by RocksDB and not
    on the heap, and a query that is stopped goes on from its checkpoint.
    """
    spark = stream.sparkSession
    for name, value in STATE_CONF.items():
        spark.conf.set(name, value)

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        (batch.select(F.lit(batch_id).cast("long").alias("batch"), "window.start", "window.end", "channel_code", "count")
         .write.mode("overwrite").parquet(f"{path}/batch={query}-{batch_id:012d}"))

    writer = stream_channel_counts(stream).writeStream.foreachBatch(write).outputMode("update")
    try:
        return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    finally:  # the started query keeps them; other queries of the session have their own checkpoints
        for name in STATE_CONF:
            spark.conf.unset(name)


def read_stored_counts(spark: SparkSession, path: str) -> DataFrame:
    """The latest count of every channel and window."""
    names = [n for n in files.children(spark, path) if files.exists(spark, f"{path}/{n}/_SUCCESS")]
    rows = spark.read.parquet(*[f"{path}/{n}" for n in names])
    return (rows.groupBy("channel_code", F.col("start").alias("window_start"), F.col("end").alias("window_end"))
            .agg(F.max_by("count", "batch").alias("count")))
