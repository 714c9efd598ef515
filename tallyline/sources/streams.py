"""Stream sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fields of a new-user message.
MESSAGE_FIELDS = ("aid", "channel_code", "area", "ip")


def parse_messages(df: DataFrame, value: str = "value") -> DataFrame:
    """User messages from JSON text, parsed once per row; ``create_time`` becomes a timestamp so
    that a watermark can be set on it."""
    schema = ", ".join(f"{c} string" for c in (*MESSAGE_FIELDS, "create_time"))
    fields = F.from_json(F.col(value).cast("string"), schema)
    return (df.select(fields.alias("m"))
            .select(*[F.col(f"m.{c}").alias(c) for c in MESSAGE_FIELDS],
                    F.col("m.create_time").try_cast("timestamp").alias("create_time")))


def read_kafka_json(spark: SparkSession, brokers: str, topic: str, offsets: str = "earliest",
                    group_id: str | None = None, **options) -> DataFrame:
    """Stream of user messages from a topic; needs the Kafka connector on the class path."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", brokers)
              .option("subscribe", topic).option("startingOffsets", offsets))
    if group_id:
        reader = reader.option("kafka.group.id", group_id)
    return parse_messages(reader.options(**options).load())


def read_file_messages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The same stream from text files with one message per line."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return parse_messages(reader.text(path))
