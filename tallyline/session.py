"""Session settings the operators are planned for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings: safe to apply to a session somebody else created.
RUNTIME_CONF = {
    # Event times are instants in UTC; day boundaries are taken in this zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even if a later operator then needs a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "tallyline", cores: str = "*", partitions: int = 8,
                  memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(partitions))
               .config("spark.default.parallelism", str(partitions))
               .config("spark.driver.memory", memory)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for streaming checkpoints and written intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a session of this one machine, as in
    tests, may leave it unset and then gets a temporary folder; executors elsewhere could not see
    such a folder, so any other session without the setting is an error.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) \
        or spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
    return tempfile.mkdtemp(prefix="run-")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """A table that several jobs read: written to the shared folder, so that none repeats its work."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
