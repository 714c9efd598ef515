"""What the physical plans may and may not contain."""

import os

import pytest
from pyspark.sql import functions as F

from tallyline import catalog
from tallyline.catalog.views import Views
from tallyline.operators.skew import lookup, top_per_key

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark):
    text = plan(Views(spark, SF).log.select("uid", "event_type"))
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in text


def test_time_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    Views(spark, SF).log.select("ts", "uid").write.parquet(path)
    from tallyline.sources.tables import read_range
    text = plan(read_range(spark, path, "ts", "2024-01-02", "2024-01-03"))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text


@pytest.mark.parametrize("kind", ["date", "string"])
def test_click_window_reaches_the_scan(spark, tmp_path, kind):
    from tallyline.operators.recommend import item_users, user_item_score
    path = str(tmp_path / "clicks")
    spark.sql(f"SELECT 'u' AS device_id, id AS info_id, 'share' AS event_name, CAST(date_add(DATE '2024-01-01', CAST(id AS INT)) AS {kind}) AS click_date, "
              "1 AS click_count FROM range(40)").write.parquet(path)
    clicks = spark.read.parquet(path)
    scores = user_item_score(clicks, item_users(clicks), {"share": 1.0}, "2024-01-21", days=10)
    assert scores.count() == 10
    assert "GreaterThanOrEqual(click_date,2024-01-11)" in plan(scores) and "LessThan(click_date,2024-01-21)" in plan(scores)


def test_signal_window_reaches_the_scan(spark, tmp_path):
    from tallyline.operators.scoring import signal_counts
    path = str(tmp_path / "links")
    spark.sql("SELECT 'u' AS uuid, 'c' AS customer_id, CAST(id AS STRING) AS link_type, CAST(20240100 + id AS INT) AS create_date FROM range(1, 31)").write.parquet(path)
    counts = signal_counts({"link": spark.read.parquet(path)}, "2024-01-20", days=5)
    assert [tuple(r) for r in counts.collect()] == [("u", 5)]
    assert "GreaterThanOrEqual(create_date,20240115)" in plan(counts) and "LessThan(create_date,20240120)" in plan(counts)


@pytest.mark.parametrize("name, most", [("score_devices", 4), ("device_signals", 3)])
def test_signals_are_read_once(spark, name, most):
    df = catalog.queries()[name](spark, SF)
    df.collect()
    text = plan(df)
    assert text[:text.index("Initial Plan")].count("Scan parquet") <= most


def test_day_tables_are_stored_before_they_are_counted(spark):
    """The tasks that count signals read per-day tables: they neither join lines nor make the tables."""
    text = plan(catalog.queries()["signal_counts"](spark, SF))
    below = text[text.index("Union"):]
    assert "Join" not in text and "Exchange" not in below and below.count("FileScan") == 8


def test_partition_filter_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "CAST(20240100 + id AS INT) AS stat_date").write.partitionBy("stat_date").parquet(path)
    from tallyline.sources.tables import read_partition
    df = read_partition(spark, path, 20240103, 20240104)
    assert df.count() == 2
    assert "PartitionFilters: [isnotnull(stat_date" in plan(df)


def test_ranked_groups_are_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id", "id % 3 AS g")
    assert "WindowGroupLimit" in plan(top_per_key(df, ["g"], [F.desc("id")], 5))


def test_rollup_counts_before_it_expands(spark):
    text = plan(catalog.queries()["rollup_active"](spark, SF))
    below = text[text.index("Expand"):]
    assert "HashAggregate" in below  # the finest groups are counted under the expand


def test_hot_key_partition_is_split(spark):
    """Half of all rows share one key: the adaptive join splits that partition."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB", "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, val in conf.items():
        spark.conf.set(k, val)
    try:
        big = (spark.range(0, 40000, 1, 16).selectExpr("CASE WHEN id % 2 = 0 THEN 7 WHEN id % 7 = 1 THEN NULL ELSE id END AS k",
                                                       "uuid() AS v", "id"))
        small = spark.range(0, 40000).selectExpr("id AS k", "id * 2 AS w")
        df = lookup(big, small, "k")
        assert df.where("k IS NOT NULL").select(F.sum(F.when(F.col("w") == F.col("k") * 2, 1).otherwise(0))).first()[0] \
            == df.where("k IS NOT NULL").count()
        df = lookup(big, small, "k")
        assert df.count() == 40000
        df = lookup(big, small, "k")
        df.collect()
        assert "skew=true" in plan(df)
    finally:
        for k, val in old.items():
            spark.conf.unset(k) if val is None else spark.conf.set(k, val)
