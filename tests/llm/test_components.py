"""Components of links, and the stages that let a star's centre be split."""

import random

from pyspark.sql import functions as F

from tallyline.llm.components import components
from tallyline.operators.skew import lookup


def brute(links):
    root = {x: x for link in links for x in link}
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                moved = True
    return sorted((x, r) for x, r in root.items() if x != r)


def test_random_links_chains_and_stars(spark):
    r = random.Random(2)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(150)] + [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 700)]
    df = spark.createDataFrame(links + [(None, 3), (7, 7)], "a long, b long")
    assert sorted(tuple(x) for x in components(df).collect()) == brute([x for x in links if x[0] != x[1]])


def test_a_hot_centre_is_split(spark):
    """The join of links with an aggregate on the same node, as each round has it."""
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
             "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        links = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") >= 0, F.col("id")).alias("u"), (F.col("id") + 1).alias("v"))
        joined = lookup(links, links.groupBy("u").agg(F.min("v").alias("m")), "u").where("v != m")
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
