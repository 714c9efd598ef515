"""State tables by buckets: the same tables as by a plain merge, and no exchange above the stored one."""

import random

import pytest
from pyspark.sql import functions as F

from tallyline.operators import merge
from tallyline.operators.fold import Policy, fold, fold_into, with_source
from tallyline.session import scratch
from tallyline.sinks import bucketed, files, tables


def above_state(df):
    """Names of the plan's nodes on the way from the bucketed scans up."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan

    def walk(node, way):
        way = [*way, node.nodeName()]
        if not node.children().size():
            return [way] if "state_" in node.toString() else []
        return [w for i in range(node.children().size()) for w in walk(node.children().apply(i), way)]
    return walk(plan, [])


def moved(df):
    ways = above_state(df)
    assert ways, "no scan of the state in the plan"
    return [n for way in ways for n in way if "Exchange" in n]


@pytest.fixture
def plain_joins(spark):
    """Tables as if they were too large to be sent whole."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.fixture
def visits(spark):
    r = random.Random(4)
    rows = [(f"u{r.randrange(40)}", f"c{r.randrange(5)}", f"a{r.randrange(9)}", f"10.{k}", f"2024-01-{r.randrange(1, 29):02d} {r.randrange(24):02d}:00:00")
            for k in range(600)]
    return spark.createDataFrame(rows, "aid string, channel_code string, area string, ip string, create_time string")


def rows_of(df):
    return sorted(tuple(map(str, r)) for r in df.select(sorted(df.columns)).collect())


def test_daily_merges_leave_the_state_where_it_is(spark, visits):
    path = scratch(spark, "state")
    for low, high in (("00", "10"), ("08", "20"), ("20", "99"), ("05", "06")):
        log = visits.where((F.col("create_time") >= f"2024-01-{low}") & (F.col("create_time") < f"2024-01-{high}"))
        table = bucketed.update_bucketed(spark, path, log, merge.merge_new_users, ["aid"], 4)
    assert rows_of(table) == rows_of(merge.merge_new_users(None, visits))
    assert moved(merge.merge_new_users(table, visits, co_located=True)) == []
    assert moved(merge.merge_new_users(table, visits)) != []
    kept = [n for n in files.children(spark, path)]
    assert kept == ["state=00000003", "state=00000004"]
    parts = [n for n in files.children(spark, f"{path}/{kept[-1]}/rows") if n.startswith("part-")]
    assert len(parts) == 4  # one file a bucket, though it was never shuffled again


def test_key_merges_leave_the_state_where_it_is(spark, plain_joins):
    path = scratch(spark, "keyed")
    old = spark.createDataFrame([(k, f"a{k}", "x") for k in range(50)], "id long, a string, b string")
    new = spark.createDataFrame([(k, f"n{k}", "y") for k in range(40, 70)], "id long, a string, b string")
    bucketed.write_bucketed(old, path, ["id"], 4)
    table = bucketed.read_bucketed(spark, path)
    for step in (lambda: tables.upsert(table, new, ["id"], ["a"]), lambda: tables.insert_ignore(table, new, ["id"]),
                 lambda: tables.replace_into(table, new, ["id"])):
        assert moved(step()) == []
    assert rows_of(tables.upsert(table, new, ["id"], ["a"])) == rows_of(tables.upsert(old, new, ["id"], ["a"]))


def test_a_failed_run_changes_nothing(spark):
    path = scratch(spark, "failed")
    df = spark.range(20).withColumn("v", F.col("id") * 2)
    bucketed.write_bucketed(df, path, ["id"], 2)
    with pytest.raises(Exception):
        bucketed.write_bucketed(df.withColumn("v", F.raise_error(F.lit("stop")).cast("long")), path, ["id"], 2)
    assert bucketed.read_bucketed(spark, path).count() == 20
    bucketed.write_bucketed(df.limit(5), path, ["id"], 2)
    assert bucketed.read_bucketed(spark, path).count() == 5
    assert bucketed.read_bucketed(spark, scratch(spark, "none")) is None


def test_fold_into_equals_the_fold_of_both(rows):
    """Every kind of policy, with unusable values, ties in time and keys that only one side has."""
    r = random.Random(8)
    data = [(r.choice("abcdefg"), f"f{k}", r.choice(["", "null", "x", "y", None]), r.choice([0, 3, -1, 7]), f"2024-01-0{r.randrange(1, 6)}", f"2024-01-0{r.randrange(4, 9)}")
            for k in range(60)]
    schema = "k string, f string, s string, n int, create_time timestamp, update_time timestamp"
    policy = Policy(first=("f", "create_time"), last=("update_time",), first_known=("s",), last_known=("n",))
    log = rows(schema, data[:40])
    stored = fold(rows(schema, data[40:]), ["k"], policy)
    assert rows_of(fold_into(stored, log, ["k"], policy)) == rows_of(fold(with_source(stored, log), ["k"], policy))
