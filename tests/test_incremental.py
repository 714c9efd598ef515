"""What is kept up to date by day: roll-ups by differences, distinct users by bitmaps."""

import random

import pytest
from pyspark.sql import functions as F

from tallyline.operators import bitmaps, rollup
from tallyline.operators.rollup import apply_delta, combination_rules, refresh_day, stored_counts
from tallyline.session import scratch

RULES = combination_rules(["day", "channel"]) + [("l_9", ["area"])]


def rows_of(df):
    return sorted(tuple(map(str, r)) for r in df.select(sorted(df.columns)).collect())


def log(spark, seed, n=200):
    r = random.Random(seed)
    rows = [(r.choice([None, f"u{r.randrange(30)}"]), r.randrange(1, 4), r.choice(["a", "b", None]), r.choice(["x", "y"])) for _ in range(n)]
    return spark.createDataFrame(rows, "aid string, day int, channel string, area string")


def whole(df):
    return rollup.rollup_new(df, RULES)


def test_days_in_any_order_give_the_whole(spark):
    """Also with groups that hold nothing but rows without a user, and with a null in a column."""
    df, stored = log(spark, 1), None
    for day in (3, 1, 2, 9):
        stored = refresh_day(stored, df, RULES, "aid", "day", day)
    assert rows_of(stored_counts(stored)) == rows_of(whole(df))


def test_a_redone_day_replaces_what_it_had(spark):
    old, new = log(spark, 2), log(spark, 3)
    stored = None
    for day in range(1, 4):
        stored = refresh_day(stored, old, RULES, "aid", "day", day)
    redone = refresh_day(stored, new, RULES, "aid", "day", 2)
    assert rows_of(stored_counts(redone)) == rows_of(whole(old.where("day <> 2").unionByName(new.where("day = 2"))))
    emptied = refresh_day(redone, new.limit(0), RULES, "aid", "day", 2)
    assert rows_of(stored_counts(emptied)) == rows_of(whole(old.where("day <> 2")))


def test_an_unchanged_day_has_no_delta(spark):
    df = log(spark, 4)
    stored = refresh_day(None, df, RULES, "aid", "day", 2)
    again = rollup.rollup_delta(rollup.finest_counts(df.where("day = 2"), RULES, "aid"), stored.where("rule = 'finest'"), RULES)
    assert again.count() == 0
    assert rows_of(apply_delta(stored, again, co_located=True)) == rows_of(stored) == rows_of(apply_delta(stored, again))


def test_numbers_stay_and_go_on(spark):
    path = scratch(spark, "numbers")
    make = lambda ids: spark.createDataFrame([(i, i[-1:]) for i in ids if i] + [(None, "x")], "uuid string, near string")
    first = bitmaps.extend_dictionary(spark, path, make([f"u{k}" for k in range(50)] * 3), "uuid", ["near"])
    was = {r.uuid: r.number for r in first.collect()}
    assert sorted(was.values()) == list(range(1, 51))
    second = bitmaps.extend_dictionary(spark, path, make([f"u{k}" for k in range(30, 90)]), "uuid")
    now = {r.uuid: r.number for r in second.collect()}
    assert sorted(now.values()) == list(range(1, 91)) and all(now[u] == n for u, n in was.items())
    again = bitmaps.extend_dictionary(spark, path, make(["u3"]), "uuid")
    assert {r.uuid: r.number for r in again.collect()} == now
    assert bitmaps.read_dictionary(spark, scratch(spark, "none")) is None


def test_users_in_many_slices(spark):
    """More users than a bitmap holds, in windows that overlap."""
    rows = spark.range(100_000).select(F.col("id").cast("string").alias("uuid"), (F.col("id") % 3).alias("k"), (F.col("id") % 7).alias("day"))
    rows = rows.unionByName(rows.withColumn("day", F.col("day") + 1)).unionByName(rows)
    numbers = bitmaps.extend_dictionary(spark, scratch(spark, "numbers"), rows, "uuid")
    days = bitmaps.user_bitmaps(rows, numbers, ["k", "day"], "uuid")
    assert days.agg(F.max("slice")).first()[0] == 4
    flags = {"all": F.lit(True), "two": F.col("day") < 2, "none": F.col("day") > 90}
    got = {r.k: (r["all"], r.two, r.none) for r in bitmaps.distinct_from_bitmaps(days, ["k"], flags).collect()}
    want = {k: (sum(i % 3 == k for i in range(100_000)), sum(i % 3 == k and i % 7 < 2 for i in range(100_000)), 0) for k in range(3)}
    assert got == want
    assert bitmaps.distinct_from_bitmaps(days, [], flags).first().two == sum(i % 7 < 2 for i in range(100_000))
    with pytest.raises(Exception, match="not in the dictionary"):
        bitmaps.user_bitmaps(rows.withColumn("uuid", F.concat("uuid", F.lit("x"))), numbers, ["k"], "uuid").count()
