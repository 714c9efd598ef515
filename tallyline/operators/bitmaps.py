"""Distinct users from daily bitmaps, exactly.

Users get whole numbers from a dictionary that only ever grows. A day's users of a group are then
bitmaps, one per 32,768 numbers, which are made once, when the day comes in. The distinct users of
any number of days are their union: a window costs the bitmaps of its days and no visit is read
again. Users that come together are numbered together, so that the bitmaps of a cohort are few and
full.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.operators.skew import lookup
from tallyline.sinks import files

PARTS = 256  # shares of new users that are numbered side by side


def number_users(users: DataFrame, known: DataFrame | None, user: str, near: Sequence[str] = ()) -> DataFrame:
    """(user, number) for users that ``known`` does not have yet, numbered on from its last.

    Users with equal ``near`` columns get neighbouring numbers. No task sees more than its share of
    the new users: shares are numbered side by side and moved by the sizes of those before.
    """
    fresh = users.where(F.col(user).isNotNull())
    fresh = fresh.groupBy(user).agg(*[F.min(c).alias(c) for c in near]) if near else fresh.select(user).distinct()
    last = 0
    if known is not None:
        fresh = fresh.join(known.select(user), user, "left_anti")
        last = known.agg(F.max("number")).first()[0] or 0
    first = F.pmod(F.xxhash64(*near), F.lit(PARTS // 16)) if near else F.lit(0)
    fresh = fresh.withColumn("_part", (first * 16 + F.pmod(F.xxhash64(user), F.lit(16 if near else PARTS))).cast("int"))
    sizes = fresh.groupBy("_part").agg(F.count("*").alias("_n"))  # PARTS rows at most
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*near, user))
    return (fresh.withColumn("_place", place).join(F.broadcast(starts), "_part")
            .select(user, (F.lit(last) + F.col("_before") + F.col("_place")).cast("long").alias("number")))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame | None:
    names = [n for n in files.children(spark, path) if files.exists(spark, f"{path}/{n}/_SUCCESS")]
    return spark.read.parquet(*[f"{path}/{n}" for n in names]) if names else None


def extend_dictionary(spark: SparkSession, path: str, users: DataFrame, user: str, near: Sequence[str] = ()) -> DataFrame:
    """Add the unknown ones of ``users`` to the dictionary at ``path`` and return it whole.

    Known users keep their numbers. Every run adds a folder that counts once it is complete; a run
    that failed is written anew by the next, one that is repeated adds nothing.
    """
    known = read_dictionary(spark, path)
    count = len([n for n in files.children(spark, path) if files.exists(spark, f"{path}/{n}/_SUCCESS")])
    number_users(users, known, user, near).write.mode("overwrite").parquet(f"{path}/run-{count:08d}")
    return read_dictionary(spark, path)


def user_bitmaps(rows: DataFrame, dictionary: DataFrame, keys: Sequence[str], user: str) -> DataFrame:
    """(keys, slice, users): the users of every group as bitmaps of the dictionary's numbers.

    A user counts once per group however many rows there are; rows without a user count nowhere. A
    user who is not in the dictionary is an error of the caller's and raises one.
    """
    seen = rows.where(F.col(user).isNotNull()).select(*keys, user).distinct()
    number = F.coalesce("number", F.raise_error(F.concat(F.lit("not in the dictionary: "), F.col(user).cast("string"))).cast("long"))
    numbered = lookup(seen, dictionary.select(user, "number"), user).withColumn("number", number)
    return (numbered.groupBy(*keys, F.bitmap_bucket_number("number").alias("slice"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users")))


def distinct_from_bitmaps(bitmaps: DataFrame, keys: Sequence[str], flags: dict[str, Column]) -> DataFrame:
    """Distinct users per ``keys`` for several conditions on the bitmaps' other columns at once.

    Unions combine before the shuffle and are counted per slice, so that a group of very many users
    is spread over its slices. Groups without a user under a condition count 0.
    """
    unions = (bitmaps.groupBy(*keys, "slice")
              .agg(*[F.bitmap_or_agg(F.when(test, F.col("users"))).alias(name) for name, test in flags.items()]))
    counts = unions.select(*keys, *[F.bitmap_count(name).alias(name) for name in flags])
    return (counts.groupBy(*keys) if keys else counts.groupBy()).agg(*[F.sum(name).alias(name) for name in flags])


def retention_from_bitmaps(bitmaps: DataFrame, run_date: str, days: Sequence[int], keys: Sequence[str]) -> DataFrame:
    """New users of each cohort and the distinct users back within windows, from bitmaps by
    ``keys`` and ``date_diff``; cohorts are those old enough for the longest window."""
    oldest = F.date_format(F.date_sub(F.lit(run_date).cast("date"), max(days)), "yyyyMMdd").cast("int")
    gap = F.col("date_diff")
    flags = {"new_user_count": gap == 0}
    flags |= {f"day_{d}_count": gap == 1 if d == 1 else (gap > 0) & (gap <= d) for d in days}
    return distinct_from_bitmaps(bitmaps.where(F.col("create_date") <= oldest), keys, flags)
