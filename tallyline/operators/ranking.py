"""Rankings, awards and eligibility of fans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.operators.skew import top_per_key


def _order(value: str, time: str, key: str) -> list:
    return [F.desc(value), F.asc(time), F.asc(key)]


def top_global(df: DataFrame, value: str = "love_index", time: str = "update_time",
               key: str = "fan_id", n: int = 5) -> DataFrame:
    """The ``n`` best rows: highest value, then the older update."""
    return df.orderBy(*_order(value, time, key)).limit(n)


def top_per_group(df: DataFrame, group: Sequence[str], n: int, value: str = "total_index",
                  time: str = "update_time", key: str = "user_id", rank: str = "topn") -> DataFrame:
    """The ``n`` best rows of every group with their place."""
    return top_per_key(df, list(group), _order(value, time, key), n, rank=rank)


def top_per_open_group(df: DataFrame, open_ids: DataFrame, current: DataFrame | None = None,
                       group: str = "public_id", value: str = "love_index", time: str = "update_time",
                       key: str = "fan_id", n: int = 20) -> DataFrame:
    """Rankings of the open groups; with ``current`` their stored rows are replaced and those of
    all other groups kept."""
    ids = open_ids.select(group).distinct()
    fresh = top_per_key(df.join(ids, group, "left_semi"), [group], _order(value, time, key), n,
                        rank="topn")
    if current is None:
        return fresh
    ranked = fresh.select(group).distinct()
    return current.select(*fresh.columns).join(ranked, group, "left_anti").unionByName(fresh)


def times_in_top(df: DataFrame, group: Sequence[str] = ("star_id",), period: Sequence[str] = ("year", "month"),
                 user: str = "user_id", n: int = 3, value: str = "total_index",
                 time: str = "update_time") -> DataFrame:
    """In how many months each fan was among the first ``n`` of a star."""
    winners = top_per_key(df, [*group, *period], _order(value, time, user), n)
    return winners.groupBy(*group, user).agg(F.count("*").alias("fan_month_num"))


def eligible_leaders(records: DataFrame, day: str, focus_days: int = 30, dynamics: int = 30,
                     top_cream: int = 2, months: int = 1) -> DataFrame:
    """Add is_satisfy_header: long-standing, active, praised and once among a month's best."""
    praised = F.col("fan_dynamic_top_num") + F.col("fan_dynamic_cream_num")
    old = F.col("focus_time") < F.date_sub(F.lit(day).cast("date"), focus_days).cast("timestamp")
    good = (old & (F.col("fan_dynamic_num") >= dynamics) & (praised >= top_cream)
            & (F.col("fan_month_num") >= months))
    return records.withColumn("is_satisfy_header", F.when(good, 1).otherwise(0))


# The parts of a fan's total index, and the points of one follow.
SCORE_PARTS = ("post_good_score", "focus_score", "hot_comment_score", "comment_score",
               "fan_dynamic_score", "gift_index", "pull_ring_index")
FOCUS_POINTS = 50


def fan_score(index: DataFrame, focus: DataFrame, keys: Sequence[str] = ("user_id",),
              parts: Sequence[str] = SCORE_PARTS) -> DataFrame:
    """Set focus_score to the points of all follows under ``keys`` and total_index to the sum of
    the ``parts``; rows without a follow keep their focus_score."""
    points = (focus.groupBy(*keys).agg((F.count("*") * FOCUS_POINTS).alias("_points")))
    scored = (index.join(points, list(keys), "left")
              .withColumn("focus_score", F.coalesce("_points", "focus_score")).drop("_points"))
    total = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    return scored.withColumn("total_index", total)


def fan_pool(star_posts: DataFrame, fan_posts: DataFrame) -> DataFrame:
    """Published star posts (type 1) and audited fan posts (type 2) under one schema."""
    stars = star_posts.where((F.col("is_delete") == 0) & (F.col("is_online") == 1)).select(
        "star_id", F.lit(None).cast("long").alias("user_id"), F.col("publish_time").alias("create_time"),
        F.col("id").alias("dynamic_id"), "is_top", F.lit(0).alias("is_cream"),
        F.lit(1).alias("dynamic_type"), "update_time")
    audited = (F.col("is_need_audit") == 0) | ((F.col("is_need_audit") == 1) & (F.col("is_audit") == 2)
                                               & (F.col("audit_score") == 2))
    fans = fan_posts.where(audited & (F.col("is_delete") == 0)).select(
        "star_id", F.col("fan_id").alias("user_id"), F.col("publish_time").alias("create_time"),
        F.col("id").alias("dynamic_id"), "is_top", F.coalesce("is_cream", F.lit(0)).alias("is_cream"),
        F.lit(2).alias("dynamic_type"), "update_time")
    return stars.unionByName(fans)
