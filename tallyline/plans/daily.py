"""Operator chains that are run together."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tallyline.operators.activity import daily_active
from tallyline.operators.merge import merge_new_users
from tallyline.operators.recommend import item_users, user_item_score, user_profile
from tallyline.operators.rollup import combination_rules, rollup_active, rollup_new
from tallyline.operators.scoring import bad_channels, grade_channels

ACTIVE_RULES = combination_rules(["channel_code", "area"], ["active_date", "create_date", "date_diff"])
NEW_RULES = combination_rules(["create_date", "channel_code", "area"])


def activity_cube(log: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """New users, their daily activity and its roll-up over channel and area, as one plan."""
    users = merge_new_users(current, log)
    return rollup_active(daily_active(log, users), ACTIVE_RULES)


def new_user_cube(log: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """New users counted over all sets of day, channel and area."""
    return rollup_new(merge_new_users(current, log), NEW_RULES)


def interest_profiles(clicks: DataFrame, tags: DataFrame, weights: Mapping[str, float], day: str,
                      decay: str = "reference") -> DataFrame:
    """From daily clicks and item tags to packed interest profiles."""
    scores = user_item_score(clicks, item_users(clicks), weights, day, decay=decay)
    return user_profile(scores, tags)


def channel_report(keep: DataFrame, quality: DataFrame, stat_date: str) -> DataFrame:
    """Grades of all channels cut down to the ones to warn about."""
    return bad_channels(grade_channels(keep, quality, stat_date))
