"""Retention, channel alarms and the counts they rest on."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.dates import date_from_int, date_int, day_gap
from tallyline.operators.skew import distinct_users


def retention_by_day(active: DataFrame, devices: DataFrame) -> DataFrame:
    """Users per channel, first version, creation day and days since creation."""
    born = devices.select("uuid", F.col("apk_version").alias("first_version"),
                          F.to_date("create_time").alias("_created"))
    rows = active.select("uuid", "customer_id", date_from_int("active_date").alias("_day"))
    return (rows.join(born, "uuid")
            .groupBy("customer_id", F.col("first_version").alias("apk_version"),
                     date_int("_created").alias("create_date"),
                     day_gap("_day", "_created").alias("day_diff"))
            .agg(F.count("*").alias("keep_user_count")))


def retention_windows(active: DataFrame, run_date: str, days: Sequence[int] = (1, 7, 14, 30, 60),
                      keys: Sequence[str] = ("customer_id", "first_apk_version", "os_type",
                                             "create_date")) -> DataFrame:
    """New users of each cohort and the distinct users back on day 1 and within longer windows.

    Only cohorts old enough for the longest window are reported, with all their visits.
    """
    oldest = F.date_sub(F.lit(run_date).cast("date"), max(days))
    cohorts = active.where(F.col("create_date") <= date_int(oldest))
    gap = F.col("date_diff")
    flags = {"_new": F.col("create_date") == F.col("active_date")}
    for d in days:
        flags[f"day_{d}_count"] = gap == 1 if d == 1 else (gap > 0) & (gap <= d)
    # one row per user and day, so that new rows and new users are the same count
    return distinct_users(cohorts, keys, "uuid", flags).withColumnRenamed("_new", "new_user_count")


@dataclass(frozen=True)
class RetentionAlarm:
    """One retention rule: which visits count, which cohorts, and the limit in percent."""

    gap: int
    at_least: bool
    lag: int
    limit: float
    single_cohort: bool = False


# Limits of the four retention alarms in percent.
RETENTION_ALARMS = {
    "next_day": RetentionAlarm(1, False, 1, 5),
    "after_7": RetentionAlarm(7, True, 7, 2),
    "after_14": RetentionAlarm(14, True, 14, 1),
    "cohort": RetentionAlarm(1, False, 0, 5, single_cohort=True),
}
MIN_NEW_USERS = 50


def channel_retention_rate(active: DataFrame, mode: str, day: str, begin: str | None = None,
                           exclude: Iterable[str] = (), limit: float | None = None,
                           min_new: int | None = MIN_NEW_USERS) -> DataFrame:
    """Retained users in percent of new users per channel for one alarm ``mode``.

    ``active`` has uuid, customer_id, install_date, visit_date (dates) and day_diff. ``limit``
    defaults to the mode's own; ``min_new=None`` and ``limit=float('inf')`` report every channel.
    """
    rule = RETENTION_ALARMS[mode]
    limit = rule.limit if limit is None else limit
    today = F.lit(day).cast("date")
    rows = active.where(_named(exclude))
    gap, visit, install = F.col("day_diff"), F.col("visit_date"), F.col("install_date")
    back = gap >= rule.gap if rule.at_least else gap == rule.gap
    if rule.single_cohort:
        rows = rows.where(install == F.date_sub(today, 2))
        flags = {"_back": back, "_base": gap == 0, "new_cnt": gap == 0}
    else:
        if begin:
            rows = rows.where(install >= F.lit(begin).cast("date"))
        flags = {"_back": back & (visit < F.date_sub(today, rule.lag - 1)),
                 "_base": (gap == 0) & (install < F.date_sub(today, rule.lag)),
                 "new_cnt": (gap == 0) & (install < today)}
    rates = distinct_users(rows, ["customer_id"], "uuid", flags)
    rates = rates.select("customer_id",
                         F.round(F.try_divide("_back", "_base") * 100, 2).alias("keep_pct"), "new_cnt")
    return _alarm(rates, "keep_pct", "<", limit, min_new)


def _named(exclude: Iterable[str]) -> Column:
    exclude = list(exclude)
    test = F.col("customer_id") > ""
    return test & ~F.col("customer_id").isin(exclude) if exclude else test


def _alarm(rates: DataFrame, col: str, op: str, limit: float, min_new: int | None) -> DataFrame:
    if limit != float("inf"):
        rates = rates.where(F.col(col) < limit if op == "<" else F.col(col) > limit)
    return rates if min_new is None else rates.where(F.col("new_cnt") > min_new)


# Direction and limit in percent of the four ratio alarms.
RATIO_LIMITS = {"wifi": (">", 95), "vpn": (">", 50), "phone": ("<", 1), "unlock": ("<", 2)}
# Codes of the largest mobile operator.
MOBILE_CODES = (46000, 46002, 46007)


def ratio_parts(kind: str) -> tuple[Column, Column]:
    """Numerator and denominator tests of a ratio alarm."""
    every = F.lit(True)
    return {
        "wifi": (F.col("link_type") == "WIFI", every),
        "vpn": (F.col("used_vpn") == 1, F.col("used_vpn") >= 0),
        "phone": (F.col("has_phone") == 1, F.col("isp_code").isin(*MOBILE_CODES)),
        "unlock": (F.col("unlock_count") >= 2, every),
    }[kind]


def channel_ratio_alarm(df: DataFrame, num: Column, den: Column, op: str, limit: float,
                        exclude: Iterable[str] = (), begin: str | None = None,
                        min_new: int | None = MIN_NEW_USERS) -> DataFrame:
    """Rows passing ``num`` in percent of rows passing ``den`` per channel, beyond ``limit``."""
    rows = df.where(_named(exclude))
    if begin:
        rows = rows.where(F.col("install_date") >= F.lit(begin).cast("date"))
    rates = (rows.groupBy("customer_id")
             .agg(F.round(F.try_divide(F.sum(F.when(num, 1).otherwise(0)),
                                       F.sum(F.when(den, 1).otherwise(0))) * 100, 2).alias("pct"),
                  F.count("*").alias("new_cnt")))
    return _alarm(rates, "pct", op, limit, min_new)


def active_drop_alarm(active: DataFrame, day: str, limit: float = 50.0,
                      exclude: Iterable[str] = ()) -> DataFrame:
    """Channels whose returning users fell by more than ``limit`` percent from day D-2 to D-1."""
    today = F.lit(day).cast("date")
    two, one = F.date_sub(today, 2), F.date_sub(today, 1)
    visit = F.col("visit_date")
    back = (visit > F.col("activate_date")) & visit.between(two, one)
    users = distinct_users(active.where(_named(exclude) & back), ["customer_id"], "uuid",
                           {"_two": visit == two, "_one": visit == one})
    drop = F.round(F.try_divide(F.col("_two") - F.col("_one"), F.col("_two")) * 100, 2)
    return users.select("customer_id", drop.alias("qoq_pct")).where(F.col("qoq_pct") > limit)


def alarm_summary(alarms: DataFrame, channels: DataFrame, day: str) -> DataFrame:
    """Messages of a day per alarm-enabled channel, joined in display order.

    A channel has one message per alarm kind, so the list of a group is short by construction.
    """
    rows = alarms.where(F.col("stat_date") == F.lit(day).cast("date"))
    enabled = channels.where(F.col("alarm") == 1).select("chacode", "cusname")
    return (rows.join(enabled, rows["customer_id"] == enabled["chacode"])
            .groupBy("cusname", "chacode")
            .agg(F.array_sort(F.collect_list(F.struct("show_order", "msg"))).alias("_m"))
            .select("cusname", "chacode",
                    F.array_join(F.transform("_m", lambda m: m["msg"]), " | ").alias("msgs")))


def recent_alarms(alarms: DataFrame, day: str) -> DataFrame:
    """Alarms not older than one month."""
    return alarms.where(F.col("stat_date") >= F.add_months(F.lit(day).cast("date"), -1))
