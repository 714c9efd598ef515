"""Rule-based device scores and channel grades."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Points of the scoring rules by rule id.
RULE_SCORES = {
    1: 5, 2: -20, 3: -10, 4: 5, 5: -5, 6: 5, 7: 0, 8: 5, 9: 0,
    10: -10, 11: -5, 12: 5, 13: 10, 14: -10, 15: -5, 16: 5, 17: 10,
    18: -10, 19: -10, 20: 5, 21: 10, 22: -10, 23: 5, 24: 10, 25: 5, 26: 0,
    27: 5, 28: 0, 29: 5, 30: 0, 31: -5, 32: 5, 33: 0,
}
LAST_RULE = 37  # 34 to 37 are the id states, which have no points
DAY_MS = 24 * 60 * 60 * 1000

# Signals a device may have: info flags of the last report, and counts over the window.
INFO = ("changed_mac", "used_vpn", "uptime", "has_phonenum")
COUNTS = ("power", "station", "locked", "app_used", "link", "app_install", "account", "active")


def rule_table(spark: SparkSession) -> DataFrame:
    """The default rule table (id, score)."""
    return spark.createDataFrame(sorted(RULE_SCORES.items()), "id int, score int")


# The columns of the per-day tables that are counted or summed.
_VALUES = {"power": ["power"], "station": ["station_code"], "link": ["link_type"], "account": ["acc_name", "acc_type"]}
_AMOUNTS = {"locked": "unlock_count", "app_used": "app_used_count", "app_install": "app_install_count"}


def stack_signals(bases: dict[str, DataFrame], run_date: str, days: int = 10) -> DataFrame:
    """The per-day tables (uuid, create_date as yyyyMMdd and the value), named by ``COUNTS``, as rows
    (uuid, signal, day, value, amount) of the ``days`` days before ``run_date``."""
    end = datetime.date.fromisoformat(run_date)
    low, high = (int((end - datetime.timedelta(days=d)).strftime("%Y%m%d")) for d in (days, 0))
    stacked = None
    for name, df in bases.items():
        rows = df.where((F.col("create_date") >= low) & (F.col("create_date") < high))
        if name == "power":
            rows = rows.where(F.col("power") > 0)
        columns = _VALUES.get(name, [])
        known = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in columns], F.lit(True))
        value = F.when(known, F.concat_ws("\x01", *[F.col(c).cast("string") for c in columns])) if columns else F.lit(None)
        amount = F.col(_AMOUNTS[name]) if name in _AMOUNTS else F.lit(None)
        one = rows.select("uuid", F.lit(name).alias("signal"), F.col("create_date").alias("day"),
                          value.cast("string").alias("value"), amount.cast("long").alias("amount"))
        stacked = one if stacked is None else stacked.unionByName(one)
    return stacked


def count_signals(stacked: DataFrame, names: Sequence[str] = COUNTS) -> DataFrame:
    """One column per signal and device from stacked rows (uuid, signal, day, value, amount), which
    may be rows of the raw logs or of the per-day tables.

    Distinct values (power, station, link), distinct daily sums (locked), values per day (account),
    days (active) and sums (app_used, app_install) all come from one chain of three aggregations:
    per day, per counted value, and per device. A signal a device lacks is null.
    """
    signal, value, day = F.col("signal"), F.col("value"), F.col("day").cast("string")
    daily = stacked.groupBy("uuid", "signal", "day", "value").agg(F.sum("amount").alias("amount"))
    counted = (F.when(signal.isin("power", "station", "link"), value).when(signal == "locked", F.col("amount").cast("string"))
               .when(signal == "account", F.concat(day, F.lit("\x01"), value)).when(signal == "active", day))
    values = daily.groupBy("uuid", "signal", counted.alias("counted")).agg(F.sum("amount").alias("amount"))
    one = F.when(F.col("counted").isNotNull(), 1).otherwise(0)
    return values.groupBy("uuid").agg(*[
        F.sum(F.when(signal == n, F.col("amount") if n in ("app_used", "app_install") else one)).cast("long").alias(n) for n in names])


def signal_counts(bases: dict[str, DataFrame], run_date: str, days: int = 10) -> DataFrame:
    """Signals per device over the ``days`` days before ``run_date``, from per-day tables."""
    return count_signals(stack_signals(bases, run_date, days), list(bases))


def _bands(c: str, ids: Sequence[int]) -> Column:
    """Rule ids for the counts 0, 1, 2..4 and 5 or more."""
    v = F.col(c)
    return (F.when(v == 0, ids[0]).when(v == 1, ids[1]).when(v < 5, ids[2])
            .when(v >= 5, ids[3]))


def rule_columns(present: Sequence[str]) -> list[Column]:
    """One rule-id expression per signal; null when the device lacks the signal."""
    days = F.col("uptime") / DAY_MS
    # a device with an info report gets all four info rules, whatever its flags hold
    has_info = F.col("_has_info") if "_has_info" in present else F.lit(True)
    rules = {
        "changed_mac": F.when(has_info, F.when(F.col("changed_mac") == 1, 1).otherwise(2)),
        "used_vpn": F.when(has_info, F.when(F.col("used_vpn") == 1, 3).otherwise(4)),
        "uptime": F.when(has_info, F.when(days < 1, 5).when(days > 3, 6).otherwise(7)),
        "has_phonenum": F.when(has_info, F.when(F.col("has_phonenum") == 1, 8).otherwise(9)),
        "power": _bands("power", (10, 11, 12, 13)),
        "station": _bands("station", (14, 15, 16, 17)),
        "locked": _bands("locked", (18, 19, 20, 21)),
        "app_used": F.when(F.col("app_used") == 0, 22).when(F.col("app_used") < 10, 23)
        .when(F.col("app_used") >= 10, 24),
        "link": F.when(F.col("link").isNotNull(), F.when(F.col("link") > 2, 25).otherwise(26)),
        "app_install": F.when(F.col("app_install").isNotNull(),
                              F.when(F.col("app_install") > 3, 27).otherwise(28)),
        "account": F.when(F.col("account").isNotNull(),
                          F.when(F.col("account") > 0, 29).otherwise(30)),
        "active": F.when(F.col("active").isNotNull(),
                         F.when(F.col("active") == 1, 31).when(F.col("active") > 3, 32)
                         .otherwise(33)),
    }
    status = F.coalesce(F.when(F.col("changed_status") > "", F.col("changed_status")),
                        F.col("original_status")) if "original_status" in present else None
    columns = [rule for name, rule in rules.items() if name in present]
    if status is not None:
        columns.append(F.when(status == "B", 34).when(status == "C", 35).when(status == "G", 36)
                       .otherwise(37))
    return columns


def score_log(signals: DataFrame, run_date: str) -> DataFrame:
    """One row per device and rule that fired."""
    fired = F.filter(F.array(*rule_columns(signals.columns)), lambda r: r.isNotNull())
    return (signals.select("uuid", F.explode(fired).alias("rule_id"))
            .withColumn("create_date", F.lit(run_date)))


def score_devices(signals: DataFrame, rules: DataFrame, run_date: str) -> DataFrame:
    """Points and number of rules per device. Rules missing from the rule table do not count.

    Only ids that can fire are kept of the rule table, one row each, which bounds the broadcast; a
    shuffle on so few rule ids would be all skew.
    """
    log = score_log(signals, run_date)
    points = (rules.where(F.col("id").between(1, LAST_RULE)).groupBy(F.col("id").alias("rule_id"))
              .agg(F.min("score").alias("score")))
    return (log.join(F.broadcast(points), "rule_id").groupBy("uuid", "create_date")
            .agg(F.sum("score").alias("score"), F.count("*").alias("rule_count")))


def device_score_signals(info: DataFrame, counts: DataFrame) -> DataFrame:
    """Info flags and window counts of every device that has either."""
    reports = info.select("uuid", *INFO).withColumn("_has_info", F.lit(True))
    stacked = reports.unionByName(counts, allowMissingColumns=True)
    names = [c for c in stacked.columns if c != "uuid"]
    return stacked.groupBy("uuid").agg(*[F.max(c).alias(c) for c in names])


# Thresholds of the channel grades, best grade first.
GRADES = {
    "A": dict(keep=(0.3, 0.2, 0.1), vpn=0.05, phone=0.6, network=0.6, rest=0.6),
    "B": dict(keep=(0.15, 0.1, 0.05), vpn=0.15, phone=0.2, network=0.85, rest=0.9),
    "C": dict(keep=(0.1, 0.05, 0.02), vpn=0.3, phone=0.1, network=0.95, rest=0.95),
}
MIN_USERS = 50
_KEEPS = ("keep_pct_1", "keep_pct_3", "keep_pct_6")
# Ratios of the channel quality report.
_QUALITY = ("vpn_pct", "phone_pct", "network_pct", "runtime_pct", "unlock_pct", "battery_pct",
            "etime_pct", "station_pct", "account_pct", "install_pct", "appuse_pct")


def grade_channels(keep: DataFrame, quality: DataFrame, stat_date: str) -> DataFrame:
    """Channels in both tables with a rank: A, B, C, else E for clearly bad ones, else D."""
    cols = [c for c in _QUALITY if c in quality.columns]
    df = (keep.select("channel_id", "user_count", *_KEEPS)
          .join(quality.select("channel_id", *cols), "channel_id")
          .fillna(0, subset=[*_KEEPS, *cols]))
    enough = F.col("user_count") > MIN_USERS
    rank = None
    for grade, g in GRADES.items():
        test = enough & (F.col("vpn_pct") < g["vpn"]) & (F.col("phone_pct") > g["phone"])
        for c, low in zip(_KEEPS, g["keep"]):
            test = test & (F.col(c) > low)
        test = test & (F.col("network_pct") < g["network"])
        for c in ("runtime_pct", "battery_pct", "station_pct"):
            test = test & (F.col(c) < g["rest"])
        rank = F.when(test, grade) if rank is None else rank.when(test, grade)
    lost = (F.col("keep_pct_1") < 0.05) | (F.col("keep_pct_3") < 0.02) | (F.col("keep_pct_6") < 0.01)
    odd = (F.col("vpn_pct") > 0.6) | (F.col("phone_pct") < 0.05)
    for c in ("network_pct", "runtime_pct", "battery_pct", "station_pct"):
        odd = odd | (F.col(c) > 0.98)
    rank = rank.when(enough & lost & odd, "E").otherwise("D")
    return df.withColumns({"channel_rank": rank, "stat_date": F.lit(stat_date)})


def bad_channels(graded: DataFrame, grades: Sequence[str] = ("D", "E"),
                 as_text: bool = True) -> DataFrame:
    """Channels of the given grades, worst first, ratios as percent text with zero left blank."""
    ratios = [c for c in (*_KEEPS, "vpn_pct", "phone_pct", "network_pct", "runtime_pct", "unlock_pct",
                          "battery_pct", "etime_pct", "station_pct") if c in graded.columns]
    rows = graded.where(F.col("channel_rank").isin(*grades))
    if as_text:
        percent = {c: F.when(F.col(c) == 0, "").otherwise(F.format_string("%.2f%%", F.col(c) * 100))
                   for c in ratios}
        rows = rows.withColumns(percent)
    return (rows.select("channel_id", "channel_rank", "user_count", *ratios)
            .orderBy(F.desc("channel_rank"), "channel_id"))
