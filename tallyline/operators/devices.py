"""Device facts and channel counts."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.clean import has_text, network_from_text
from tallyline.functions.dates import date_int, day_gap, dashed
from tallyline.operators.skew import lookup


def runlevel_users(log: DataFrame) -> DataFrame:
    """Distinct users per app, channel, run level and day."""
    rows = log.where(has_text("udid") & (F.length("clnt") <= 50))
    return (rows.groupBy(F.col("apppkg").alias("app_key"), "clnt", "runlevel",
                         date_int("createtime").alias("create_date"))
            .agg(F.count_distinct("udid").alias("user_count")))


def blacklist_counts(clients: DataFrame, customers: DataFrame, day: str) -> DataFrame:
    """Clients younger than their customer's blackout and those it releases tomorrow.

    Clients are counted per app, channel and age before they meet the customers.
    """
    age = day_gap(F.lit(day).cast("date"), "create_time")
    aged = clients.groupBy("app_key", "clnt", age.alias("_age")).agg(F.count("*").alias("_n"))
    rows = aged.join(customers.select(F.col("customid").alias("clnt"), "blackdate"), "clnt")
    black, release = F.col("_age") < F.col("blackdate"), F.col("_age") + 1 == F.col("blackdate")
    return (rows.groupBy("app_key", "clnt")
            .agg(F.sum(F.when(black, F.col("_n")).otherwise(0)).alias("black_count"),
                 F.sum(F.when(release, F.col("_n")).otherwise(0)).alias("release_count"))
            .withColumn("stat_date", F.lit(day)))


def channel_daily(clients: DataFrame, day: int | None = None, user: str | None = "udid",
                  channel: str = "clnt") -> DataFrame:
    """New users per channel and day: distinct ``user`` of clients with an app and a channel, or
    all plain rows with ``user=None``. ``day`` (yyyyMMdd) reports one day, otherwise all days.
    """
    rows = clients if user is None else clients.where(has_text("app_key") & has_text(channel))
    if day is not None:
        rows = rows.where(F.col("create_date") == day)
    count = F.count("*") if user is None else F.count_distinct(user)
    return (rows.groupBy("create_date", F.col(channel).alias("chacode")).agg(count.alias("csum"))
            .select(dashed("create_date").alias("cdate"), "chacode", "csum"))


def install_activation(devices: DataFrame, new_sdk: DataFrame, day: str | None = None) -> DataFrame:
    """Installs and activations (all and without duplicate ids) per channel and day, plus clients
    of the new sdk on devices the old one never saw.

    ``devices`` has customer_id, install_date, activate_date, is_activated, aid_status,
    imsi_status; ``new_sdk`` has customer_id, create_date, is_exists. The measures are stacked and
    summed, so a channel with only one of them still appears.
    """
    rows = devices.where(has_text("customer_id"))
    valid = (F.col("aid_status") == 0) & (F.col("imsi_status") == 0)
    counts = ["init_install_cnt", "install_cnt", "init_activate_cnt", "activate_cnt"]

    def tally(df: DataFrame, date: str, total: str, good: str) -> DataFrame:
        return (df.groupBy("customer_id", F.col(date).alias("stat_date"))
                .agg(F.count("*").alias(total), F.count(F.when(valid, 1)).alias(good)))

    installed = tally(rows, "install_date", "init_install_cnt", "install_cnt")
    active = tally(rows.where(F.col("is_activated") == 1), "activate_date", "init_activate_cnt",
                   "activate_cnt")
    fresh = (new_sdk.where(F.col("is_exists") == 0)
             .groupBy("customer_id", F.col("create_date").alias("stat_date"))
             .agg(F.count("*").alias("activate_cnt")))
    stacked = (installed.unionByName(active, allowMissingColumns=True)
               .unionByName(fresh, allowMissingColumns=True))
    if day is not None:
        stacked = stacked.where(F.col("stat_date") == F.lit(day).cast("date"))
    return (stacked.groupBy("stat_date", "customer_id")
            .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts]))


def flag_duplicate_ids(devices: DataFrame, col: str, flag: str, ignore: Sequence[str] = ("Unknown",),
                       key: str = "uuid", time: str = "create_time") -> DataFrame:
    """Mark every device but the earliest among those sharing ``col`` (ties: the smaller key stays).

    The first device of an id is found by a combining aggregate and looked up again, so that an id
    shared by very many devices is never sorted in one task.
    """
    dtype = devices.schema[col].dataType.simpleString()
    real = F.col(col).isNotNull()
    if dtype == "string":
        real = has_text(col) & ~F.col(col).isin(*ignore)
    marked = devices.withColumn("_id", F.when(real, F.col(col)))
    first = (marked.where(F.col("_id").isNotNull()).groupBy("_id")
             .agg(F.min(F.struct(time, key)).alias("_first")))
    own = F.struct(time, key)
    return (lookup(marked, first, "_id")
            .withColumn(flag, F.when(F.col("_first").isNotNull() & (own != F.col("_first")), 1)
                        .otherwise(0))
            .drop("_id", "_first"))


def stack_device_signals(active: DataFrame, stations: DataFrame, accounts: DataFrame, installs: DataFrame,
                         uses: DataFrame, run_date: str, days: int = 7) -> DataFrame:
    """The five logs of the ``days`` days before ``run_date`` as rows (uuid, signal, value, boottime,
    screen_on, time_diff)."""
    start = datetime.date.fromisoformat(run_date) - datetime.timedelta(days=days)
    readings = active.where(F.col("time_diff").isNotNull() & (F.col("active_date") >= int(start.strftime("%Y%m%d"))))
    stacked = readings.select("uuid", F.lit("battery").alias("signal"), F.col("battery").cast("string").alias("value"),
                              "boottime", "screen_on", "time_diff")
    for log, value, name in ((stations, "stationcode", "station"), (accounts, "app_pkgname", "account"),
                             (installs, "app_pkgname", "install"), (uses, "app_pkgname", "appuse")):
        rows = log.where(has_text("uuid") & (F.col("createtime") >= F.lit(start).cast("timestamp")))
        if name == "station":
            rows = rows.where(F.col(value) > 0)
        stacked = stacked.unionByName(rows.select("uuid", F.lit(name).alias("signal"), F.col(value).cast("string").alias("value")),
                                      allowMissingColumns=True)
    return stacked


def device_signals(clients: DataFrame, stacked: DataFrame, time_limit: int = 30) -> DataFrame:
    """Signals per device: longest run, screen, battery levels, clock errors (devices with activity
    only), then distinct stations, accounts, installed and used apps (0 if none).

    ``stacked`` is :func:`stack_device_signals` or has its columns. Distinct values are one
    aggregation, all counts a second one, and the clients are joined once.
    """
    late = F.when(F.abs(F.col("time_diff") / 60) > time_limit, 1).otherwise(0)
    values = stacked.groupBy("uuid", "signal", "value").agg(
        F.max("boottime").alias("runtime"), F.max("screen_on").alias("unlock_cnt"), F.sum(late).alias("late"))
    one = F.when(F.col("value").isNotNull(), 1).otherwise(0)

    def count(signal: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("signal") == signal, one)), F.lit(0)).alias(f"{signal}_cnt")

    found = values.groupBy("uuid").agg(
        F.max("runtime").alias("runtime"), F.max("unlock_cnt").alias("unlock_cnt"), count("battery"),
        F.sum(F.when(F.col("signal") == "battery", F.col("late"))).alias("etime_cnt"),
        *[count(s) for s in ("station", "account", "install", "appuse")])
    return (clients.select("uuid", "customer_id", "create_date")
            .join(found.where(F.col("etime_cnt").isNotNull()), "uuid"))


def device_fact(devices: DataFrame, log: DataFrame, measure: Column, name: str,
                default: int | None = 0, time: str = "create_time",
                where: Column | None = None) -> DataFrame:
    """Every device with one ``measure`` over its log rows and the day of the latest of them.

    ``default`` is given to devices without rows (``None`` keeps null); ``where`` limits the rows,
    such as battery levels to 1..100.
    """
    rows = log.where(has_text("uuid") if where is None else has_text("uuid") & where)
    counted = rows.groupBy("uuid").agg(measure.alias(name), F.to_date(F.max(time)).alias("stat_date"))
    joined = devices.select("uuid", "customer_id", "install_date").join(counted, "uuid", "left")
    return joined if default is None else joined.fillna(default, subset=[name])


# Order of link types in the device network table.
LINK_ORDER = {"WIFI": 1, "2G": 2, "3G": 3, "4G": 4}


def best_network(current: DataFrame | None, log: DataFrame, devices: DataFrame) -> DataFrame:
    """Every device with the highest link it ever used and the latest day, ``Unknown`` if none."""
    link = network_from_text("link_type", exact=True)
    rows = log.where(has_text("uuid")).select("uuid", link.alias("link_type"),
                                              F.to_date("create_time").alias("stat_date"))
    if current is not None:
        rows = current.select("uuid", link.alias("link_type"), "stat_date").unionByName(rows)
    order = F.create_map(*[F.lit(x) for pair in LINK_ORDER.items() for x in pair])
    best = F.when(F.col("link_type").isNotNull(),
                  F.struct(order[F.col("link_type")].alias("o"), "link_type"))
    known = (rows.groupBy("uuid").agg(F.max(best).alias("_best"),
                                      F.max("stat_date").alias("stat_date"))
             .select("uuid", F.col("_best.link_type").alias("link_type"), "stat_date"))
    return (devices.select("uuid", "customer_id", "install_date").join(known, "uuid", "left")
            .fillna("Unknown", subset=["link_type"]))


def device_flags(current: DataFrame | None, log: DataFrame, devices: DataFrame) -> DataFrame:
    """Every device with the running maximum of its vpn and phone flags, -1 when never seen."""
    rows = log.where(has_text("uuid")).select(
        "uuid", F.col("apn").alias("used_vpn"),
        F.when(has_text("phone_num"), 1).otherwise(0).alias("has_phone"))
    if current is not None:
        stored = current.select("uuid", *[F.when(F.col(c) >= 0, F.col(c)).alias(c)
                                          for c in ("used_vpn", "has_phone")])
        rows = stored.unionByName(rows)
    top = rows.groupBy("uuid").agg(F.max("used_vpn").alias("used_vpn"),
                                   F.max("has_phone").alias("has_phone"))
    return (devices.select("uuid", "customer_id", "install_date", "isp_code")
            .join(top, "uuid", "left").fillna(-1, subset=["used_vpn", "has_phone"]))


# Packages whose use counts as ordinary phone use.
PHONE_PACKAGES = ("com.android.phone", "com.android.mms", "com.android.gallery")


def signal_stations(log: DataFrame) -> DataFrame:
    """Distinct (user, channel, station, day)."""
    return log.select("uuid", "customer_id", "station_code",
                      date_int("log_time").alias("create_date")).distinct()


def signal_sums(log: DataFrame, value: str | None, name: str, time: str,
                packages: Sequence[str] | None = None) -> DataFrame:
    """Per user, channel and day the sum of ``value``, or the number of rows without one."""
    rows = log if packages is None else log.where(F.col("pkg_name").isin(*packages))
    total = F.count("*") if value is None else F.sum(value)
    return (rows.groupBy("uuid", "customer_id", date_int(time).alias("create_date"))
            .agg(total.alias(name)))


def signal_values(log: DataFrame, values: Sequence[str], time: str) -> DataFrame:
    """Distinct (user, channel, values, day): accounts and link types."""
    return log.select("uuid", "customer_id", *values, date_int(time).alias("create_date")).distinct()


def daily_signal_rollups(logs: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Per-day bases of the device score from the raw logs that are present in ``logs``."""
    build = {
        "stations": lambda df: signal_stations(df),
        "locked": lambda df: signal_sums(df, "unlock_cnt", "unlock_count", "unlock_log_date"),
        "app_used": lambda df: signal_sums(df, "open_cnt", "app_used_count", "app_used_date",
                                           PHONE_PACKAGES),
        "app_install": lambda df: signal_sums(df, None, "app_install_count", "app_log_date"),
        "accounts": lambda df: signal_values(df, ["acc_name", "acc_type"], "create_time"),
        "links": lambda df: signal_values(df, ["link_type"], "create_time"),
    }
    return {name: build[name](df) for name, df in logs.items()}
