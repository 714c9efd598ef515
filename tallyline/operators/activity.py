"""Daily activity, sessions and usage counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.clean import (bucket_minutes, clamp_percent, duration_seconds, has_text,
                                       session_seconds)
from tallyline.functions.dates import date_int, day_gap, second_gap
from tallyline.operators.fold import Policy, fold
from tallyline.operators.skew import bucketed_lag


def _with_clients(active: DataFrame, clients: DataFrame, keys: Sequence[str],
                  columns: Sequence[str]) -> DataFrame:
    """Inner join of per-day rows with client rows: adds ``columns``, create_date, date_diff."""
    known = clients.select(*keys, *columns, date_int("create_time").alias("create_date"),
                           F.to_date("create_time").alias("_created"))
    return (active.join(known, list(keys))
            .withColumn("date_diff", day_gap("_day", "_created"))
            .drop("_day", "_created"))


def daily_active(log: DataFrame, clients: DataFrame, keys: Sequence[str] = ("aid",),
                 attrs: Sequence[str] = ("area",), client_cols: Sequence[str] = ("channel_code",),
                 extra_keys: Sequence[str] = (), time: str = "create_time") -> DataFrame:
    """One row per user (app, log type ...) and day: visits and the attributes of the first visit.

    ``keys`` identify a client, ``extra_keys`` (such as a log type) only split its days. The log is
    reduced to one row per user and day before it meets the clients.
    """
    rows = log.dropna(subset=[*keys, time]).withColumn("_day", F.to_date(time))
    active = (rows.groupBy(*keys, *extra_keys, "_day")
              .agg(F.min(F.struct(F.col(time).alias("_t"), *attrs)).alias("_first"),
                   F.count("*").alias("visit_times"))
              .select(*keys, *extra_keys, "_day", date_int("_day").alias("active_date"),
                      *[F.col(f"_first.{c}").alias(c) for c in attrs], "visit_times"))
    return _with_clients(active, clients, keys, client_cols)


def daily_active_backfill(logs: Sequence[DataFrame], clients: DataFrame, **options) -> DataFrame:
    """:func:`daily_active` over several sources; rows delivered by more than one count once."""
    rows = logs[0]
    for other in logs[1:]:
        rows = rows.unionByName(other)
    return daily_active(rows.distinct(), clients, **options)


AD_ACTIVE = Policy(last_known=("city_id", "model", "src", "sysver", "version", "is_root"),
                   highest=("nettype",), unknown=("null",))


def daily_active_latest(log: DataFrame, devices: DataFrame, key: str = "device_id",
                        policy: Policy = AD_ACTIVE, time: str = "create_time") -> DataFrame:
    """One row per device and day: the latest usable attributes and the best link code."""
    rows = log.where(has_text(key)).withColumn("_day", F.to_date(time))
    active = fold(rows, [key, "_day"], policy, start=time, end=time)
    active = active.withColumn("active_date", date_int("_day"))
    return _with_clients(active, devices, [key], [])


def _bit(hour: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), hour.cast("int"))


def hours_text(mask: str) -> Column:
    """Set bits of an hour mask as text: ``8,9,21``."""
    hours = F.filter(F.sequence(F.lit(0), F.lit(23)),
                     lambda h: F.col(mask).bitwiseAND(_bit(h)) != 0)
    return F.array_join(hours, ",")


def rich_log(log: DataFrame) -> DataFrame:
    """visit_rich rows cleaned for :func:`daily_active_rich`."""
    keep = (has_text("uuid") & has_text("appkey") & has_text("customid") & has_text("version")
            & (F.col("logtype") > 0))
    return log.where(keep).select(
        "uuid", F.col("appkey").alias("app_key"), F.col("createtime").alias("create_time"),
        second_gap("time", "createtime").alias("time_diff"),
        bucket_minutes("boottime").alias("boottime"), "version",
        F.col("extsizeleft").alias("sdcard_size"), F.col("romsizeleft").alias("rom_size"),
        clamp_percent("screenon").alias("screen_on"),
        clamp_percent("battery", strict=True).alias("battery"),
        F.col("logtype").alias("log_type"), "city", "region", "country",
        F.col("clientip").alias("client_ip"))


def daily_active_rich(log: DataFrame, sessions: DataFrame, clients: DataFrame) -> DataFrame:
    """One row per user, app, day and log type with hours, boot minutes, screen, battery levels,
    place and latest readings; user-driven rows (log_type 1) get starts and seconds of sessions.

    Active hours and battery levels are folded as bit masks of fixed size, so that no list of a
    user's visits is ever built.
    """
    keys = ["uuid", "app_key", "_day", "log_type"]
    late = ["time_diff", "sdcard_size", "rom_size", "client_ip"]
    place = ["city", "region", "country"]
    at = F.col("create_time").alias("_t")

    def known(c: str) -> Column:
        usable = has_text(c) & (F.lower(F.col(c)) != "unknown")
        return F.min(F.when(usable, F.struct(at, F.col(c).alias("v"))))

    rows = log.withColumn("_day", F.to_date("create_time"))
    low = F.when(F.col("battery").between(1, 50), _bit(F.col("battery")))
    high = F.when(F.col("battery") > 50, _bit(F.col("battery") - 50))
    active = rows.groupBy(*keys).agg(
        F.bit_or(_bit(F.hour("create_time"))).alias("_hours"),
        F.max(F.struct(at, *late)).alias("_late"),
        F.max("boottime").alias("boottime"),
        F.min(F.struct(at, "version")).alias("_first"),
        F.max("screen_on").alias("screen_on"),
        F.bit_or(low).alias("_low"), F.bit_or(high).alias("_high"),
        *[known(c).alias(f"_{c}") for c in place],
        F.count("*").alias("visit_times"))

    def bits(c: str) -> Column:
        return F.bit_count(F.coalesce(F.col(c), F.lit(0).cast("long")))

    active = active.select(
        *keys, date_int("_day").alias("active_date"), hours_text("_hours").alias("active_hours"),
        *[F.col(f"_late.{c}").alias(c) for c in late], "boottime",
        F.col("_first.version").alias("version"), "screen_on",
        (bits("_low") + bits("_high")).cast("int").alias("battery"),
        *[F.coalesce(f"_{c}.v", F.lit("unknown")).alias(c) for c in place], "visit_times")
    starts = (sessions.groupBy("uuid", "app_key", F.col("create_date").alias("active_date"))
              .agg(F.count("session_id").alias("start_times"), F.sum("duration").alias("duration"))
              .withColumn("log_type", F.lit(1)))
    joined = active.join(starts, ["uuid", "app_key", "active_date", "log_type"], "left")
    joined = joined.withColumns({"start_times": F.coalesce("start_times", F.lit(1)),
                                 "duration": F.coalesce("duration", F.lit(0))})
    return _with_clients(joined, clients, ["uuid", "app_key"], ["customer_id", "init_version"])


def _session_rows(log: DataFrame) -> DataFrame:
    rows = log.where(has_text("deviceid") & has_text("appkey") & has_text("session_id"))
    return (rows.groupBy(F.col("deviceid").alias("uuid"), F.col("appkey").alias("app_key"),
                         "session_id")
            .agg(F.min(F.struct(F.col("start_millis").alias("t"), "version")).alias("_first"),
                 F.sum("duration").alias("_ms"))
            .select("uuid", "app_key", "session_id", F.col("_first.t").alias("create_time"),
                    F.col("_first.version").alias("version"),
                    F.round(F.col("_ms") / 1000).cast("long").alias("duration")))


def _session_output(rows: DataFrame, bucket: str) -> DataFrame:
    linked = bucketed_lag(rows.withColumn("_bucket", F.date_trunc(bucket, "create_time")),
                          ["uuid", "app_key"], ["create_time", "session_id"], "create_time", "_bucket",
                          "prev_time")
    return linked.withColumns({
        "create_date": date_int("create_time"),
        "duration": session_seconds(F.col("duration") * 1000),
        "date_diff": F.coalesce(day_gap("create_time", "prev_time"), F.lit(-1)),
    }).drop("_bucket")


def session_lengths(log: DataFrame) -> DataFrame:
    """Sessions with their day and seconds but without the link to the previous one."""
    return _session_rows(log).withColumns({"create_date": date_int("create_time"),
                                           "duration": session_seconds(F.col("duration") * 1000)})


def sessions(log: DataFrame, clients: DataFrame, bucket: str = "day") -> DataFrame:
    """One row per session: start, version, seconds, start of the user's previous session in the
    same app and the days since then (-1 when there is none).

    ``bucket`` is the span (day, hour, minute) over which the sessions of one user are spread.
    """
    found = _session_output(_session_rows(log), bucket)
    return found.join(clients.select("uuid", "app_key", "customer_id"), ["uuid", "app_key"])


def sessions_incremental(stored: DataFrame, log: DataFrame, clients: DataFrame,
                         bucket: str = "hour") -> DataFrame:
    """:func:`sessions` of a new log, continued from the last stored session of each user and app.

    A session id that goes on keeps its old start and adds up its seconds. The result replaces
    stored rows of the same session. A run covers a day or so, hence the finer ``bucket``.
    """
    new = _session_rows(log).withColumn("_new", F.lit(1))
    keys = ["uuid", "app_key"]
    last = (stored.join(new.select(*keys).distinct(), keys, "left_semi").groupBy(*keys)
            .agg(F.max(F.struct("create_time", "session_id", "version", "duration")).alias("s"))
            .select(*keys, "s.session_id", "s.create_time", "s.version", "s.duration",
                    F.lit(0).alias("_new")))
    joined = (last.unionByName(new).groupBy(*keys, "session_id")
              .agg(F.min(F.struct(F.col("create_time").alias("t"), "version")).alias("_first"),
                   F.sum("duration").alias("duration"), F.max("_new").alias("_new"))
              .select(*keys, "session_id", F.col("_first.t").alias("create_time"),
                      F.col("_first.version").alias("version"), "duration", "_new"))
    found = _session_output(joined, bucket).where("_new = 1").drop("_new")
    return found.join(clients.select(*keys, "customer_id"), keys)


def hourly_active(active: DataFrame, keys: Sequence[str] = ("customer_id", "version",
                                                            "active_date")) -> DataFrame:
    """Users per hour from packed ``active_hours``, every group with all 24 hours.

    Rows are first reduced to one per distinct hour text, then the 24 counts of a group are summed
    side by side; hours become rows only after that.
    """
    packed = active.groupBy(*keys, "active_hours").agg(F.count("*").alias("_n"))
    padded = F.concat(F.lit(","), "active_hours", F.lit(","))
    sums = [F.sum(F.when(padded.contains(f",{h},"), F.col("_n")).otherwise(0)).alias(f"h{h}")
            for h in range(24)]
    pairs = F.array(*[F.struct(F.lit(h).alias("active_hour"), F.col(f"h{h}").alias("user_count"))
                      for h in range(24)])
    return packed.groupBy(*keys).agg(*sums).select(*keys, F.inline(pairs))


def open_counts(events: DataFrame, event: str = "f_open") -> DataFrame:
    """Openings per user, app and day; channel and version of the first opening of the day."""
    rows = _usage_rows(events, event)
    return (rows.groupBy("uuid", "app_key", "stat_date")
            .agg(F.min(F.struct("insertdate", "clnt", "version")).alias("f"),
                 F.count("*").alias("open_times"))
            .select("uuid", "app_key", "f.clnt", "f.version", "stat_date", "open_times"))


def use_durations(events: DataFrame, event: str = "f_exit") -> DataFrame:
    """One row per exit event with its seconds; stays of no or over an hour's length are dropped."""
    rows = _usage_rows(events, event).withColumn("duration", duration_seconds("acc"))
    return (rows.where(F.col("duration").isNotNull())
            .select("id", "uuid", "app_key", "clnt", "version", "stat_date", "duration"))


def _usage_rows(events: DataFrame, event: str) -> DataFrame:
    full = has_text("uuid") & has_text("productkey") & has_text("clnt") & has_text("version")
    return (events.where((F.col("event") == event) & full)
            .withColumnRenamed("productkey", "app_key")
            .withColumn("stat_date", date_int("insertdate")))


def hourly_new_users(devices: DataFrame) -> DataFrame:
    """New users per channel, first version, day and hour."""
    return (devices.groupBy("customer_id", "apk_version", date_int("create_time").alias("create_date"),
                            F.hour("create_time").alias("create_hour"))
            .agg(F.count("*").alias("user_count")))


def active_user_days(log: DataFrame, devices: DataFrame) -> DataFrame:
    """Per user and day: visits, version and channel of the first visit, first version and creation
    date of the device (inner join)."""
    rows = log.withColumn("_day", F.to_date("create_time"))
    per_day = (rows.groupBy("uuid", "_day")
               .agg(F.min(F.struct("create_time", "customer_id", "apk_version")).alias("f"),
                    F.count("*").alias("visit_count"))
               .select("uuid", "_day", "f.customer_id", "f.apk_version",
                       date_int("_day").alias("active_date"), "visit_count"))
    first = devices.select("uuid", F.col("apk_version").alias("first_apk_version"),
                           F.to_date("create_time").alias("_created"), "os_type")
    return (per_day.join(first, "uuid")
            .withColumns({"create_date": date_int("_created"),
                          "date_diff": day_gap("_day", "_created")})
            .drop("_day", "_created"))


def usage_frequency(active: DataFrame, keys: Sequence[str] = ("customer_id", "apk_version",
                                                              "active_date")) -> DataFrame:
    """Users per group and number of visits on the day."""
    return active.groupBy(*keys, "visit_count").agg(F.count("*").alias("user_count"))


def start_counts(log: DataFrame) -> DataFrame:
    """Launches per channel, version, system and day."""
    return (log.groupBy("customer_id", "apk_version", "os_type",
                        date_int("create_time").alias("visit_date"))
            .agg(F.count("*").alias("start_times")))


def user_totals(devices: DataFrame, active: DataFrame, day: str,
                keys: Sequence[str] = ("customer_id", "apk_version")) -> DataFrame:
    """New, visiting, active (visiting less new) and all users so far per group for one ``day``.

    The three measures are stacked and summed once instead of being outer-joined. A measure without
    rows stays null, and so does a difference with it.
    """
    keys = list(keys)
    end = F.date_add(F.lit(day).cast("date"), 1)
    created = F.to_date("create_time")
    mine = (devices.where(created < end).groupBy(*keys)
            .agg(F.sum(F.when(created == F.lit(day).cast("date"), 1)).alias("new_user_count"),
                 F.count("*").alias("total_user_count"))
            .withColumn("visit_user_count", F.lit(None).cast("long")))
    visits = active.where(F.col("active_date") == int(day.replace("-", "")))
    if "first_apk_version" in active.columns:  # a visit counts for the version it started with
        visits = visits.withColumn("apk_version", F.col("first_apk_version"))
    seen = (visits.groupBy(*keys).agg(F.count("*").alias("visit_user_count"))
            .withColumns({"new_user_count": F.lit(None).cast("long"),
                          "total_user_count": F.lit(None).cast("long")}))
    sums = [F.sum(c).alias(c) for c in ("new_user_count", "visit_user_count", "total_user_count")]
    return (mine.unionByName(seen).groupBy(*keys).agg(*sums)
            .select(*keys, F.lit(int(day.replace("-", ""))).alias("create_date"),
                    "new_user_count", "visit_user_count",
                    (F.col("visit_user_count") - F.col("new_user_count")).alias("active_user_count"),
                    "total_user_count"))


def version_split(devices: DataFrame) -> DataFrame:
    """Initial and upgraded users per channel, first version and day of creation."""
    later = F.coalesce(F.col("update_version"), F.lit(0))
    upgraded = (later > 0) & (later != F.col("apk_version"))
    return (devices.groupBy("customer_id", "apk_version", date_int("create_time").alias("create_date"))
            .agg(F.sum(F.when(upgraded, 0).otherwise(1)).alias("initial_user_count"),
                 F.sum(F.when(upgraded, 1).otherwise(0)).alias("upgrade_user_count"),
                 F.count("*").alias("total_user_count")))


def sdk_first_last_version(log: DataFrame) -> DataFrame:
    """First and last sdk version per user and app."""
    rows = log.where(has_text("udid") & has_text("apppkg") & has_text("sdkver"))
    at = F.struct("createtime", "sdkver")
    return (rows.groupBy("udid", F.col("apppkg").alias("app_key"))
            .agg(F.min(at).alias("a"), F.max(at).alias("b"))
            .select("udid", "app_key", F.col("a.sdkver").alias("first_sdkver"),
                    F.col("b.sdkver").alias("last_sdkver")))
