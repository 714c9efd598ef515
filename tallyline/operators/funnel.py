"""Ad and upgrade funnels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.clean import has_text
from tallyline.functions.dates import date_hour_columns, date_int
from tallyline.functions.packed import explode_packed
from tallyline.operators.merge import prefer_mobile
from tallyline.operators.skew import bucketed_lag

# Reply types of an ad in funnel order, and the columns of a send row.
REPLY_STAGES = {1: "show", 2: "click", 3: "install", 4: "close", 5: "uninstall"}
_SEND_COLUMNS = ["adkey", "adverid", "position", "app_key", "clnt", "city_id", "send_time"]


def ad_lifecycle(send: DataFrame, reply: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """One row per (adcode, udid) sent, with the earliest time of every later stage.

    Requests, replies and yesterday's state are stacked and aggregated once instead of being joined
    six times; replies without a request are dropped.
    """
    keys = ["adcode", "udid"]
    times = [f"{s}_time" for s in REPLY_STAGES.values()]
    sent = send.where(has_text("udid")).select(
        *keys, F.struct(F.col("createtime").alias("t"), "adkey", "adverid", "position",
                        F.col("apppkg").alias("app_key"), "clnt",
                        F.col("cityid").alias("city_id"),
                        F.col("createtime").alias("send_time")).alias("_send"))
    stages = [F.when(F.col("rtype") == k, F.col("createtime")).alias(f"{name}_time")
              for k, name in REPLY_STAGES.items()]
    replied = reply.where(has_text("udid") & F.col("rtype").isin(*REPLY_STAGES)).select(*keys, *stages)
    rows = sent.unionByName(replied, allowMissingColumns=True)
    if current is not None:
        stored = current.select(
            *keys, F.struct(F.col("send_time").alias("t"), *_SEND_COLUMNS).alias("_send"), *times)
        rows = rows.unionByName(stored, allowMissingColumns=True)
    return (rows.groupBy(*keys)
            .agg(F.min("_send").alias("_send"), *[F.min(t).alias(t) for t in times])
            .where(F.col("_send").isNotNull())
            .select(*keys, *[F.col(f"_send.{c}").alias(c) for c in _SEND_COLUMNS], *times))


def _packed_facts(rows: DataFrame, keys: list[str], count: str, extra: list[str]) -> DataFrame:
    """First event, last usable city, best link and first usable version per key."""
    at = F.col("create_time").alias("t")
    return (rows.groupBy(*keys)
            .agg(F.min(F.struct(at, *extra)).alias("_first"),
                 F.max(F.when(F.col("city_id") > 0, F.struct(at, "city_id"))).alias("_city"),
                 F.max("nettype").alias("nettype"),
                 F.min(F.when(has_text("version"), F.struct(at, "version"))).alias("_version"),
                 F.count("*").alias(count))
            .select(*keys, *[F.col(f"_first.{c}").alias(c) for c in extra],
                    date_int("_first.t").alias("create_date"),
                    F.hour("_first.t").alias("create_hour"),
                    F.col("_city.city_id").alias("city_id"), "nettype",
                    F.col("_version.version").alias("version"), count))


def ad_events(log: DataFrame, sent: DataFrame | None = None) -> dict[str, DataFrame]:
    """Facts ``send``, ``show``, ``click`` and ``install`` from packed ad lists.

    ``advids`` packs ``ad~res`` pairs, the other lists pack resource ids. Later stages carry ad and
    day of their send row; a (ad, device) already in ``sent`` keeps its stored row.
    """
    rows = log.where(has_text("androidid") & has_text("custom_id")).select(
        F.col("androidid").alias("device_id"), "create_time", "city_id",
        prefer_mobile("nettype").alias("nettype"), "version", "advids", "hisshow", "hisclick",
        "hisinstall")
    base = ["device_id", "create_time", "city_id", "nettype", "version"]
    pairs = explode_packed(rows.select(*base, "advids"), "advids", ("ad_id", "res_id"), inner="~")
    send = _packed_facts(pairs, ["ad_id", "device_id"], "send_count", ["res_id"])
    if sent is not None:
        fresh = send.join(sent.select("ad_id", "device_id"), ["ad_id", "device_id"], "left_anti")
        send = sent.select(*send.columns).unionByName(fresh)
    facts = {"send": send}
    carried = send.select("res_id", "device_id", "ad_id", F.col("create_date").alias("send_date"))
    for stage, packed in (("show", "hisshow"), ("click", "hisclick"), ("install", "hisinstall")):
        entries = explode_packed(rows.select(*base, packed), packed, "res_id")
        counted = _packed_facts(entries, ["res_id", "device_id"], f"{stage}_count", [])
        facts[stage] = (counted.join(carried, ["res_id", "device_id"])
                        .select("ad_id", "device_id", "send_date", "create_date", "create_hour",
                                "city_id", "nettype", "version", f"{stage}_count"))
    return facts


def api_ad_status(log: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """State of each (androidid, ad): 1 sent, 2 shown, 3 shown and clicked, with the latest dates.

    Stored state and log rows are stacked and aggregated once per key.
    """
    rows = log.where(has_text("androidid") & has_text("custom_id"))
    day = date_int("create_time")
    detail = ["apiurl", "clickurl", "custom_id", "imei", "title", "adtype"]
    keys = ["androidid", "ad_id"]
    send = rows.where(has_text("ids")).select(
        "androidid", F.col("ids").alias("ad_id"),
        F.struct(day.alias("create_date"), *detail).alias("_send"))
    show = explode_packed(rows.select("androidid", "apishow", day.alias("show_date")), "apishow", "ad_id")
    click = explode_packed(rows.select("androidid", "apiclick", day.alias("click_date")),
                           "apiclick", "ad_id")
    stacked = (send.unionByName(show, allowMissingColumns=True)
               .unionByName(click, allowMissingColumns=True))
    if current is not None:
        stored = current.select(
            *keys, F.struct("create_date", *detail).alias("_send"),
            F.when(F.col("ad_status") > 1, F.col("show_date")).alias("show_date"),
            F.when(F.col("ad_status") > 2, F.col("click_date")).alias("click_date"))
        stacked = stacked.unionByName(stored)
    merged = (stacked.groupBy(*keys)
              .agg(F.max("_send").alias("_send"), F.max("show_date").alias("show_date"),
                   F.max("click_date").alias("click_date"))
              .where(F.col("_send").isNotNull()))
    shown, clicked = F.col("show_date").isNotNull(), F.col("click_date").isNotNull()
    return merged.select(
        *keys, *[F.col(f"_send.{c}").alias(c) for c in detail],
        F.when(shown & clicked, 3).when(shown, 2).otherwise(1).alias("ad_status"),
        F.col("_send.create_date").alias("create_date"), "show_date",
        F.when(shown, F.col("click_date")).alias("click_date"))


def recent_ad_facts(mid: DataFrame, run_date: str, days: int = 30) -> DataFrame:
    """Lifecycle rows sent in the last ``days`` days, every time as a date and an hour column."""
    start = F.date_sub(F.lit(run_date).cast("date"), days).cast("timestamp")
    recent = mid.where(F.col("send_time") >= start)
    stages = ["send", *REPLY_STAGES.values()]
    return date_hour_columns(recent, {s: f"{s}_time" for s in stages})


def recent_upgrades(mid: DataFrame, clients: DataFrame, run_date: str, days: int = 60) -> DataFrame:
    """Upgrade rows pushed in the last ``days`` days with the channel of the client."""
    recent = mid.where(F.col("create_date") >= F.date_sub(F.lit(run_date).cast("date"), days))
    return (recent.join(clients.select("udid", "app_key", "clnt"), ["udid", "app_key"])
            .select("udid", "app_key", "version", "up_version",
                    date_int("create_date").alias("create_date"),
                    date_int("upgrade_date").alias("upgrade_date"), "clnt"))


def version_first_seen(current: DataFrame | None, log: DataFrame) -> DataFrame:
    """First time each (device, app, version) was used."""
    rows = (log.where(has_text("udid") & (F.length("appversion") <= 50))
            .select("udid", F.col("apppkg").alias("app_key"), F.col("appversion").alias("version"),
                    F.date_trunc("second", "createtime").alias("create_time")))
    if current is not None:
        rows = current.select(*rows.columns).unionByName(rows)
    return rows.groupBy("udid", "app_key", "version").agg(F.min("create_time").alias("create_time"))


def upgrade_log(log: DataFrame) -> DataFrame:
    """Distinct pushes: device, app, version before and after, day."""
    return (log.where(has_text("udid"))
            .select("udid", F.col("apppkg").alias("app_key"), F.col("appversion").alias("version"),
                    F.col("upversion").alias("up_version"),
                    F.to_date("createtime").alias("create_date")).distinct())


def version_steps(versions: DataFrame) -> DataFrame:
    """Consecutive versions of each device and app with the day of the step."""
    rows = versions.withColumn("_day", F.to_date("create_time"))
    stepped = bucketed_lag(rows, ["udid", "app_key"], ["create_time", "version"], "version", "_day",
                           "_before")
    return (stepped.where(F.col("_before").isNotNull())
            .select("udid", "app_key", F.col("_before").alias("version"),
                    F.col("version").alias("up_version"), F.col("_day").alias("upgrade_date")))


def upgrade_success(pushes: DataFrame, versions: DataFrame) -> DataFrame:
    """Earliest push of each version pair with the day the device really made that step."""
    keys = ["udid", "app_key", "version", "up_version"]
    earliest = pushes.groupBy(*keys).agg(F.min("create_date").alias("create_date"))
    return earliest.join(version_steps(versions), keys, "left")
