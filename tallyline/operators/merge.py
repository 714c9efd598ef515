"""Current-state tables: fold new log rows into one row per user, client or device."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.clean import (clip_text, has_text, isp_code, normalize_flags, rank_network,
                                       require_non_empty, unrank_network)
from tallyline.functions.dates import date_int, day_gap
from tallyline.operators.fold import Policy, fold, fold_into, with_source
from tallyline.operators.skew import lookup

NEW_USER = Policy(first=("channel_code", "init_area", "init_ip", "create_time"),
                  last=("area", "ip", "update_time"))


def _merged(current: DataFrame | None, log: DataFrame, keys: Sequence[str], policy: Policy, co_located: bool) -> DataFrame:
    if co_located and current is not None:
        return fold_into(current, log, keys, policy)
    return fold(with_source(current, log), list(keys), policy)


def merge_new_users(current: DataFrame | None, log: DataFrame, co_located: bool = False) -> DataFrame:
    """One row per ``aid``: first channel, area, ip and time beside the latest area, ip and time.

    ``log`` holds aid, channel_code, area, ip, create_time; rows without aid, channel or time are
    dropped. Merging a log twice changes nothing, and the order of logs does not matter. In this and
    the following merges ``co_located`` says that ``current`` is stored by buckets of the key
    (``sinks.bucketed``) and shall be merged where it lies.
    """
    visits = log.select(
        "aid", "channel_code", F.col("area").alias("init_area"), "area",
        F.col("ip").alias("init_ip"), "ip", F.col("create_time").try_cast("timestamp").alias("create_time"),
        F.col("create_time").try_cast("timestamp").alias("update_time"))
    needed = ["aid", "channel_code", "create_time"]
    visits, current = visits.dropna(subset=needed), None if current is None else current.dropna(subset=needed)
    return _merged(current, visits, ["aid"], NEW_USER, co_located).withColumn("create_date", date_int("create_time"))


def merge_clients(current: DataFrame | None, log: DataFrame,
                  keys: Sequence[str] = ("udid", "app_key"),
                  last: Sequence[str] = ("version", "sdkver", "update_time"), co_located: bool = False) -> DataFrame:
    """One row per device and app: the latest ``last`` columns, the first of everything else. Rows
    without text in a key are no client's and are dropped."""
    log = require_non_empty(log, keys)
    latest = tuple(c for c in last if c in log.columns)
    first = tuple(c for c in log.columns if c not in keys and c not in latest)
    return _merged(current, log, keys, Policy(first=first, last=latest), co_located)


def client_flags(df: DataFrame, as_of: str) -> DataFrame:
    """Add is_upgrade (version changed) and is_silent (old client last seen in its first days)."""
    quiet = ((day_gap(F.lit(as_of).cast("date"), "create_time") >= 3)
             & (day_gap("update_time", "create_time") <= 1))
    return df.withColumns({
        "is_upgrade": F.when(F.col("version") != F.col("init_version"), 1).otherwise(0),
        "is_silent": F.when(quiet, 1).otherwise(0),
    })


def merge_devices(current: DataFrame | None, log: DataFrame, key: str = "udid",
                  style: str = "fad", known: Sequence[str] = ("imsi",),
                  flags: Sequence[str] = (), co_located: bool = False) -> DataFrame:
    """One row per device: first usable ``known`` values, best network, highest ``flags``, latest
    update time, the first of everything else.

    Rows without text in the key are no device's and are dropped. ``min``/``max`` aggregates combine
    before the shuffle, so this is at once the plain fold and its pairwise, order-free variant.
    """
    log = require_non_empty(log, [key]).withColumn("network", rank_network("network", style))
    current = None if current is None else current.withColumn("network", rank_network("network", style))
    named = {key, "network", "update_time", *known, *flags}
    first = tuple(c for c in log.columns if c not in named)
    policy = Policy(first=first, last=("update_time",), first_known=tuple(known),
                    highest=("network", *flags), unknown=("null",))
    return _merged(current, log, [key], policy, co_located).withColumn("network", unrank_network("network"))


def merge_devices_sdk(current: DataFrame | None, log: DataFrame, co_located: bool = False) -> DataFrame:
    """Device fold of the sdk logs: sticky vpn flag, first usable imsi, mac and phone number, and
    the operator code of the surviving imsi (the stored code where the imsi gives none)."""
    merged = merge_devices(current, log, key="uuid", style="sdk",
                           known=("imsi", "wifi_mac", "phone_no"), flags=("have_vpn",), co_located=co_located)
    return merged.withColumn("isp_code", F.coalesce(isp_code("imsi"), F.col("isp_code"), F.lit(0)))


def merge_devices_rich(current: DataFrame | None, log: DataFrame, keys: Sequence[str],
                       policy: Policy, network: str | None = None,
                       style: str = "sdk", co_located: bool = False) -> DataFrame:
    """Device fold with a policy per column; ``network`` names a text column folded by rank."""
    if network:
        rank = lambda df: df.withColumn(network, rank_network(network, style))
        log, current = rank(log), None if current is None else rank(current)
    merged = _merged(current, log, keys, policy, co_located)
    return merged.withColumn(network, unrank_network(network)) if network else merged


# Column policies of the two rich device tables.
SDK_DEVICE = Policy(
    first=("customer_id", "create_time"), last=("device_id", "update_time"),
    last_known=("os_version",), highest=("network", "have_vpn"),
    first_known=("platform", "imsi", "wifi_mac", "imei", "android_id", "baseband", "language",
                 "resolution", "model_name", "cpu", "device_name", "cameras", "sdcard_size",
                 "rom_size", "phone_no", "city", "region", "country", "uuid_type", "isp_code"))
AD_DEVICE = Policy(
    first=("custom_id", "init_version", "create_time"), last=("update_time",),
    last_known=("brand", "city_id", "imei", "imsi", "mac", "model", "rom", "sdcard", "src",
                "sysver", "version", "app_path", "is_root"),
    highest=("nettype",), unknown=("null",))


def prefer_mobile(nettype: str):
    """Link code with 1 and 2 swapped, so that the maximum prefers mobile links."""
    c = F.col(nettype)
    return F.when(c == 1, 2).when(c == 2, 1).otherwise(c)


def merge_app_versions(current: DataFrame | None, log: DataFrame) -> DataFrame:
    """Per device: first attributes, the present app version and the day it was first seen.

    ``current`` has uuid, username, customer_id, init_app_version, app_version, os_type,
    activate_date, update_date; ``log`` has uuid, username, customer_id, app_version, os_type,
    visit_time. The day of the last change is found from the latest visit of every version on every
    day, so that a hot device is reduced to its versions and days before it meets one task.
    """
    first = ["username", "customer_id", "init_app_version", "os_type", "activate_date"]
    visits = log.where(has_text("uuid")).select(
        "uuid", "username", "customer_id", F.col("app_version").alias("init_app_version"),
        "app_version", "os_type", F.to_date("visit_time").alias("activate_date"),
        F.col("visit_time").cast("timestamp").alias("_seen"), F.lit(1).alias("_source"))
    rows = visits
    if current is not None:
        stored = current.withColumns({"_seen": F.col("update_date").cast("timestamp"),
                                      "_source": F.lit(0)})
        rows = stored.select(*visits.columns).unionByName(visits)
    days = rows.groupBy("uuid", "app_version", F.to_date("_seen").alias("_day")).agg(
        F.max(F.struct("_seen", "_source", "app_version")).alias("_late"),
        F.min(F.struct("_seen", "_source", *first)).alias("_early"))
    device = Window.partitionBy("uuid")
    present = days.withColumn("_last", F.max("_late").over(device))
    same = F.col("app_version") == F.col("_last.app_version")
    ended = present.withColumn("_other", F.max(F.when(~same, F.col("_late"))).over(device))
    since = same & (F.col("_other").isNull() | (F.col("_late") > F.col("_other")))
    return (ended.groupBy("uuid")
            .agg(F.min("_early").alias("_first"), F.max("_last.app_version").alias("app_version"),
                 F.min(F.when(since, F.col("_day"))).alias("update_date"))
            .select("uuid", *[F.col(f"_first.{c}").alias(c) for c in first[:3]], "app_version",
                    *[F.col(f"_first.{c}").alias(c) for c in first[3:]], "update_date"))


def refresh_devices(current: DataFrame, changed: DataFrame) -> DataFrame:
    """Rebuild the rows of changed devices; flags found by earlier runs are kept.

    ``changed`` is the source device table (uid, isrepeat, createtime, updatetime, clt, vi,
    updatevi, originalstatus, changedstatus, aid, ms, opt). The stored customer wins over the log.
    """
    rebuilt = changed.select(
        F.col("uid").alias("uuid"), F.col("isrepeat").alias("is_repeated"),
        F.col("createtime").alias("create_time"), F.col("updatetime").alias("update_time"),
        F.col("clt").alias("_customer"), F.col("vi").alias("init_app_version"),
        F.when(F.coalesce(F.col("updatevi"), F.lit(0)) == 0, F.col("vi"))
        .otherwise(F.col("updatevi")).alias("app_version"),
        F.col("originalstatus").alias("original_status"),
        F.col("changedstatus").alias("changed_status"), F.col("aid").alias("android_id"),
        F.col("ms").alias("imsi"), date_int("createtime").alias("install_date"),
        F.coalesce(F.col("opt"), F.lit(0)).alias("isp_code"),
        F.when((F.col("updatevi") != F.col("vi")) & (F.col("updatevi") > 0), 1)
        .otherwise(0).alias("is_upgraded"))
    kept = current.select("uuid", "customer_id", "aid_status", "imsi_status", "is_activated",
                          "activate_date")
    joined = rebuilt.join(kept, "uuid", "left")
    flags = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("aid_status", "imsi_status",
                                                         "is_activated")}
    return (joined.withColumn("customer_id", F.coalesce("customer_id", "_customer"))
            .withColumns(flags).drop("_customer"))


def flag_known_ids(df: DataFrame, old_ids: DataFrame, registered: DataFrame,
                   id_col: str = "android_id", key: str = "uuid") -> DataFrame:
    """Add is_exists (``id_col`` found in ``old_ids``) and is_registered (``key`` in
    ``registered``). A shared id such as a factory default may fill most rows."""
    seen = old_ids.where(has_text(id_col)).select(id_col).distinct().withColumn("is_exists", F.lit(1))
    listed = registered.select(key).distinct().withColumn("is_registered", F.lit(1))
    found = lookup(df, seen, id_col).join(listed, key, "left")
    return found.fillna(0, subset=["is_exists", "is_registered"])


def update_dimension(values: DataFrame, col: str, current: DataFrame | None = None) -> DataFrame:
    """Distinct non-empty values of ``col`` as ``id``; with ``current`` only the unseen ones."""
    ids = values.where(has_text(col)).select(F.col(col).alias("id")).distinct()
    return ids if current is None else ids.join(current.select("id"), "id", "left_anti")


# Columns of the visit logs and of the tables they are merged into, here and below.
def fad_device_log(log: DataFrame) -> DataFrame:
    """visit_fad rows in the shape of the device table. Rows whose device id is missing or longer
    than 64, or whose channel or version is missing or longer than 50, are not usable."""
    usable = require_non_empty(log, ["udid"], {"udid": 64, "clnt": 50, "appversion": 50})
    return normalize_flags(usable).select(
        "udid", "deviceid", "imsi", "imei", "vender", "model", F.col("osVersion").alias("os_version"),
        "platform", F.col("androidid").alias("android_id"), "operator", "network", "src", "mac",
        F.col("apppkg").alias("app_key"), "clnt", F.col("isroot").alias("is_root"),
        F.col("gp").alias("has_gplay"), "gaid", F.col("rom").try_cast("long").alias("rom"), "lang",
        clip_text("ua", 200).alias("ua"), F.col("cityid").try_cast("long").alias("city_id"),
        "country", F.col("createtime").alias("create_time"), F.col("updatetime").alias("update_time"))


def fad_client_log(log: DataFrame, full: bool = False) -> DataFrame:
    """visit_fad rows in the shape of the client table, usable ones as for the device table.
    ``full``, for loading a whole history, also asks for an app, a channel and a version."""
    needed = ["udid", *(("apppkg", "clnt", "appversion") if full else ())]
    usable = require_non_empty(log, needed, {"udid": 64, "clnt": 50, "appversion": 50})
    sdk = clip_text("sdkver", 50)
    return normalize_flags(usable).select(
        "udid", F.col("apppkg").alias("app_key"), "clnt", F.col("appversion").alias("version"),
        F.col("appversion").alias("init_version"), sdk.alias("sdkver"), sdk.alias("init_sdkver"),
        F.col("path").alias("app_path"), F.col("createtime").alias("create_time"),
        F.col("updatetime").alias("update_time"), date_int("createtime").alias("create_date"))


def sdk_device_log(log: DataFrame) -> DataFrame:
    """visit_sdk rows in the shape of the device table; rows without a device id are not usable."""
    return normalize_flags(require_non_empty(log, ["uuid"])).select(
        "uuid", F.col("deviceid").alias("device_id"), F.col("appkey").alias("app_key"),
        F.col("customid").alias("customer_id"), "network", "platform", F.col("havaapn").alias("have_vpn"), "imsi",
        F.col("wifimac").alias("wifi_mac"), "imei", F.col("androidid").alias("android_id"),
        "baseband", "language", "resolution", F.col("modulename").alias("model_name"), "cpu",
        F.col("devicename").alias("device_name"), F.col("osVersion").alias("os_version"), "cameras",
        F.col("exttotalsize").alias("sdcard_size"), F.col("romtotalsize").alias("rom_size"),
        F.col("phoneno").alias("phone_no"), "city", "region", "country",
        F.col("uidtype").try_cast("int").alias("uuid_type"), F.lit(0).alias("isp_code"),
        F.col("createtime").alias("create_time"), F.col("createtime").alias("update_time"))
