"""The given tables in the shapes of telemetry logs.

events joined with customer are the visits: a user is a device, the market segment its channel, the
nation its area; ``k`` of the properties gives every attribute that has to vary between visits.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Views:
    """Views of one scale-factor directory; every view is a lazy plan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def log(self) -> DataFrame:
        """event_id, ts, user_id, uid, event_type, value, k, version, channel, nation."""
        # props is one flat object with a whole number; a pattern costs a third of a JSON parse
        k = F.regexp_extract("props", r'"k"\s*:\s*(-?[0-9]+)', 1).try_cast("int")
        events = self.table("events").select(
            "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id",
            F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("uid"), "event_type", "value",
            k.alias("k"), F.concat(F.lit("v"), F.floor(k / 10).cast("string")).alias("version"))
        people = self.table("customer").select(F.col("c_custkey").alias("user_id"),
                                               F.col("c_mktsegment").alias("channel"),
                                               F.col("c_nationkey").alias("nation"))
        return events.join(people, "user_id")

    @cached_property
    def visit_ad(self) -> DataFrame:
        return self.log.select(
            F.col("uid").alias("aid"), F.col("channel").alias("channel_code"),
            F.concat(F.lit("a"), (F.col("k") % 10).cast("string")).alias("area"),
            F.concat(F.lit("10.0.0."), F.col("k").cast("string")).alias("ip"),
            F.col("ts").alias("create_time"))

    @cached_property
    def clients(self) -> DataFrame:
        """visit_fad rows in client shape; the event type is the app."""
        sdk = F.concat(F.lit("s"), F.col("k").cast("string"))
        return self.log.select(
            F.col("uid").alias("udid"), F.col("event_type").alias("app_key"),
            F.col("channel").alias("clnt"), "version", F.col("version").alias("init_version"),
            sdk.alias("sdkver"), sdk.alias("init_sdkver"), (F.col("k") % 6).alias("app_path"),
            F.col("ts").alias("create_time"), F.col("ts").alias("update_time"),
            F.date_format("ts", "yyyyMMdd").cast("int").alias("create_date"))

    @cached_property
    def visit_fad(self) -> DataFrame:
        """Raw rows with missing, empty and over-long keys, updated in another order than created."""
        k, n = F.col("k"), F.col("event_id")
        text = lambda p: F.concat(F.lit(p), k.cast("string"))
        return self.log.select(
            F.when(n % 11 == 0, None).when(n % 11 == 1, "").when(n % 11 == 2, F.repeat(F.lit("x"), 80)).otherwise(F.col("uid")).alias("udid"),
            text("d").alias("deviceid"), F.when(k % 3 == 0, "").when(k % 3 == 1, "NULL").otherwise(text("46000")).alias("imsi"),
            text("imei").alias("imei"), F.lit("v").alias("vender"), text("m").alias("model"), F.lit("9").alias("osVersion"),
            F.lit("android").alias("platform"), text("a").alias("androidid"), F.lit("op").alias("operator"),
            F.when(k % 4 == 0, "4G").when(k % 4 == 1, "Wifi").when(k % 4 == 2, "").otherwise("Unknown").alias("network"),
            F.lit("src").alias("src"), F.lit("mac").alias("mac"), F.col("event_type").alias("apppkg"),
            F.when(n % 13 == 0, F.repeat(F.lit("c"), 60)).otherwise(F.col("channel")).alias("clnt"),
            (k % 2).cast("string").alias("isroot"), (k % 3).cast("string").alias("gp"), F.lit("g").alias("gaid"),
            F.when(k % 5 == 0, "many").otherwise(k.cast("string")).alias("rom"), F.lit("en").alias("lang"),
            F.repeat(text("ua"), 80).alias("ua"), k.cast("string").alias("cityid"), F.lit("c").alias("country"),
            F.col("version").alias("appversion"), text("s").alias("sdkver"), (k % 8).cast("string").alias("path"),
            F.col("ts").alias("createtime"), F.timestamp_add("HOUR", k, F.col("ts")).alias("updatetime"))

    @cached_property
    def visit_sdk(self) -> DataFrame:
        """Raw sdk rows, some without a device."""
        k, n = F.col("k"), F.col("event_id")
        text = lambda p: F.concat(F.lit(p), k.cast("string"))
        plain = ("appkey", "platform", "imei", "androidid", "baseband", "language", "resolution", "modulename", "cpu", "devicename",
                 "osVersion", "cameras", "phoneno", "city", "region", "country")
        return self.log.select(
            F.when(n % 7 == 0, None).when(n % 7 == 1, "").otherwise(F.col("uid")).alias("uuid"), text("d").alias("deviceid"),
            F.col("channel").alias("customid"), F.when(k % 5 == 0, "4G").when(k % 5 == 1, "WIFI").otherwise("x").alias("network"),
            (k % 2).cast("string").alias("havaapn"), F.when(k % 4 == 0, "").when(k % 4 == 1, "null").otherwise(text("4600")).alias("imsi"),
            F.when(k % 2 == 0, text("mac")).alias("wifimac"), k.cast("long").alias("exttotalsize"), k.cast("long").alias("romtotalsize"),
            F.when(k % 2 == 0, "1").alias("uidtype"), F.col("ts").alias("createtime"), *[F.lit(c).alias(c) for c in plain])

    @cached_property
    def devices(self) -> DataFrame:
        """Device rows with unusable values among the good ones."""
        k = F.col("k")
        return self.log.select(
            F.col("uid").alias("udid"),
            F.when(k % 3 == 0, "").when(k % 3 == 1, "null")
            .otherwise(F.concat(F.lit("46000"), k.cast("string"))).alias("imsi"),
            F.concat(F.lit("m"), k.cast("string")).alias("model"),
            F.when(k % 7 == 0, "4G").when(k % 7 == 1, "3G").when(k % 7 == 2, "2G").when(k % 7 == 3, "Wifi")
            .when(k % 7 == 4, "GPRS").when(k % 7 == 5, "Unknown").otherwise("").alias("network"),
            F.col("channel").alias("clnt"), F.col("ts").alias("create_time"),
            F.col("ts").alias("update_time"))

    @cached_property
    def sdk_devices(self) -> DataFrame:
        k = F.col("k")
        text = lambda p: F.concat(F.lit(p), k.cast("string"))
        return self.log.select(
            F.col("uid").alias("uuid"), text("d").alias("device_id"),
            F.col("channel").alias("customer_id"),
            F.when(k % 5 == 0, "4G").when(k % 5 == 1, "2G").when(k % 5 == 2, "WIFI")
            .otherwise("none").alias("network"),
            (k == 7).cast("int").alias("have_vpn"),
            F.when(k % 4 == 0, "").when(k % 4 == 1, "NULL").otherwise(text("4600")).alias("imsi"),
            F.when(k % 2 == 0, text("mac")).alias("wifi_mac"),
            F.when(k % 9 == 0, text("139")).otherwise("null").alias("phone_no"),
            F.when(k % 3 == 0, "Unknown").otherwise(text("c")).alias("city"),
            F.when(k % 3 == 1, "unknown").otherwise(text("os")).alias("os_version"),
            (k - 20).cast("long").alias("rom_size"), F.lit(0).alias("isp_code"),
            F.col("ts").alias("create_time"), F.col("ts").alias("update_time"))

    @cached_property
    def rich(self) -> DataFrame:
        """visit_rich: views are timed reports (log type 2), everything else is user-driven."""
        k = F.col("k")
        return self.log.select(
            F.col("uid").alias("uuid"), F.lit("app").alias("appkey"), F.col("channel").alias("customid"),
            F.col("ts").alias("createtime"),
            F.timestamp_add("SECOND", (k - 50) * 60, F.col("ts")).alias("time"),
            F.floor(F.col("value") * 60000).cast("long").alias("boottime"), "version",
            k.cast("long").alias("extsizeleft"), (k * 2).cast("long").alias("romsizeleft"),
            (k * 2 - 10).alias("screenon"), k.alias("battery"),
            F.when(F.col("event_type") == "view", 2).otherwise(1).alias("logtype"),
            F.when(k % 4 == 0, "Unknown").otherwise(F.concat(F.lit("c"), k.cast("string"))).alias("city"),
            F.when(k % 4 == 1, "").otherwise(F.concat(F.lit("r"), k.cast("string"))).alias("region"),
            F.lit(None).cast("string").alias("country"),
            F.concat(F.lit("10.0.0."), k.cast("string")).alias("clientip"))

    @cached_property
    def using(self) -> DataFrame:
        """using_log: one session per user, day and hour."""
        return self.log.select(
            F.col("uid").alias("deviceid"), F.lit("app").alias("appkey"),
            F.concat(F.col("uid"), F.date_format("ts", "-yyyyMMddHH")).alias("session_id"),
            F.col("ts").alias("start_millis"), F.floor(F.col("value") * 100).cast("long").alias("duration"),
            "version")

    @cached_property
    def app_clients(self) -> DataFrame:
        """One client row per user of the single app of ``rich`` and ``using``."""
        first = F.min(F.struct("ts", "version", "channel"))
        return (self.log.groupBy(F.col("uid").alias("uuid")).agg(first.alias("f"))
                .select("uuid", F.lit("app").alias("app_key"), F.col("f.channel").alias("customer_id"),
                        F.col("f.version").alias("init_version"), F.col("f.ts").alias("create_time")))

    @cached_property
    def base_devices(self) -> DataFrame:
        """Devices of the base tables: first version, last version, channel, system, creation."""
        k = F.col("k")
        first = F.min(F.struct("ts", F.floor(k / 10).cast("int").alias("v"), "channel", (k % 2).alias("os")))
        last = F.max(F.struct("ts", F.floor(k / 10).cast("int").alias("v")))
        return (self.log.groupBy(F.col("uid").alias("uuid")).agg(first.alias("f"), last.alias("l"))
                .select("uuid", F.col("f.channel").alias("customer_id"), F.col("f.v").alias("apk_version"),
                        F.col("l.v").alias("update_version"), F.col("f.os").alias("os_type"),
                        F.col("f.ts").alias("create_time")))

    @cached_property
    def base_visits(self) -> DataFrame:
        k = F.col("k")
        return self.log.select(
            F.col("uid").alias("uuid"), F.col("channel").alias("customer_id"),
            F.floor(k / 10).cast("int").alias("apk_version"), (k % 2).alias("os_type"),
            F.col("ts").alias("create_time"))

    @cached_property
    def events(self) -> DataFrame:
        """event table: view/click are content clicks, purchase a share, signup a comment, error a
        search; ``k`` is the content id."""
        kind = F.col("event_type")
        return self.log.select(
            F.col("uid").alias("deviceid"),
            F.when(kind == "view", "recreate_click").when(kind == "click", "video_click")
            .when(kind == "purchase", "share").when(kind == "signup", "comments")
            .otherwise("search").alias("eventid"),
            F.col("k").cast("string").alias("acc"),
            ((F.col("event_id") % 3) + 1).cast("string").alias("label"), "version",
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("insertdate"),
            F.date_format("ts", "yyyy-MM-dd").alias("date"))

    @cached_property
    def channel_devices(self) -> DataFrame:
        """uuid and channel of every customer."""
        return self.table("customer").select(
            F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("uuid"),
            F.col("c_mktsegment").alias("customer_id"))
