"""Queries for merges, activity and sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.catalog.registry import day_int, query, ts_text
from tallyline.operators import activity, merge
from tallyline.operators.fold import Policy
from tallyline.session import scratch
from tallyline.sinks import bucketed

_FIRST_LAST = """f AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS a,
  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS z FROM log),
b AS (SELECT x.*, y.ts AS last_ts, y.k AS last_k, y.version AS last_version
      FROM f x JOIN f y ON x.user_id = y.user_id AND x.a = 1 AND y.z = 1)"""

NEW_USERS_SQL = _FIRST_LAST + f"""
SELECT uid AS aid, channel AS channel_code, 'a' || (k % 10) AS init_area, 'a' || (last_k % 10) AS area,
  '10.0.0.' || k AS init_ip, '10.0.0.' || last_k AS ip, {ts_text('ts')} AS create_time,
  {ts_text('last_ts')} AS update_time, {day_int('ts')} AS create_date FROM b"""


@query("merge_new_users", NEW_USERS_SQL)
def merge_new_users(v):
    """A stored table of the first half, then a log that overlaps it."""
    log = v.visit_ad
    stored = merge.merge_new_users(None, log.where("create_time < '2024-01-16'"))
    return merge.merge_new_users(stored, log.where("create_time >= '2024-01-11'"))


_CLIENTS = """f AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS a,
  row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS z FROM log),
b AS (SELECT x.*, y.ts AS last_ts, y.k AS last_k, y.version AS last_version FROM f x JOIN f y
      ON x.user_id = y.user_id AND x.event_type = y.event_type AND x.a = 1 AND y.z = 1)"""


@query("merge_clients", _CLIENTS + f"""
SELECT uid AS udid, event_type AS app_key, channel AS clnt, last_version AS version, version AS init_version,
  's' || last_k AS sdkver, 's' || k AS init_sdkver, k % 6 AS app_path, {ts_text('ts')} AS create_time,
  {ts_text('last_ts')} AS update_time, {day_int('ts')} AS create_date FROM b""")
def merge_clients(v):
    """A stored table of the first half, then the second half as a log."""
    stored = merge.merge_clients(None, v.clients.where("create_time < '2024-01-16'"))
    return merge.merge_clients(stored, v.clients.where("create_time >= '2024-01-16'"))


def _in_buckets(v, runs, step, keys):
    """A state table kept by buckets through several runs."""
    path = scratch(v.spark, "state")
    for log in runs:
        table = bucketed.update_bucketed(v.spark, path, log, step, keys, 8)
    return table


@query("merge_new_users_bucketed", NEW_USERS_SQL)
def merge_new_users_bucketed(v):
    """Three logs, of which the last is an old one that comes again."""
    log = v.visit_ad
    runs = [log.where("create_time < '2024-01-16'"), log.where("create_time >= '2024-01-11'"), log.where("create_time < '2024-01-03'")]
    return _in_buckets(v, runs, merge.merge_new_users, ["aid"])


@query("merge_clients_bucketed", _CLIENTS + f"""
SELECT uid AS udid, event_type AS app_key, channel AS clnt, last_version AS version, version AS init_version,
  's' || last_k AS sdkver, 's' || k AS init_sdkver, k % 6 AS app_path, {ts_text('ts')} AS create_time,
  {ts_text('last_ts')} AS update_time, {day_int('ts')} AS create_date FROM b""")
def merge_clients_bucketed(v):
    """A table with a key of two columns; the late half comes first."""
    runs = [v.clients.where("create_time >= '2024-01-16'"), v.clients.where("create_time < '2024-01-16'")]
    return _in_buckets(v, runs, merge.merge_clients, ["udid", "app_key"])


@query("client_flags", _CLIENTS + f"""
SELECT uid AS udid, event_type AS app_key, last_version AS version, version AS init_version,
  CASE WHEN last_version <> version THEN 1 ELSE 0 END AS is_upgrade,
  CASE WHEN date_diff('day', CAST(ts AS DATE), DATE '2024-01-31') >= 3
        AND date_diff('day', CAST(ts AS DATE), CAST(last_ts AS DATE)) <= 1 THEN 1 ELSE 0 END AS is_silent
FROM b""")
def client_flags(v):
    merged = merge.merge_clients(None, v.clients)
    return merge.client_flags(merged, "2024-01-31").select("udid", "app_key", "version", "init_version",
                                                           "is_upgrade", "is_silent")


_DEVICE_SQL = _FIRST_LAST + f""",
n AS (SELECT user_id, max(CASE WHEN k % 7 = 0 THEN '4G' WHEN k % 7 = 1 THEN '3G' WHEN k % 7 = 2 THEN '2G'
        WHEN k % 7 = 3 THEN '0WIFI' WHEN k % 7 = 4 THEN '1GPRS' ELSE '-Unknown' END) AS net,
        min(ts) FILTER (k % 3 = 2) AS imsi_ts FROM log GROUP BY user_id)
SELECT b.uid AS udid, CASE WHEN l.k IS NOT NULL THEN '46000' || l.k END AS imsi, 'm' || b.k AS model,
  CASE WHEN net < '2' THEN substr(net, 2) ELSE net END AS network, b.channel AS clnt,
  {ts_text('b.ts')} AS create_time, {ts_text('b.last_ts')} AS update_time
FROM b JOIN n ON b.user_id = n.user_id LEFT JOIN log l ON l.user_id = n.user_id AND l.ts = n.imsi_ts"""


@query("merge_devices", _DEVICE_SQL)
def merge_devices(v):
    return merge.merge_devices(None, v.devices)


@query("merge_devices_commutative", _DEVICE_SQL)
def merge_devices_commutative(v):
    """The late half is stored first and the early half arrives afterwards."""
    late = merge.merge_devices(None, v.devices.where("create_time >= '2024-01-10'"))
    return merge.merge_devices(late, v.devices.where("create_time < '2024-01-10'"))


@query("merge_devices_bucketed", _DEVICE_SQL)
def merge_devices_bucketed(v):
    runs = [v.devices.where("create_time >= '2024-01-10'"), v.devices.where("create_time < '2024-01-10'")]
    return _in_buckets(v, runs, merge.merge_devices, ["udid"])


_SDK_SQL = _FIRST_LAST + f""",
n AS (SELECT user_id, max(CASE WHEN k % 5 = 0 THEN '4G' WHEN k % 5 = 1 THEN '2G' WHEN k % 5 = 2 THEN '1WIFI'
        ELSE '0Unknown' END) AS net, max(CASE WHEN k = 7 THEN 1 ELSE 0 END) AS vpn,
        arg_min(k, ts) FILTER (k % 4 >= 2) AS imsi_k, arg_min(k, ts) FILTER (k % 2 = 0) AS mac_k,
        arg_min(k, ts) FILTER (k % 9 = 0) AS phone_k FROM log GROUP BY user_id)
SELECT b.uid AS uuid, 'd' || b.k AS device_id, b.channel AS customer_id,
  CASE WHEN net < '2' THEN substr(net, 2) ELSE net END AS network, vpn AS have_vpn,
  '4600' || imsi_k AS imsi, 'mac' || mac_k AS wifi_mac, '139' || phone_k AS phone_no,
  coalesce(CASE WHEN length('4600' || imsi_k) >= 5 THEN CAST(substr('4600' || imsi_k, 1, 5) AS INTEGER) END, 0)
    AS isp_code, {ts_text('b.ts')} AS create_time, {ts_text('b.last_ts')} AS update_time
FROM b JOIN n ON b.user_id = n.user_id"""
_SDK_COLUMNS = ["uuid", "device_id", "customer_id", "network", "have_vpn", "imsi", "wifi_mac", "phone_no", "isp_code", "create_time", "update_time"]


def _sdk_halves(v):
    rows = v.sdk_devices.drop("city", "os_version", "rom_size")
    return rows.where("create_time < '2024-01-16'"), rows.where("create_time >= '2024-01-16'")


@query("merge_devices_sdk", _SDK_SQL)
def merge_devices_sdk(v):
    early, late = _sdk_halves(v)
    return merge.merge_devices_sdk(merge.merge_devices_sdk(None, early), late).select(_SDK_COLUMNS)


@query("merge_devices_sdk_bucketed", _SDK_SQL)
def merge_devices_sdk_bucketed(v):
    return _in_buckets(v, _sdk_halves(v), merge.merge_devices_sdk, ["uuid"]).select(_SDK_COLUMNS)


RICH_POLICY = Policy(first=("customer_id", "create_time"), last=("device_id", "update_time"),
                     last_known=("os_version",), highest=("network", "have_vpn"),
                     first_known=("imsi", "wifi_mac", "phone_no", "city", "rom_size"))


_RICH_SQL = _FIRST_LAST + f""",
n AS (SELECT user_id, max(CASE WHEN k % 5 = 0 THEN '4G' WHEN k % 5 = 1 THEN '2G' WHEN k % 5 = 2 THEN '1WIFI'
        ELSE '0Unknown' END) AS net, max(CASE WHEN k = 7 THEN 1 ELSE 0 END) AS vpn,
        arg_min(k, ts) FILTER (k % 4 >= 2) AS imsi_k, arg_min(k, ts) FILTER (k % 2 = 0) AS mac_k,
        arg_min(k, ts) FILTER (k % 9 = 0) AS phone_k, arg_min(k, ts) FILTER (k % 3 > 0) AS city_k,
        arg_max(k, ts) FILTER (k % 3 <> 1) AS os_k, arg_min(k, ts) FILTER (k > 20) AS rom_k
      FROM log GROUP BY user_id)
SELECT b.uid AS uuid, b.channel AS customer_id, 'd' || b.last_k AS device_id,
  CASE WHEN net < '2' THEN substr(net, 2) ELSE net END AS network, vpn AS have_vpn,
  '4600' || imsi_k AS imsi, 'mac' || mac_k AS wifi_mac, '139' || phone_k AS phone_no, 'c' || city_k AS city,
  'os' || os_k AS os_version, CAST(rom_k - 20 AS BIGINT) AS rom_size, {ts_text('b.ts')} AS create_time,
  {ts_text('b.last_ts')} AS update_time FROM b JOIN n ON b.user_id = n.user_id"""


@query("merge_devices_rich_bucketed", _RICH_SQL)
def merge_devices_rich_bucketed(v):
    rows = v.sdk_devices.drop("isp_code")

    def step(stored, log, co_located=False):
        return merge.merge_devices_rich(stored, log, ["uuid"], RICH_POLICY, network="network", co_located=co_located)
    return _in_buckets(v, [rows.where("create_time >= '2024-01-16'"), rows.where("create_time < '2024-01-16'")], step, ["uuid"])


@query("merge_devices_rich", _RICH_SQL)
def merge_devices_rich(v):
    rows = v.sdk_devices.drop("isp_code")
    stored = merge.merge_devices_rich(None, rows.where("create_time < '2024-01-16'"), ["uuid"], RICH_POLICY, network="network")
    return merge.merge_devices_rich(stored, rows.where("create_time >= '2024-01-16'"), ["uuid"], RICH_POLICY, network="network")


@query("merge_app_versions", _FIRST_LAST + """,
s AS (SELECT user_id, ts, version, lag(version) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM log),
c AS (SELECT user_id, max(CAST(ts AS DATE)) AS changed FROM s WHERE before IS NULL OR before <> version
      GROUP BY user_id)
SELECT uid AS uuid, 'name' || b.user_id AS username, channel AS customer_id, version AS init_app_version,
  last_version AS app_version, k % 2 AS os_type, strftime(ts, '%Y-%m-%d') AS activate_date,
  strftime(changed, '%Y-%m-%d') AS update_date FROM b JOIN c ON b.user_id = c.user_id""")
def merge_app_versions(v):
    log = v.log.select(F.col("uid").alias("uuid"),
                       F.concat(F.lit("name"), F.col("user_id").cast("string")).alias("username"),
                       F.col("channel").alias("customer_id"), F.col("version").alias("app_version"),
                       (F.col("k") % 2).alias("os_type"), F.col("ts").alias("visit_time"))
    stored = merge.merge_app_versions(None, log.where("visit_time < '2024-01-16'"))
    return merge.merge_app_versions(stored, log.where("visit_time >= '2024-01-16'"))


# Raw rows whose keys the merges accept; the creation and the update time order them differently.
_RAW = """r AS (SELECT *, ts + INTERVAL 1 HOUR * k AS up FROM log WHERE event_id % 11 > 2 AND event_id % 13 <> 0)"""


@query("raw_client_merge", _RAW + f"""
SELECT uid AS udid, event_type AS app_key, arg_min(channel, ts) AS clnt, arg_max(version, up) AS version, arg_min(version, ts) AS init_version,
  's' || arg_max(k, up) AS sdkver, 's' || arg_min(k, ts) AS init_sdkver,
  arg_min(CASE WHEN k % 8 BETWEEN 1 AND 5 THEN k % 8 ELSE 0 END, ts) AS app_path, {ts_text('min(ts)')} AS create_time,
  {ts_text('max(up)')} AS update_time, {day_int('min(ts)')} AS create_date FROM r GROUP BY uid, event_type""")
def raw_client_merge(v):
    """From raw log to client table, in two runs."""
    log = v.visit_fad
    stored = merge.merge_clients(None, merge.fad_client_log(log.where("createtime < '2024-01-16'")))
    return merge.merge_clients(stored, merge.fad_client_log(log.where("createtime >= '2024-01-16'"), full=True))


@query("raw_device_merge", _RAW + f"""
SELECT uid AS udid, '46000' || arg_min(k, ts) FILTER (k % 3 = 2) AS imsi, 'm' || arg_min(k, ts) AS model, arg_min(channel, ts) AS clnt,
  CASE max(CASE WHEN k % 4 = 0 THEN 3 WHEN k % 4 = 1 THEN 2 ELSE 1 END) WHEN 3 THEN '4G' WHEN 2 THEN 'WIFI' ELSE 'Unknown' END AS network,
  CASE WHEN arg_min(k, ts) % 2 = 1 THEN 1 ELSE 2 END AS is_root, CASE WHEN arg_min(k, ts) % 3 = 1 THEN 1 ELSE 2 END AS has_gplay,
  arg_min(CASE WHEN k % 5 = 0 THEN -1 ELSE k END, ts) AS rom, substr(repeat('ua' || arg_min(k, ts), 80), 1, 200) AS ua,
  {ts_text('min(ts)')} AS create_time, {ts_text('max(up)')} AS update_time FROM r GROUP BY uid""")
def raw_device_merge(v):
    """From raw log to device table, the late half first."""
    log = v.visit_fad
    late = merge.merge_devices(None, merge.fad_device_log(log.where("createtime >= '2024-01-16'")))
    merged = merge.merge_devices(late, merge.fad_device_log(log.where("createtime < '2024-01-16'")))
    return merged.select("udid", "imsi", "model", "clnt", "network", "is_root", "has_gplay", F.coalesce("rom", F.lit(-1)).alias("rom"), "ua",
                         "create_time", "update_time")


@query("raw_sdk_merge", f"""
r AS (SELECT * FROM log WHERE event_id % 7 > 1)
SELECT uid AS uuid, 'd' || arg_min(k, ts) AS device_id, arg_min(channel, ts) AS customer_id, max(k % 2) AS have_vpn,
  CASE max(CASE WHEN k % 5 = 0 THEN 3 WHEN k % 5 = 1 THEN 2 ELSE 1 END) WHEN 3 THEN '4G' WHEN 2 THEN 'WIFI' ELSE 'Unknown' END AS network,
  '4600' || arg_min(k, ts) FILTER (k % 4 > 1) AS imsi, 'mac' || arg_min(k, ts) FILTER (k % 2 = 0) AS wifi_mac,
  coalesce(CASE WHEN length('4600' || arg_min(k, ts) FILTER (k % 4 > 1)) >= 5
    THEN CAST(substr('4600' || arg_min(k, ts) FILTER (k % 4 > 1), 1, 5) AS INTEGER) END, 0) AS isp_code,
  {ts_text('min(ts)')} AS create_time, {ts_text('max(ts)')} AS update_time FROM r GROUP BY uid""")
def raw_sdk_merge(v):
    log = v.visit_sdk
    stored = merge.merge_devices_sdk(None, merge.sdk_device_log(log.where("createtime < '2024-01-16'")))
    merged = merge.merge_devices_sdk(stored, merge.sdk_device_log(log.where("createtime >= '2024-01-16'")))
    return merged.select("uuid", "device_id", "customer_id", "have_vpn", "network", "imsi", "wifi_mac", "isp_code", "create_time", "update_time")


def _refresh_inputs(v):
    c = v.table("customer")
    uid = F.concat(F.lit("u"), F.col("c_custkey").cast("string"))
    n = F.col("c_nationkey")
    changed = c.select(
        uid.alias("uid"), F.lit(0).alias("isrepeat"),
        F.date_add(F.lit("2024-01-01").cast("date"), n).cast("timestamp").alias("createtime"),
        F.lit("2024-02-01").cast("timestamp").alias("updatetime"), F.col("c_mktsegment").alias("clt"),
        (n % 4).alias("vi"), F.when(n % 3 > 0, n % 3).alias("updatevi"), F.lit("A").alias("originalstatus"),
        F.lit("").alias("changedstatus"), F.concat(F.lit("n"), n.cast("string")).alias("aid"),
        F.lit("").alias("ms"), F.when(n > 5, n).alias("opt"))
    orders = v.table("orders").groupBy("o_custkey").agg(F.max("o_orderpriority").alias("p"),
                                                        F.count("*").alias("n"))
    current = orders.select(
        F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("uuid"),
        F.when(F.col("n") > 8, F.col("p")).alias("customer_id"),
        (F.col("n") % 2).cast("int").alias("aid_status"), F.lit(0).alias("imsi_status"),
        F.lit(1).alias("is_activated"), F.lit("2024-01-05").cast("date").alias("activate_date"))
    return current, changed


@query("refresh_devices", f"""
o AS (SELECT o_custkey, max(o_orderpriority) AS p, count(*) AS n FROM orders GROUP BY o_custkey),
c AS (SELECT *, CAST(DATE '2024-01-01' + c_nationkey AS TIMESTAMP) AS born, c_nationkey % 4 AS vi,
        CASE WHEN c_nationkey % 3 > 0 THEN c_nationkey % 3 END AS uv FROM customer)
SELECT 'u' || c_custkey AS uuid, 0 AS is_repeated, {ts_text('born')} AS create_time,
  '2024-02-01 00:00:00.000000' AS update_time, vi AS init_app_version, coalesce(uv, vi) AS app_version,
  'A' AS original_status, '' AS changed_status, 'n' || c_nationkey AS android_id, '' AS imsi,
  {day_int('born')} AS install_date, CASE WHEN c_nationkey > 5 THEN c_nationkey ELSE 0 END AS isp_code,
  CASE WHEN uv <> vi AND uv > 0 THEN 1 ELSE 0 END AS is_upgraded,
  coalesce(CASE WHEN n > 8 THEN p END, c_mktsegment) AS customer_id, coalesce(n % 2, 0) AS aid_status,
  0 AS imsi_status, CASE WHEN n IS NULL THEN 0 ELSE 1 END AS is_activated,
  CASE WHEN n IS NOT NULL THEN '2024-01-05' END AS activate_date
FROM c LEFT JOIN o ON o_custkey = c_custkey""", log=False)
def refresh_devices(v):
    return merge.refresh_devices(*_refresh_inputs(v))


@query("flag_known_ids", """
SELECT 'u' || c_custkey AS uuid, 'n' || c_nationkey AS android_id,
  CASE WHEN c_nationkey IN (SELECT s_nationkey FROM supplier) THEN 1 ELSE 0 END AS is_exists,
  CASE WHEN c_custkey IN (SELECT user_id FROM events) THEN 1 ELSE 0 END AS is_registered FROM customer""",
       log=False)
def flag_known_ids(v):
    nation = lambda c: F.concat(F.lit("n"), F.col(c).cast("string")).alias("android_id")
    df = v.table("customer").select(F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("uuid"),
                                    nation("c_nationkey"))
    old = v.table("supplier").select(nation("s_nationkey"))
    registered = v.table("events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("uuid"))
    return merge.flag_known_ids(df, old, registered)


@query("update_dimension", """
SELECT DISTINCT version || '-' || event_type AS id FROM log WHERE version || '-' || event_type NOT IN
  (SELECT version || '-' || event_type FROM log WHERE ts < TIMESTAMP '2024-01-01 06:00:00')""")
def update_dimension(v):
    values = v.log.select("ts", F.concat_ws("-", "version", "event_type").alias("name"))
    current = merge.update_dimension(values.where("ts < '2024-01-01 06:00:00'"), "name")
    return merge.update_dimension(values, "name", current)


_ACTIVE_SQL = f"""a AS (SELECT user_id, CAST(ts AS DATE) AS d, arg_min(k, ts) AS k, count(*) AS n
  FROM log GROUP BY ALL),
u AS (SELECT user_id, arg_min(channel, ts) AS channel, min(CAST(ts AS DATE)) AS born, any_value(uid) AS uid
  FROM log GROUP BY user_id)"""
DAILY_ACTIVE_SQL = _ACTIVE_SQL + f"""
SELECT uid AS aid, {day_int('d')} AS active_date, 'a' || (k % 10) AS area, n AS visit_times,
  channel AS channel_code, {day_int('born')} AS create_date, date_diff('day', born, d) AS date_diff
FROM a JOIN u USING (user_id)"""


@query("daily_active", DAILY_ACTIVE_SQL)
def daily_active(v):
    return activity.daily_active(v.visit_ad, merge.merge_new_users(None, v.visit_ad))


@query("daily_active_by_log_type", f"""
a AS (SELECT uid, event_type, k % 3 AS log_type, CAST(ts AS DATE) AS d, arg_min(version, ts) AS version,
  arg_min(nation, ts) AS nation, count(*) AS n FROM log GROUP BY ALL),
c AS (SELECT uid, event_type, arg_min(channel, ts) AS clnt, arg_min(version, ts) AS init_version,
  min(CAST(ts AS DATE)) AS born FROM log GROUP BY ALL)
SELECT uid AS udid, event_type AS app_key, log_type, {day_int('d')} AS active_date, version,
  nation AS city_id, n AS visit_times, clnt, init_version, {day_int('born')} AS create_date,
  date_diff('day', born, d) AS date_diff FROM a JOIN c USING (uid, event_type)""")
def daily_active_by_log_type(v):
    log = v.log.select(F.col("uid").alias("udid"), F.col("event_type").alias("app_key"),
                       (F.col("k") % 3).alias("log_type"), "version", F.col("nation").alias("city_id"),
                       F.col("ts").alias("create_time"))
    return activity.daily_active(log, merge.merge_clients(None, v.clients), keys=("udid", "app_key"),
                                 attrs=("version", "city_id"), client_cols=("clnt", "init_version"),
                                 extra_keys=("log_type",))


@query("daily_active_backfill", DAILY_ACTIVE_SQL)
def daily_active_backfill(v):
    """Two sources that deliver a third of the days twice."""
    old, new = v.visit_ad.where("create_time < '2024-01-20'"), v.visit_ad.where("create_time >= '2024-01-10'")
    return activity.daily_active_backfill([old, new], merge.merge_new_users(None, v.visit_ad))


@query("daily_active_latest", f"""
a AS (SELECT user_id, CAST(ts AS DATE) AS d, arg_max(k % 10, ts) FILTER (k % 10 > 0) AS city_id,
  arg_max('m' || k, ts) FILTER (k % 4 > 0) AS model,
  max(CASE k % 5 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE k % 5 END) AS nettype,
  arg_max(version, ts) AS version FROM log GROUP BY ALL),
u AS (SELECT user_id, any_value(uid) AS uid, min(CAST(ts AS DATE)) AS born FROM log GROUP BY user_id)
SELECT uid AS device_id, city_id, model, nettype, version, {day_int('d')} AS active_date,
  {day_int('born')} AS create_date, date_diff('day', born, d) AS date_diff FROM a JOIN u USING (user_id)""")
def daily_active_latest(v):
    k = F.col("k")
    log = v.log.select(F.col("uid").alias("device_id"), (k % 10).alias("city_id"),
                       F.when(k % 4 > 0, F.concat(F.lit("m"), k.cast("string"))).alias("model"),
                       (k % 5).alias("nettype"), "version", F.col("ts").alias("create_time"))
    log = log.withColumn("nettype", merge.prefer_mobile("nettype"))
    devices = log.groupBy("device_id").agg(F.min("create_time").alias("create_time"))
    policy = Policy(last_known=("city_id", "model", "version"), highest=("nettype",), unknown=("null",))
    return activity.daily_active_latest(log, devices, policy=policy)


_SESSION_ROWS = f"""r AS (SELECT uid, uid || strftime(ts, '-%Y%m%d%H') AS session_id, ts,
  CAST(floor(value * 100) AS BIGINT) AS ms, version FROM log),
c AS (SELECT uid, arg_min(channel, ts) AS channel, arg_min(version, ts) AS init_version, min(ts) AS born
  FROM log GROUP BY uid)"""
_SECONDS = "CASE WHEN {0} > 0 THEN {0} WHEN {0} = 0 THEN 1 ELSE abs({0}) END"


@query("sessions", _SESSION_ROWS + f""",
s AS (SELECT uid, session_id, min(ts) AS t, arg_min(version, ts) AS version,
  CAST(round(sum(ms) / 1000.0) AS BIGINT) AS sec FROM r GROUP BY ALL),
p AS (SELECT *, lag(t) OVER (PARTITION BY uid ORDER BY t, session_id) AS prev FROM s)
SELECT uid AS uuid, 'app' AS app_key, session_id, {ts_text('t')} AS create_time, p.version,
  {_SECONDS.format('sec')} AS duration, {ts_text('prev')} AS prev_time, {day_int('t')} AS create_date,
  coalesce(date_diff('day', CAST(prev AS DATE), CAST(t AS DATE)), -1) AS date_diff, channel AS customer_id
FROM p JOIN c USING (uid)""")
def sessions(v):
    return activity.sessions(v.using, v.app_clients)


_SPLIT = "2024-01-16 12:30:00"


@query("sessions_incremental", _SESSION_ROWS + f""",
o AS (SELECT uid, session_id, min(ts) AS t, arg_min(version, ts) AS version,
  CAST(round(sum(ms) / 1000.0) AS BIGINT) AS raw FROM r WHERE ts < TIMESTAMP '{_SPLIT}' GROUP BY ALL),
l AS (SELECT uid, session_id, t, version, {_SECONDS.format('raw')} AS sec, 0 AS fresh FROM o
  QUALIFY row_number() OVER (PARTITION BY uid ORDER BY t DESC, session_id DESC) = 1),
n AS (SELECT uid, session_id, min(ts) AS t, arg_min(version, ts) AS version,
  CAST(round(sum(ms) / 1000.0) AS BIGINT) AS sec, 1 AS fresh FROM r WHERE ts >= TIMESTAMP '{_SPLIT}' GROUP BY ALL),
j AS (SELECT uid, session_id, min(t) AS t, arg_min(version, t) AS version, CAST(sum(sec) AS BIGINT) AS sec,
  max(fresh) AS fresh FROM (SELECT * FROM l UNION ALL SELECT * FROM n) GROUP BY ALL),
p AS (SELECT *, lag(t) OVER (PARTITION BY uid ORDER BY t, session_id) AS prev FROM j)
SELECT uid AS uuid, 'app' AS app_key, session_id, {ts_text('t')} AS create_time, p.version,
  {_SECONDS.format('sec')} AS duration, {ts_text('prev')} AS prev_time, {day_int('t')} AS create_date,
  coalesce(date_diff('day', CAST(prev AS DATE), CAST(t AS DATE)), -1) AS date_diff, channel AS customer_id
FROM p JOIN c USING (uid) WHERE fresh = 1""")
def sessions_incremental(v):
    stored = activity.sessions(v.using.where(f"start_millis < '{_SPLIT}'"), v.app_clients)
    return activity.sessions_incremental(stored, v.using.where(f"start_millis >= '{_SPLIT}'"), v.app_clients)


_RICH = _SESSION_ROWS + f""",
q AS (SELECT uid, CAST(ts AS DATE) AS d, CASE WHEN event_type = 'view' THEN 2 ELSE 1 END AS log_type, ts, hour(ts) AS h,
  k, version, (k - 50) * 60 AS gap, CAST(floor(value * 60000) AS BIGINT) AS boot FROM log),
m AS (SELECT uid, d, log_type, string_agg(DISTINCT CAST(h AS VARCHAR), ',' ORDER BY CAST(h AS VARCHAR)) AS hs,
  list_sort(list_distinct(list(h))) AS hours, arg_max(gap, ts) AS time_diff, arg_max(k, ts) AS sdcard_size,
  arg_max(k * 2, ts) AS rom_size, '10.0.0.' || arg_max(k, ts) AS client_ip,
  max(CASE WHEN boot <= 0 THEN 0 WHEN boot / 60000.0 < 1 THEN 1 WHEN boot / 60000.0 > 120 THEN 121
      ELSE CAST(round(boot / 60000.0) AS INTEGER) END) AS boottime, arg_min(version, ts) AS version,
  max(CASE WHEN k * 2 - 10 <= 0 THEN 0 WHEN k * 2 - 10 > 100 THEN 100 ELSE k * 2 - 10 END) AS screen_on,
  count(DISTINCT k) FILTER (k > 0) AS battery,
  coalesce('c' || arg_min(k, ts) FILTER (k % 4 > 0), 'unknown') AS city,
  coalesce('r' || arg_min(k, ts) FILTER (k % 4 <> 1), 'unknown') AS region, count(*) AS visit_times
  FROM q GROUP BY uid, d, log_type),
s AS (SELECT uid, CAST(t AS DATE) AS d, count(*) AS starts, CAST(sum({_SECONDS.format('sec')}) AS BIGINT) AS duration
  FROM (SELECT uid, session_id, min(ts) AS t, CAST(round(sum(ms) / 1000.0) AS BIGINT) AS sec FROM r GROUP BY ALL)
  GROUP BY ALL)"""


@query("daily_active_rich", _RICH + f"""
SELECT m.uid AS uuid, 'app' AS app_key, {day_int('m.d')} AS active_date, m.log_type,
  array_to_string(hours, ',') AS active_hours, time_diff, CAST(sdcard_size AS BIGINT) AS sdcard_size,
  CAST(rom_size AS BIGINT) AS rom_size, client_ip, boottime, m.version, screen_on, battery, city, region,
  'unknown' AS country, visit_times, coalesce(starts, 1) AS start_times, coalesce(duration, 0) AS duration,
  channel AS customer_id, init_version, {day_int('born')} AS create_date,
  date_diff('day', CAST(born AS DATE), m.d) AS date_diff
FROM m LEFT JOIN s ON m.uid = s.uid AND m.d = s.d AND m.log_type = 1 JOIN c ON m.uid = c.uid""")
def daily_active_rich(v):
    log = activity.rich_log(v.rich)
    return activity.daily_active_rich(log, activity.session_lengths(v.using), v.app_clients)


@query("hourly_active", f"""
h AS (SELECT DISTINCT uid, CAST(ts AS DATE) AS d, hour(ts) AS h FROM log WHERE event_type <> 'view'),
m AS (SELECT uid, CAST(ts AS DATE) AS d, arg_min(version, ts) AS version, arg_min(channel, ts) AS channel
  FROM log WHERE event_type <> 'view' GROUP BY ALL),
g AS (SELECT DISTINCT channel, version, d FROM m),
n AS (SELECT channel, version, d, h, count(*) AS n FROM m JOIN h USING (uid, d) GROUP BY ALL)
SELECT channel AS customer_id, version, {day_int('d')} AS active_date, x.active_hour, coalesce(n, 0) AS user_count
FROM g CROSS JOIN (SELECT CAST(range AS INTEGER) AS active_hour FROM range(24)) x
LEFT JOIN n ON n.channel = g.channel AND n.version = g.version AND n.d = g.d AND n.h = x.active_hour""".replace(
    "SELECT channel AS customer_id, version, CAST(strftime(d,",
    "SELECT g.channel AS customer_id, g.version, CAST(strftime(g.d,"))
def hourly_active(v):
    log = activity.rich_log(v.rich)
    active = activity.daily_active_rich(log, activity.session_lengths(v.using), v.app_clients)
    return activity.hourly_active(active.where("log_type = 1"))


def _usage(v):
    return v.log.select(F.col("event_id").alias("id"), F.col("uid").alias("uuid"), F.lit("app").alias("productkey"),
                        F.col("channel").alias("clnt"), "version", F.col("event_type").alias("event"),
                        F.col("ts").alias("insertdate"), F.floor(F.col("value") * 20000).cast("long").alias("acc"))


@query("open_counts", f"""
SELECT uid AS uuid, 'app' AS app_key, arg_min(channel, ts) AS clnt, arg_min(version, ts) AS version,
  {day_int('ts')} AS stat_date, count(*) AS open_times FROM log WHERE event_type = 'view' GROUP BY uid, {day_int('ts')}""")
def open_counts(v):
    return activity.open_counts(_usage(v), event="view")


@query("use_durations", f"""
e AS (SELECT *, CAST(floor(value * 20000) AS BIGINT) AS acc FROM log WHERE event_type = 'purchase')
SELECT event_id AS id, uid AS uuid, 'app' AS app_key, channel AS clnt, version, {day_int('ts')} AS stat_date,
  CAST(ceil(acc / 1000.0) AS BIGINT) AS duration FROM e WHERE acc > 0 AND acc < 3600000""")
def use_durations(v):
    return activity.use_durations(_usage(v), event="purchase")


BASE_DEVICES_SQL = """d AS (SELECT uid, arg_min(channel, ts) AS channel, arg_min(k // 10, ts) AS v, arg_max(k // 10, ts) AS uv,
  arg_min(k % 2, ts) AS os, min(ts) AS born FROM log GROUP BY uid)"""
ACTIVE_DAYS_SQL = BASE_DEVICES_SQL + """,
a AS (SELECT uid, CAST(ts AS DATE) AS d, arg_min(channel, ts) AS channel, arg_min(k // 10, ts) AS v, count(*) AS n
  FROM log GROUP BY ALL)"""


@query("hourly_new_users", BASE_DEVICES_SQL + f"""
SELECT channel AS customer_id, v AS apk_version, {day_int('born')} AS create_date, hour(born) AS create_hour,
  count(*) AS user_count FROM d GROUP BY ALL""")
def hourly_new_users(v):
    return activity.hourly_new_users(v.base_devices)


@query("active_user_days", ACTIVE_DAYS_SQL + f"""
SELECT a.uid AS uuid, a.channel AS customer_id, a.v AS apk_version, {day_int('a.d')} AS active_date, n AS visit_count,
  d.v AS first_apk_version, os AS os_type, {day_int('born')} AS create_date,
  date_diff('day', CAST(born AS DATE), a.d) AS date_diff FROM a JOIN d ON a.uid = d.uid""")
def active_user_days(v):
    return activity.active_user_days(v.base_visits, v.base_devices)


@query("usage_frequency", ACTIVE_DAYS_SQL + f"""
SELECT channel AS customer_id, v AS apk_version, {day_int('d')} AS active_date, n AS visit_count, count(*) AS user_count
FROM a GROUP BY ALL""")
def usage_frequency(v):
    return activity.usage_frequency(activity.active_user_days(v.base_visits, v.base_devices))


@query("start_counts", f"""
SELECT channel AS customer_id, k // 10 AS apk_version, k % 2 AS os_type, {day_int('ts')} AS visit_date,
  count(*) AS start_times FROM log GROUP BY ALL""")
def start_counts(v):
    return activity.start_counts(v.base_visits)


@query("user_totals", ACTIVE_DAYS_SQL + """,
n AS (SELECT channel, v, count(*) AS c FROM d WHERE CAST(born AS DATE) = DATE '2024-01-02' GROUP BY ALL),
t AS (SELECT channel, v, count(*) AS c FROM d WHERE CAST(born AS DATE) <= DATE '2024-01-02' GROUP BY ALL),
w AS (SELECT a.channel, d.v, count(*) AS c FROM a JOIN d USING (uid) WHERE a.d = DATE '2024-01-02' GROUP BY ALL)
SELECT channel AS customer_id, v AS apk_version, 20240102 AS create_date, n.c AS new_user_count,
  w.c AS visit_user_count, w.c - n.c AS active_user_count, t.c AS total_user_count
FROM t FULL JOIN n USING (channel, v) FULL JOIN w USING (channel, v)""")
def user_totals(v):
    active = activity.active_user_days(v.base_visits, v.base_devices)
    return activity.user_totals(v.base_devices, active, "2024-01-02")


@query("version_split", BASE_DEVICES_SQL + f"""
SELECT channel AS customer_id, v AS apk_version, {day_int('born')} AS create_date,
  count(*) FILTER (uv = v OR uv = 0) AS initial_user_count, count(*) FILTER (uv <> v AND uv > 0) AS upgrade_user_count,
  count(*) AS total_user_count FROM d GROUP BY ALL""")
def version_split(v):
    return activity.version_split(v.base_devices)


@query("sdk_first_last_version", """
SELECT uid AS udid, event_type AS app_key, arg_min('s' || k, ts) AS first_sdkver, arg_max('s' || k, ts) AS last_sdkver
FROM log GROUP BY ALL""")
def sdk_first_last_version(v):
    log = v.log.select(F.col("uid").alias("udid"), F.col("event_type").alias("apppkg"),
                       F.concat(F.lit("s"), F.col("k").cast("string")).alias("sdkver"), F.col("ts").alias("createtime"))
    return activity.sdk_first_last_version(log)
