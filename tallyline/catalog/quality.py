"""Queries for retention, alarms, funnels, device facts, scores and roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.catalog.registry import day_int, query, ts_text
from tallyline.catalog.state import ACTIVE_DAYS_SQL, BASE_DEVICES_SQL, DAILY_ACTIVE_SQL, NEW_USERS_SQL
from tallyline.operators import activity, bitmaps, devices, dims, funnel, merge, retention, rollup, scoring
from tallyline.plans import daily
from tallyline.session import scratch, written
from tallyline.sinks import bucketed


def _active(v):
    return activity.active_user_days(v.base_visits, v.base_devices)


@query("retention_by_day", ACTIVE_DAYS_SQL + f"""
SELECT a.channel AS customer_id, d.v AS apk_version, {day_int('born')} AS create_date,
  date_diff('day', CAST(born AS DATE), a.d) AS day_diff, count(*) AS keep_user_count
FROM a JOIN d USING (uid) GROUP BY ALL""")
def retention_by_day(v):
    return retention.retention_by_day(_active(v), v.base_devices)


_WINDOWS_SQL = ACTIVE_DAYS_SQL + f""",
w AS (SELECT d.channel AS c, d.v AS v, os, born, a.uid, date_diff('day', CAST(born AS DATE), a.d) AS g, a.d
      FROM a JOIN d USING (uid) WHERE born < TIMESTAMP '2024-01-04')
SELECT c AS customer_id, v AS first_apk_version, os AS os_type, {day_int('born')} AS create_date,
  count(DISTINCT uid) FILTER (g = 0) AS new_user_count, count(DISTINCT uid) FILTER (g = 1) AS day_1_count,
  count(DISTINCT uid) FILTER (g > 0 AND g <= 7) AS day_7_count, count(DISTINCT uid) FILTER (g > 0 AND g <= 14) AS day_14_count,
  count(DISTINCT uid) FILTER (g > 0 AND g <= 30) AS day_30_count, count(DISTINCT uid) FILTER (g > 0 AND g <= 60) AS day_60_count
FROM w GROUP BY c, v, os, {day_int('born')}"""


@query("retention_windows", _WINDOWS_SQL)
def retention_windows(v):
    return retention.retention_windows(_active(v), "2024-03-03")


_COHORT = ["customer_id", "first_apk_version", "os_type", "create_date"]


def _daily_bitmaps(v, rows, keys, splits, day):
    """Bitmaps as they come in: every run numbers its new users, writes the bitmaps of its days, and
    reads none of the days before."""
    users, path = scratch(v.spark, "numbers"), scratch(v.spark, "bitmaps")
    for low, high in zip(splits, splits[1:]):
        run = rows.where((F.col(day) >= low) & (F.col(day) < high))
        numbers = bitmaps.extend_dictionary(v.spark, users, run, "uuid", ["customer_id"])
        bitmaps.user_bitmaps(run, numbers, keys, "uuid").write.mode("append").parquet(path)
    return v.spark.read.parquet(path)


@query("retention_windows_bitmap", _WINDOWS_SQL)
def retention_windows_bitmap(v):
    """Days in four runs; users that come later are numbered on."""
    found = _daily_bitmaps(v, _active(v), [*_COHORT, "date_diff"], [20240101, 20240105, 20240112, 20240125, 20250101], "active_date")
    return bitmaps.retention_from_bitmaps(found, "2024-03-03", (1, 7, 14, 30, 60), _COHORT)


@query("active_windows_bitmap", f"""
a AS (SELECT channel, uid, CAST(ts AS DATE) AS d FROM log),
r AS (SELECT unnest([DATE '2024-01-08', DATE '2024-01-20', DATE '2024-01-31']) AS until)
SELECT strftime(until, '%Y-%m-%d') AS until, channel AS customer_id, {', '.join(
    f"count(DISTINCT uid) FILTER (d > until - {n} AND d <= until) AS days_{n}" for n in (1, 7, 14, 30, 60))} FROM a, r GROUP BY ALL""")
def active_windows_bitmap(v):
    """Users of the last 1 to 60 days per channel at three dates, from one set of daily bitmaps."""
    rows = v.log.select(F.col("uid").alias("uuid"), F.col("channel").alias("customer_id"), F.date_format("ts", "yyyyMMdd").cast("int").alias("day"))
    found = _daily_bitmaps(v, rows, ["customer_id", "day"], [20240101, 20240110, 20240121, 20250101], "day")
    found = found.withColumn("day", F.to_date(F.col("day").cast("string"), "yyyyMMdd"))
    dates = F.explode(F.array(*[F.lit(d).cast("date") for d in ("2024-01-08", "2024-01-20", "2024-01-31")]))
    at = found.withColumn("until", dates)
    gap = F.datediff("until", "day")
    return bitmaps.distinct_from_bitmaps(at, ["until", "customer_id"], {f"days_{n}": (gap >= 0) & (gap < n) for n in (1, 7, 14, 30, 60)})


def _alarm_active(v):
    """fact_active of the alarm jobs: one row per user and day with install and visit dates."""
    first = v.base_devices.select("uuid", "customer_id", F.to_date("create_time").alias("install_date"))
    days = v.log.select(F.col("uid").alias("uuid"), F.to_date("ts").alias("visit_date")).distinct()
    return days.join(first, "uuid").withColumn("day_diff", F.datediff("visit_date", "install_date"))


_ALARM_ACTIVE = BASE_DEVICES_SQL + """,
x AS (SELECT DISTINCT uid, CAST(ts AS DATE) AS visit FROM log),
f AS (SELECT x.uid, channel, CAST(born AS DATE) AS install, visit, date_diff('day', CAST(born AS DATE), visit) AS g
      FROM x JOIN d USING (uid))"""


def _rate_sql(back: str, base: str, new: str, where: str = "TRUE") -> str:
    return _ALARM_ACTIVE + f""",
r AS (SELECT channel, count(DISTINCT uid) FILTER ({back}) AS b, count(DISTINCT uid) FILTER ({base}) AS n,
  count(DISTINCT uid) FILTER ({new}) AS new_cnt FROM f WHERE {where} GROUP BY channel)
SELECT channel AS customer_id, CASE WHEN n > 0 THEN round(b * 100.0 / n, 2) END AS keep_pct, new_cnt FROM r"""


_D = "DATE '2024-01-25'"
_RATES = {
    "next_day": _rate_sql(f"g = 1 AND visit < {_D}", f"g = 0 AND install < {_D} - 1", f"g = 0 AND install < {_D}"),
    "after_7": _rate_sql(f"g >= 7 AND visit < {_D} - 6", f"g = 0 AND install < {_D} - 7", f"g = 0 AND install < {_D}"),
    "after_14": _rate_sql(f"g >= 14 AND visit < {_D} - 13", f"g = 0 AND install < {_D} - 14",
                          f"g = 0 AND install < {_D}"),
    "cohort": _rate_sql("g = 1", "g = 0", "g = 0", "install = DATE '2024-01-03' - 2"),
}


def _rate(mode: str):
    day = "2024-01-03" if mode == "cohort" else "2024-01-25"

    @query(f"channel_retention_{mode}", _RATES[mode])
    def run(v):
        return retention.channel_retention_rate(_alarm_active(v), mode, day, limit=float("inf"), min_new=None)


for _mode in _RATES:
    _rate(_mode)


@query("channel_retention_alarm", _RATES["next_day"] + """ WHERE n > 0 AND round(b * 100.0 / n, 2) < 95 AND new_cnt > 5""")
def channel_retention_alarm(v):
    return retention.channel_retention_rate(_alarm_active(v), "next_day", "2024-01-25", limit=95, min_new=5)


def _orders_facts(v):
    """One signal row per order: the customer's segment as channel."""
    people = v.table("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("customer_id"),
                                        F.col("c_nationkey").alias("nation"))
    o = v.table("orders").join(people, "o_custkey")
    n = F.col("nation")
    return o.select(
        "customer_id", F.col("o_orderdate").cast("date").alias("install_date"),
        F.when(F.col("o_orderstatus") == "F", "WIFI").otherwise("3G").alias("link_type"),
        F.when(n % 4 == 0, -1).otherwise(F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)).alias("used_vpn"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("has_phone"),
        F.when(n % 3 == 0, 46000).when(n % 3 == 1, 46002).otherwise(46001).alias("isp_code"),
        (F.col("o_orderkey") % 5).alias("unlock_count"))


_ORDERS_FACTS = """o AS (SELECT c_mktsegment AS ch, o_orderstatus AS st, o_orderpriority AS pr, c_nationkey AS n, o_orderkey AS ok
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
_RATIOS = {
    "wifi": "count(*) FILTER (st = 'F') * 100.0 / count(*)",
    "vpn": "count(*) FILTER (n % 4 > 0 AND st = 'P') * 100.0 / count(*) FILTER (n % 4 > 0)",
    "phone": "count(*) FILTER (pr = '1-URGENT') * 100.0 / count(*) FILTER (n % 3 < 2)",
    "unlock": "count(*) FILTER (ok % 5 >= 2) * 100.0 / count(*)",
}
_RATIO_TEST = {"wifi": (">", 33), "vpn": (">", 33), "phone": ("<", 31), "unlock": ("<", 60.5)}


def _ratio(kind: str):
    op, limit = _RATIO_TEST[kind]

    @query(f"channel_{kind}_alarm", _ORDERS_FACTS + f""", r AS (SELECT ch AS customer_id, round({_RATIOS[kind]}, 2) AS pct,
  count(*) AS new_cnt FROM o GROUP BY ch) SELECT * FROM r WHERE pct {op} {limit} AND new_cnt > 50""", log=False)
    def run(v):
        num, den = retention.ratio_parts(kind)
        return retention.channel_ratio_alarm(_orders_facts(v), num, den, op, limit)


for _kind in _RATIOS:
    _ratio(_kind)


@query("active_drop_alarm", _ALARM_ACTIVE + """,
r AS (SELECT channel, count(DISTINCT uid) FILTER (visit = DATE '2024-01-28') AS two,
  count(DISTINCT uid) FILTER (visit = DATE '2024-01-29') AS one FROM f WHERE visit > install GROUP BY channel)
SELECT channel AS customer_id, round((two - one) * 100.0 / two, 2) AS qoq_pct FROM r
WHERE two > 0 AND round((two - one) * 100.0 / two, 2) > -100""")
def active_drop_alarm(v):
    active = _alarm_active(v).withColumn("activate_date", F.col("install_date"))
    return retention.active_drop_alarm(active, "2024-01-30", limit=-100)


_ALL_ALARMS = _ORDERS_FACTS + ", r AS (" + " UNION ALL ".join(
    f"SELECT ch, '{kind}: ' || printf('%.2f', round({expr}, 2)) || '%' AS msg, {i} AS pos FROM o GROUP BY ch"
    for i, (kind, expr) in enumerate(_RATIOS.items(), start=5)) + ")"


@query("alarm_summary", _ALL_ALARMS + """
SELECT 'customer of ' || ch AS cusname, ch AS chacode, string_agg(msg, ' | ' ORDER BY pos) AS msgs FROM r
WHERE ch <> 'BUILDING' GROUP BY ch""", log=False)
def alarm_summary(v):
    facts, rows = _orders_facts(v), None
    for pos, kind in enumerate(_RATIOS, start=5):
        num, den = retention.ratio_parts(kind)
        one = retention.channel_ratio_alarm(facts, num, den, ">", float("inf"), min_new=None).select(
            F.lit("2024-01-25").cast("date").alias("stat_date"), "customer_id",
            F.format_string(f"{kind}: %.2f%%", "pct").alias("msg"), F.lit(pos).alias("show_order"))
        rows = one if rows is None else rows.unionByName(one)
    channels = v.table("customer").select(F.col("c_mktsegment").alias("chacode")).distinct().select(
        "chacode", F.concat(F.lit("customer of "), "chacode").alias("cusname"),
        F.when(F.col("chacode") == "BUILDING", 0).otherwise(1).alias("alarm"))
    return retention.alarm_summary(retention.recent_alarms(rows, "2024-01-31"), channels, "2024-01-25")


# --- ad funnel -------------------------------------------------------------------------------

def _ad_logs(v):
    """A view requests an ad; every other event is a reply of its stage to ad ``k % 10``."""
    log = v.log.withColumn("adcode", F.concat(F.lit("ad"), (F.col("k") % 10).cast("string")))
    send = log.where("event_type IN ('view', 'click')").select(
        "adcode", F.col("uid").alias("udid"), F.concat(F.lit("key"), F.col("k").cast("string")).alias("adkey"),
        F.col("k").cast("long").alias("adverid"), F.lit(1).cast("long").alias("position"), F.lit("app").alias("apppkg"),
        F.col("channel").alias("clnt"), F.col("nation").cast("long").alias("cityid"), F.col("ts").alias("createtime"))
    reply = log.where("event_type NOT IN ('view', 'click')").select(
        "adcode", F.col("uid").alias("udid"), F.col("ts").alias("createtime"), ((F.col("event_id") % 6)).cast("int").alias("rtype"))
    return send, reply


_STAGES = {1: "show", 2: "click", 3: "install", 4: "close", 5: "uninstall"}
_LIFE = """s AS (SELECT 'ad' || (k % 10) AS adcode, uid AS udid, arg_min('key' || k, ts) AS adkey, arg_min(k, ts) AS adverid,
  1 AS position, 'app' AS app_key, arg_min(channel, ts) AS clnt, arg_min(nation, ts) AS city_id, min(ts) AS send_time
  FROM log WHERE event_type IN ('view', 'click') GROUP BY k % 10, uid),
r AS (SELECT 'ad' || (k % 10) AS adcode, uid AS udid, """ + ", ".join(
    f"min(ts) FILTER (event_id % 6 = {i}) AS {s}_time" for i, s in _STAGES.items()) + """
  FROM log WHERE event_type NOT IN ('view', 'click') GROUP BY k % 10, uid)"""


@query("ad_lifecycle", _LIFE + f"""
SELECT adcode, udid, adkey, CAST(adverid AS BIGINT) AS adverid, CAST(position AS BIGINT) AS position, app_key, clnt,
  CAST(city_id AS BIGINT) AS city_id, {ts_text('send_time')} AS send_time, """ + ", ".join(
    f"{ts_text(s + '_time')} AS {s}_time" for s in _STAGES.values()) + " FROM s LEFT JOIN r USING (adcode, udid)")
def ad_lifecycle(v):
    """Yesterday's state of the first half of the log, continued with the second half."""
    send, reply = _ad_logs(v)
    cut = "2024-01-16"
    state = funnel.ad_lifecycle(send.where(f"createtime < '{cut}'"), reply.where(f"createtime < '{cut}'"))
    # replies of the first half to ads sent in the second are known only to a full run
    return funnel.ad_lifecycle(send.where(f"createtime >= '{cut}'"), reply, state)


@query("recent_ad_facts", _LIFE + """
SELECT adcode, udid, adkey, CAST(adverid AS BIGINT) AS adverid, CAST(position AS BIGINT) AS position, app_key, clnt,
  CAST(city_id AS BIGINT) AS city_id, """ + ", ".join(
    f"{day_int(s + '_time')} AS {s}_date, hour({s}_time) AS {s}_hour" for s in ("send", *_STAGES.values())) + """
FROM s LEFT JOIN r USING (adcode, udid) WHERE send_time >= TIMESTAMP '2024-01-05'""")
def recent_ad_facts(v):
    return funnel.recent_ad_facts(funnel.ad_lifecycle(*_ad_logs(v)), "2024-02-04")


def _packed_log(v):
    """Visits with packed lists: two ads per view, the same resources shown, clicked, installed."""
    k, kind = F.col("k"), F.col("event_type")
    ad = lambda n: F.concat(F.lit("a"), (n % 20).cast("string"))
    res = lambda n: F.concat(F.lit("r"), (n % 20).cast("string"))
    pair = F.array_join(F.array(F.concat_ws("~", ad(k), res(k)), F.concat_ws("~", ad(k + 1), res(k + 1))), ",")
    ids = F.array_join(F.array(res(k), res(k + 7)), ",")
    return v.log.select(
        F.col("uid").alias("androidid"), F.col("channel").alias("custom_id"), F.col("ts").alias("create_time"),
        (k % 8).alias("city_id"), (k % 5).alias("nettype"), F.when(k % 6 > 0, F.col("version")).alias("version"),
        F.when(kind.isin("view", "signup"), pair).alias("advids"), F.when(kind == "click", ids).alias("hisshow"),
        F.when(kind == "purchase", ids).alias("hisclick"), F.when(kind == "error", ids).alias("hisinstall"))


_PACKED = """b AS (SELECT uid, ts, k % 8 AS city, CASE k % 5 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE k % 5 END AS net,
  CASE WHEN k % 6 > 0 THEN version END AS ver, event_type AS e, k FROM log),
p AS (SELECT uid, ts, city, net, ver, 'a' || (k % 20) AS ad, 'r' || (k % 20) AS res FROM b WHERE e IN ('view', 'signup')
  UNION ALL SELECT uid, ts, city, net, ver, 'a' || ((k + 1) % 20), 'r' || ((k + 1) % 20) FROM b WHERE e IN ('view', 'signup')),
s AS (SELECT ad AS ad_id, uid AS device_id, arg_min(res, ts) AS res_id, min(ts) AS t,
  arg_max(city, ts) FILTER (city > 0) AS city_id, max(net) AS nettype, arg_min(ver, ts) FILTER (ver IS NOT NULL) AS version,
  count(*) AS n FROM p GROUP BY ALL)"""


# The send facts of the first half are stored; of the second half only unseen ads of a device are new.
_CUT = "2024-01-16"
_PACKED_STORED = _PACKED[:_PACKED.index("s AS (SELECT ad")] + f"""
g AS (SELECT ad AS ad_id, uid AS device_id, ts >= TIMESTAMP '{_CUT}' AS late, arg_min(res, ts) AS res_id, min(ts) AS t,
  arg_max(city, ts) FILTER (city > 0) AS city_id, max(net) AS nettype, arg_min(ver, ts) FILTER (ver IS NOT NULL) AS version,
  count(*) AS n FROM p GROUP BY ALL),
s AS (SELECT * EXCLUDE (late) FROM g WHERE NOT late OR NOT EXISTS (
  SELECT 1 FROM g f WHERE NOT f.late AND f.ad_id = g.ad_id AND f.device_id = g.device_id))"""


def _stage_sql(event: str, stage: str, packed: str = _PACKED, rows: str = "true") -> str:
    return packed + f""",
q AS (SELECT uid, ts, city, net, ver, 'r' || (k % 20) AS res FROM b WHERE e = '{event}' AND {rows}
  UNION ALL SELECT uid, ts, city, net, ver, 'r' || ((k + 7) % 20) FROM b WHERE e = '{event}' AND {rows}),
c AS (SELECT res, uid, min(ts) AS t, arg_max(city, ts) FILTER (city > 0) AS city_id, max(net) AS nettype,
  arg_min(ver, ts) FILTER (ver IS NOT NULL) AS version, count(*) AS n FROM q GROUP BY ALL)
SELECT s.ad_id, s.device_id, {day_int('s.t')} AS send_date, {day_int('c.t')} AS create_date, hour(c.t) AS create_hour,
  c.city_id, c.nettype, c.version, c.n AS {stage}_count FROM c JOIN s ON c.res = s.res_id AND c.uid = s.device_id"""


def _stored_ad_events(v):
    log = _packed_log(v)
    sent = funnel.ad_events(log.where(f"create_time < '{_CUT}'"))["send"]
    return funnel.ad_events(log.where(f"create_time >= '{_CUT}'"), sent)


@query("ad_events_send_stored", _PACKED_STORED + f"""
SELECT ad_id, device_id, res_id, {day_int('t')} AS create_date, hour(t) AS create_hour, city_id, nettype, version,
  n AS send_count FROM s""")
def ad_events_send_stored(v):
    return _stored_ad_events(v)["send"]


@query("ad_events_show_stored", _stage_sql("click", "show", _PACKED_STORED, f"ts >= TIMESTAMP '{_CUT}'"))
def ad_events_show_stored(v):
    return _stored_ad_events(v)["show"]


@query("ad_events_send", _PACKED + f"""
SELECT ad_id, device_id, res_id, {day_int('t')} AS create_date, hour(t) AS create_hour, city_id, nettype, version,
  n AS send_count FROM s""")
def ad_events_send(v):
    return funnel.ad_events(_packed_log(v))["send"]


def _stage(event: str, stage: str):
    @query(f"ad_events_{stage}", _stage_sql(event, stage))
    def run(v):
        return funnel.ad_events(_packed_log(v))[stage]


for _event, _s in (("click", "show"), ("purchase", "click"), ("error", "install")):
    _stage(_event, _s)


def _api_log(v):
    k, kind = F.col("k"), F.col("event_type")
    one = F.concat(F.lit("i"), (k % 25).cast("string"))
    two = F.array_join(F.array(one, F.concat(F.lit("i"), ((k + 3) % 25).cast("string"))), ",")
    text = lambda p: F.concat(F.lit(p), k.cast("string"))
    return v.log.select(
        F.col("uid").alias("androidid"), F.when(kind.isin("view", "signup"), one).alias("ids"),
        F.when(kind == "click", two).alias("apishow"), F.when(kind == "purchase", two).alias("apiclick"),
        F.col("ts").alias("create_time"), text("url").alias("apiurl"), text("click").alias("clickurl"),
        F.col("channel").alias("custom_id"), text("imei").alias("imei"), text("t").alias("title"), F.lit("x").alias("adtype"))


@query("api_ad_status", f"""
s AS (SELECT uid, 'i' || (k % 25) AS ad, {day_int('ts')} AS d, 'url' || k AS apiurl, 'click' || k AS clickurl, channel,
  'imei' || k AS imei, 't' || k AS title FROM log WHERE event_type IN ('view', 'signup')
  QUALIFY row_number() OVER (PARTITION BY uid, k % 25 ORDER BY d DESC, 'url' || k DESC) = 1),
h AS (SELECT uid, 'i' || (unnest([k, k + 3]) % 25) AS ad, event_type AS e, {day_int('ts')} AS d FROM log
      WHERE event_type IN ('click', 'purchase')),
w AS (SELECT uid, ad, max(d) FILTER (e = 'click') AS sd, max(d) FILTER (e = 'purchase') AS cd FROM h GROUP BY ALL)
SELECT s.uid AS androidid, s.ad AS ad_id, apiurl, clickurl, channel AS custom_id, imei, title, 'x' AS adtype,
  CASE WHEN sd IS NOT NULL AND cd IS NOT NULL THEN 3 WHEN sd IS NOT NULL THEN 2 ELSE 1 END AS ad_status,
  d AS create_date, sd AS show_date, CASE WHEN sd IS NOT NULL THEN cd END AS click_date
FROM s LEFT JOIN w ON s.uid = w.uid AND s.ad = w.ad""")
def api_ad_status(v):
    return funnel.api_ad_status(_api_log(v))


# Of the first half, only ads that were sent there are stored, and clicks only where the ad was shown.
@query("api_ad_status_stored", f"""
s AS (SELECT uid, 'i' || (k % 25) AS ad, {day_int('ts')} AS d, 'url' || k AS apiurl, 'click' || k AS clickurl, channel,
  'imei' || k AS imei, 't' || k AS title FROM log WHERE event_type IN ('view', 'signup')
  QUALIFY row_number() OVER (PARTITION BY uid, k % 25 ORDER BY d DESC, 'url' || k DESC) = 1),
early AS (SELECT DISTINCT uid, 'i' || (k % 25) AS ad FROM log WHERE event_type IN ('view', 'signup') AND ts < TIMESTAMP '{_CUT}'),
h AS (SELECT uid, 'i' || (unnest([k, k + 3]) % 25) AS ad, event_type AS e, {day_int('ts')} AS d, ts < TIMESTAMP '{_CUT}' AS first FROM log
      WHERE event_type IN ('click', 'purchase')),
g AS (SELECT uid, ad, first, max(d) FILTER (e = 'click') AS sd, max(d) FILTER (e = 'purchase') AS cd FROM h GROUP BY ALL),
w AS (SELECT uid, ad, max(sd) AS sd, max(cd) AS cd FROM (
  SELECT uid, ad, sd, CASE WHEN sd IS NOT NULL THEN cd END AS cd FROM g JOIN early USING (uid, ad) WHERE first
  UNION ALL SELECT uid, ad, sd, cd FROM g WHERE NOT first) GROUP BY ALL)
SELECT s.uid AS androidid, s.ad AS ad_id, apiurl, clickurl, channel AS custom_id, imei, title, 'x' AS adtype,
  CASE WHEN sd IS NOT NULL AND cd IS NOT NULL THEN 3 WHEN sd IS NOT NULL THEN 2 ELSE 1 END AS ad_status,
  d AS create_date, sd AS show_date, CASE WHEN sd IS NOT NULL THEN cd END AS click_date
FROM s LEFT JOIN w ON s.uid = w.uid AND s.ad = w.ad""")
def api_ad_status_stored(v):
    log = _api_log(v)
    return funnel.api_ad_status(log.where(f"create_time >= '{_CUT}'"), funnel.api_ad_status(log.where(f"create_time < '{_CUT}'")))


# --- upgrades --------------------------------------------------------------------------------

def _versions_log(v):
    return v.log.select(F.col("uid").alias("udid"), F.lit("app").alias("apppkg"), F.col("version").alias("appversion"),
                        F.col("ts").alias("createtime"))


def _pushes_log(v):
    """A purchase pushes the next version number."""
    return v.log.where("event_type = 'purchase'").select(
        F.col("uid").alias("udid"), F.lit("app").alias("apppkg"), F.col("version").alias("appversion"),
        F.concat(F.lit("v"), (F.floor(F.col("k") / 10) + 1).cast("string")).alias("upversion"), F.col("ts").alias("createtime"))


_VERSIONS = """v AS (SELECT uid, version, min(date_trunc('second', ts)) AS t FROM log GROUP BY ALL)"""
_PUSHES = """u AS (SELECT DISTINCT uid, version, 'v' || (k // 10 + 1) AS up, CAST(ts AS DATE) AS d FROM log
  WHERE event_type = 'purchase')"""
_UPGRADES = _VERSIONS + ", " + _PUSHES + """,
st AS (SELECT uid, lag(version) OVER (PARTITION BY uid ORDER BY t, version) AS version, version AS up, CAST(t AS DATE) AS d FROM v),
m AS (SELECT uid, version, up, min(d) AS d FROM u GROUP BY ALL)"""


@query("version_first_seen", _VERSIONS + f"""
SELECT uid AS udid, 'app' AS app_key, version, {ts_text('t')} AS create_time FROM v""")
def version_first_seen(v):
    log = _versions_log(v)
    stored = funnel.version_first_seen(None, log.where("createtime < '2024-01-16'"))
    return funnel.version_first_seen(stored, log.where("createtime >= '2024-01-16'"))


@query("upgrade_log", _PUSHES + """
SELECT uid AS udid, 'app' AS app_key, version, up AS up_version, strftime(d, '%Y-%m-%d') AS create_date FROM u""")
def upgrade_log(v):
    return funnel.upgrade_log(_pushes_log(v))


@query("upgrade_success", _UPGRADES + """
SELECT m.uid AS udid, 'app' AS app_key, m.version, m.up AS up_version, strftime(m.d, '%Y-%m-%d') AS create_date,
  strftime(st.d, '%Y-%m-%d') AS upgrade_date
FROM m LEFT JOIN st ON m.uid = st.uid AND m.version = st.version AND m.up = st.up""")
def upgrade_success(v):
    return funnel.upgrade_success(funnel.upgrade_log(_pushes_log(v)), funnel.version_first_seen(None, _versions_log(v)))


@query("recent_upgrades", _UPGRADES + f""",
c AS (SELECT uid, arg_min(channel, ts) AS clnt FROM log GROUP BY uid)
SELECT m.uid AS udid, 'app' AS app_key, m.version, m.up AS up_version, {day_int('m.d')} AS create_date,
  {day_int('st.d')} AS upgrade_date, clnt
FROM m LEFT JOIN st ON m.uid = st.uid AND m.version = st.version AND m.up = st.up JOIN c ON m.uid = c.uid
WHERE m.d >= DATE '2024-01-10'""")
def recent_upgrades(v):
    mid = funnel.upgrade_success(funnel.upgrade_log(_pushes_log(v)), funnel.version_first_seen(None, _versions_log(v)))
    clients = v.app_clients.select(F.col("uuid").alias("udid"), "app_key", F.col("customer_id").alias("clnt"))
    return funnel.recent_upgrades(mid, clients, "2024-03-10")


# --- device facts ----------------------------------------------------------------------------

@query("runlevel_users", f"""
SELECT event_type AS app_key, channel AS clnt, CAST(k % 4 AS VARCHAR) AS runlevel, {day_int('ts')} AS create_date,
  count(DISTINCT uid) AS user_count FROM log GROUP BY ALL""")
def runlevel_users(v):
    log = v.log.select(F.col("uid").alias("udid"), F.col("event_type").alias("apppkg"), F.col("channel").alias("clnt"),
                       (F.col("k") % 4).cast("string").alias("runlevel"), F.col("ts").alias("createtime"))
    return devices.runlevel_users(log)


@query("blacklist_counts", f"""
c AS (SELECT uid, event_type AS app, arg_min(nation, ts) AS n, min(CAST(ts AS DATE)) AS born FROM log GROUP BY ALL),
g AS (SELECT app, n, date_diff('day', born, DATE '2024-01-12') AS age, 5 + n_regionkey AS black FROM c JOIN nation ON n = n_nationkey)
SELECT app AS app_key, 'c' || n AS clnt, count(*) FILTER (age < black) AS black_count,
  count(*) FILTER (age + 1 = black) AS release_count, '2024-01-12' AS stat_date FROM g GROUP BY ALL""")
def blacklist_counts(v):
    log = v.log.select(F.col("uid").alias("udid"), F.col("event_type").alias("app_key"),
                       F.concat(F.lit("c"), F.col("nation").cast("string")).alias("clnt"), F.col("ts").alias("create_time"),
                       F.col("ts").alias("update_time"))
    customers = v.table("nation").select(F.concat(F.lit("c"), F.col("n_nationkey").cast("string")).alias("customid"),
                                         (F.col("n_regionkey") + 5).alias("blackdate"))
    return devices.blacklist_counts(merge.merge_clients(None, log), customers, "2024-01-12")


_CHANNEL_DAILY = """c AS (SELECT uid, event_type AS app, arg_min(channel, ts) AS ch, min(CAST(ts AS DATE)) AS born FROM log GROUP BY ALL)
SELECT strftime(born, '%Y-%m-%d') AS cdate, ch AS chacode, {} AS csum FROM c GROUP BY ALL"""


@query("channel_daily", _CHANNEL_DAILY.format("count(DISTINCT uid)"))
def channel_daily(v):
    return devices.channel_daily(merge.merge_clients(None, v.clients))


@query("channel_daily_rows", _CHANNEL_DAILY.format("count(*)"))
def channel_daily_rows(v):
    return devices.channel_daily(merge.merge_clients(None, v.clients), user=None)


def _install_devices(v):
    d = v.base_devices
    n = F.substring("uuid", 2, 20).cast("int")
    return d.select("customer_id", F.to_date("create_time").alias("install_date"),
                    F.date_add(F.to_date("create_time"), n % 3).alias("activate_date"), (n % 2).alias("is_activated"),
                    F.when(n % 5 == 0, 1).otherwise(0).alias("aid_status"), F.when(n % 7 == 0, 1).otherwise(0).alias("imsi_status"))


@query("install_activation", BASE_DEVICES_SQL + """,
x AS (SELECT channel, CAST(born AS DATE) AS i, CAST(born AS DATE) + CAST(CAST(substr(uid, 2) AS INTEGER) % 3 AS INTEGER) AS a,
  CAST(substr(uid, 2) AS INTEGER) AS n FROM d),
y AS (SELECT channel, i AS day, count(*) AS a1, count(*) FILTER (n % 5 > 0 AND n % 7 > 0) AS a2, 0 AS a3, 0 AS a4 FROM x GROUP BY ALL
  UNION ALL SELECT channel, a, 0, 0, count(*), count(*) FILTER (n % 5 > 0 AND n % 7 > 0) FROM x WHERE n % 2 = 1 GROUP BY ALL
  UNION ALL SELECT channel, i, 0, 0, 0, count(*) FROM x WHERE n % 3 = 0 GROUP BY ALL)
SELECT strftime(day, '%Y-%m-%d') AS stat_date, channel AS customer_id, CAST(sum(a1) AS BIGINT) AS init_install_cnt,
  CAST(sum(a2) AS BIGINT) AS install_cnt, CAST(sum(a3) AS BIGINT) AS init_activate_cnt, CAST(sum(a4) AS BIGINT) AS activate_cnt
FROM y GROUP BY ALL""")
def install_activation(v):
    n = F.substring("uuid", 2, 20).cast("int")
    fresh = v.base_devices.select("customer_id", F.to_date("create_time").alias("create_date"),
                                  F.when(n % 3 == 0, 0).otherwise(1).alias("is_exists"))
    return devices.install_activation(_install_devices(v), fresh)


@query("flag_duplicate_ids", f"""
SELECT o_orderkey AS uuid, o_custkey AS android_id, {ts_text('o_orderdate')} AS create_time,
  CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) > 1 THEN 1 ELSE 0 END AS aid_status
FROM orders""", log=False)
def flag_duplicate_ids(v):
    o = v.table("orders").select(F.col("o_orderkey").alias("uuid"), F.col("o_custkey").alias("android_id"),
                                 F.col("o_orderdate").cast("timestamp").alias("create_time"))
    return devices.flag_duplicate_ids(o, "android_id", "aid_status")


def _lines(v, *columns, where="true", hint=None):
    """Line items with their customer: the raw signal log of a device. ``hint`` is that of the orders in the join."""
    o = v.table("orders").where(where).select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.col("o_orderdate").cast("timestamp").alias("t"))
    li = v.table("lineitem").select("l_orderkey", *columns)
    return li.join(o if hint is None else o.hint(hint), "l_orderkey").withColumn("uuid", F.concat(F.lit("u"), F.col("o_custkey").cast("string")))


_LINES = "l AS (SELECT o_custkey AS c, o_orderdate AS t, li.* FROM lineitem li JOIN orders ON l_orderkey = o_orderkey)"


@query("device_signals", _LINES + """,
w AS (SELECT * FROM l WHERE t >= TIMESTAMP '2000-01-01'),
r AS (SELECT c, CAST(max(l_quantity) AS INTEGER) AS runtime, max(l_linenumber) AS unlock_cnt,
  count(DISTINCT CAST(l_discount * 100 AS INTEGER)) AS battery_cnt,
  count(*) FILTER (abs((l_quantity - 25) * 100 / 60) > 30) AS etime_cnt FROM w GROUP BY c),
s AS (SELECT c, count(DISTINCT l_suppkey) FILTER (l_suppkey > 0) AS stations, count(DISTINCT l_returnflag) AS accounts,
  count(DISTINCT l_partkey) FILTER (l_returnflag = 'R') AS installs, count(DISTINCT l_partkey) AS uses FROM w GROUP BY c)
SELECT 'u' || c_custkey AS uuid, c_mktsegment AS customer_id, 20240101 AS create_date, runtime, unlock_cnt, battery_cnt, etime_cnt,
  coalesce(stations, 0) AS station_cnt, coalesce(accounts, 0) AS account_cnt, coalesce(installs, 0) AS install_cnt,
  coalesce(uses, 0) AS appuse_cnt FROM customer JOIN r ON r.c = c_custkey LEFT JOIN s ON s.c = c_custkey""", log=False)
def device_signals(v):
    """The five logs all come from the line items, so they are read and stacked in one pass."""
    rows = _lines(v, "l_quantity", "l_linenumber", "l_discount", "l_suppkey", "l_returnflag", "l_partkey",
                  where="o_orderdate >= date '2000-01-01'")
    text = lambda c: c.cast("string").alias("value")
    signal = lambda name, value, **more: F.struct(
        F.lit(name).alias("signal"), text(value), *[more.get(c, F.lit(None)).cast("double").alias(c) for c in ("boottime", "screen_on", "time_diff")])
    part = F.col("l_partkey")
    stacked = rows.select("uuid", F.explode(F.array(
        signal("battery", F.round(F.col("l_discount") * 100).cast("int"), boottime=F.col("l_quantity"), screen_on=F.col("l_linenumber"),
               time_diff=(F.col("l_quantity") - 25) * 100),
        signal("station", F.when(F.col("l_suppkey") > 0, F.col("l_suppkey"))), signal("account", F.col("l_returnflag")),
        signal("install", F.when(F.col("l_returnflag") == "R", part)), signal("appuse", part))).alias("s")).select("uuid", "s.*")
    clients = v.table("customer").select(F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("uuid"),
                                         F.col("c_mktsegment").alias("customer_id"), F.lit(20240101).alias("create_date"))
    found = devices.device_signals(clients, stacked)
    return found.withColumns({c: F.col(c).cast("int") for c in ("runtime", "unlock_cnt")})


def _fact_devices(v):
    return v.table("customer").select(F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("uuid"),
                                      F.col("c_mktsegment").alias("customer_id"), F.lit(20240101).alias("install_date"))


_FACTS = {
    "rows": (lambda: F.count("*"), "count(*)", None, "TRUE"),
    "sum": (lambda: F.sum("l_quantity").cast("long"), "CAST(sum(l_quantity) AS BIGINT)", None, "TRUE"),
    "distinct": (lambda: F.count_distinct("l_suppkey"), "count(DISTINCT l_suppkey)",
                 lambda: (F.col("l_quantity") > 0) & (F.col("l_quantity") < 26), "l_quantity > 0 AND l_quantity < 26"),
}


def _device_fact(kind: str):
    measure, sql, where, sql_where = _FACTS[kind]

    @query(f"device_fact_{kind}", _LINES + f""",
m AS (SELECT c, {sql} AS measure, strftime(max(t), '%Y-%m-%d') AS stat_date FROM l WHERE {sql_where} GROUP BY c)
SELECT 'u' || c_custkey AS uuid, c_mktsegment AS customer_id, 20240101 AS install_date, coalesce(measure, 0) AS measure, stat_date
FROM customer LEFT JOIN m ON c = c_custkey""", log=False)
    def run(v):
        log = _lines(v, "l_quantity", "l_suppkey").withColumnRenamed("t", "create_time")
        return devices.device_fact(_fact_devices(v), log, measure(), "measure", where=where() if where else None)


for _k in _FACTS:
    _device_fact(_k)


@query("best_network", _LINES + """,
x AS (SELECT c, CASE l_linenumber WHEN 1 THEN 'WIFI' WHEN 2 THEN '2G' WHEN 3 THEN '3G' WHEN 4 THEN '4G' END AS link, t FROM l),
m AS (SELECT c, max(CASE link WHEN '4G' THEN 4 WHEN '3G' THEN 3 WHEN '2G' THEN 2 WHEN 'WIFI' THEN 1 END) AS o,
  strftime(max(t), '%Y-%m-%d') AS stat_date FROM x GROUP BY c)
SELECT 'u' || c_custkey AS uuid, c_mktsegment AS customer_id, 20240101 AS install_date,
  CASE o WHEN 4 THEN '4G' WHEN 3 THEN '3G' WHEN 2 THEN '2G' WHEN 1 THEN 'WIFI' ELSE 'Unknown' END AS link_type, stat_date
FROM customer LEFT JOIN m ON c = c_custkey""", log=False)
def best_network(v):
    n = F.col("l_linenumber")
    log = _lines(v, "l_linenumber").select("uuid", F.when(n == 1, "WIFI").when(n == 2, "2G").when(n == 3, "3G").when(n == 4, "4G")
                                           .otherwise("other").alias("link_type"), F.col("t").alias("create_time"))
    people = _fact_devices(v)
    stored = devices.best_network(None, log.where("create_time < '1995-06-01'"), people)
    return devices.best_network(stored, log.where("create_time >= '1995-06-01'"), people)


@query("device_flags", _LINES + """,
m AS (SELECT c, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS vpn, max(CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END) AS ph
  FROM l GROUP BY c)
SELECT 'u' || c_custkey AS uuid, c_mktsegment AS customer_id, 20240101 AS install_date, 0 AS isp_code,
  coalesce(vpn, -1) AS used_vpn, coalesce(ph, -1) AS has_phone FROM customer LEFT JOIN m ON c = c_custkey""", log=False)
def device_flags(v):
    log = _lines(v, "l_returnflag", "l_linenumber").select(
        "uuid", "t", (F.col("l_returnflag") == "R").cast("int").alias("apn"),
        F.when(F.col("l_linenumber") == 7, "139").alias("phone_num"))
    people = _fact_devices(v).withColumn("isp_code", F.lit(0))
    stored = devices.device_flags(None, log.where("t < '1998-01-01'"), people)
    return devices.device_flags(stored, log.where("t >= '1998-01-01'"), people)


# --- score and grades ------------------------------------------------------------------------

# The 200 days before the day of the scores.
_SIGNAL_WINDOW = "o_orderdate >= date '1998-07-01' - interval 200 days AND o_orderdate < date '1998-07-01'"


def _bases(v, rows=None):
    """Raw signal logs of the last orders of every customer, or of the given lines."""
    if rows is None:
        rows = _lines(v, "l_suppkey", "l_quantity", "l_partkey", "l_linenumber", "l_returnflag", "l_discount")
    rows = rows.withColumn("customer_id", F.lit("c"))
    at = lambda name: F.col("t").alias(name)
    pick = lambda *c: rows.select("uuid", "customer_id", *c)
    pkg = F.when(F.col("l_linenumber") == 1, "com.android.phone").when(F.col("l_linenumber") == 2, "com.android.mms").otherwise("other")
    return {
        "stations": pick(F.col("l_suppkey").alias("station_code"), at("log_time")),
        "locked": pick(F.col("l_quantity").cast("int").alias("unlock_cnt"), at("unlock_log_date")),
        "app_used": pick(pkg.alias("pkg_name"), F.col("l_linenumber").alias("open_cnt"), at("app_used_date")),
        "app_install": pick(at("app_log_date")),
        "accounts": pick(F.col("l_returnflag").alias("acc_name"), F.lit("t").alias("acc_type"), at("create_time")),
        "links": pick((F.col("l_linenumber") % 4).cast("string").alias("link_type"), at("create_time")),
    }


_ROLLUPS = {
    "stations": "SELECT DISTINCT 'u' || c AS uuid, 'c' AS customer_id, l_suppkey AS station_code, {d} AS create_date FROM l",
    "locked": "SELECT 'u' || c AS uuid, 'c' AS customer_id, {d} AS create_date, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT)"
              " AS unlock_count FROM l GROUP BY ALL",
    "app_used": "SELECT 'u' || c AS uuid, 'c' AS customer_id, {d} AS create_date, CAST(sum(l_linenumber) AS BIGINT)"
                " AS app_used_count FROM l WHERE l_linenumber IN (1, 2) GROUP BY ALL",
    "app_install": "SELECT 'u' || c AS uuid, 'c' AS customer_id, {d} AS create_date, count(*) AS app_install_count FROM l GROUP BY ALL",
    "accounts": "SELECT DISTINCT 'u' || c AS uuid, 'c' AS customer_id, l_returnflag AS acc_name, 't' AS acc_type, {d} AS create_date FROM l",
    "links": "SELECT DISTINCT 'u' || c AS uuid, 'c' AS customer_id, CAST(l_linenumber % 4 AS VARCHAR) AS link_type, {d} AS create_date FROM l",
}


def _rollup_query(name: str):
    @query(f"daily_signal_{name}", _LINES + " " + _ROLLUPS[name].format(d=day_int("t")), log=False)
    def run(v):
        return devices.daily_signal_rollups({name: _bases(v)[name]})[name]


for _name in _ROLLUPS:
    _rollup_query(_name)


def _score_signals(v):
    """All signals in one pass over the line items of the window; the per-day tables have queries of
    their own."""
    rows = _lines(v, "l_suppkey", "l_quantity", "l_linenumber", "l_returnflag", "l_discount",
                  where=_SIGNAL_WINDOW)
    n = F.col("l_linenumber")
    signal = lambda name, value=F.lit(None), amount=F.lit(None): F.struct(
        F.lit(name).alias("signal"), value.cast("string").alias("value"), amount.cast("long").alias("amount"))
    power = F.round(F.col("l_discount") * 100).cast("int")
    every = F.array(
        F.when(power > 0, signal("power", power)), signal("station", F.col("l_suppkey")), signal("locked", amount=F.col("l_quantity").cast("int")),
        F.when(n.isin(1, 2), signal("app_used", amount=n)), signal("link", n % 4), signal("app_install", amount=F.lit(1)),
        signal("account", F.concat("l_returnflag", F.lit("t"))), signal("active"))
    stacked = (rows.select("uuid", F.date_format("t", "yyyyMMdd").cast("int").alias("day"), F.explode(every).alias("s"))
               .where("s IS NOT NULL").select("uuid", "day", "s.*"))
    counts = scoring.count_signals(stacked)
    n = F.col("c_nationkey")
    info = v.table("customer").where("c_acctbal > 0").select(
        F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("uuid"), (n % 2).alias("changed_mac"), (n % 3).alias("used_vpn"),
        (n.cast("long") * 20000000).alias("uptime"), F.when(n % 5 > 0, n % 2).alias("has_phonenum"))
    return scoring.device_score_signals(info, counts)


def _day_table_signals(v):
    """The same signals through the per-day tables.

    The lines of the window are joined once and written, and so is every per-day table, as the
    stored table that it is: a task that sums up a table does not hold the sums that are made from
    it as well, and no more of a table than its share of the shuffle. The orders of the window are
    hashed, so that the lines, which are many more, need not be sorted.
    """
    rows = written(_lines(v, "l_suppkey", "l_quantity", "l_linenumber", "l_returnflag", "l_discount", where=_SIGNAL_WINDOW,
                          hint="shuffle_hash"), "lines")
    daily_bases = {name: written(df, name) for name, df in devices.daily_signal_rollups(_bases(v, rows)).items()}
    date = F.date_format("t", "yyyyMMdd").cast("int").alias("create_date")
    return scoring.signal_counts({
        "power": rows.select("uuid", F.round(F.col("l_discount") * 100).cast("int").alias("power"), date),
        "station": daily_bases["stations"], "locked": daily_bases["locked"], "app_used": daily_bases["app_used"],
        "link": daily_bases["links"], "app_install": daily_bases["app_install"], "account": daily_bases["accounts"],
        "active": written(rows.select("uuid", date).distinct(), "active"),
    }, "1998-07-01", days=200)


@query("signal_counts", _LINES + """,
w AS (SELECT * FROM l WHERE t >= DATE '1998-07-01' - 200 AND t < DATE '1998-07-01'),
k AS (SELECT c, t, sum(CAST(l_quantity AS INTEGER)) AS locked FROM w GROUP BY c, t)
SELECT 'u' || w.c AS uuid,
  CASE WHEN count(*) FILTER (CAST(l_discount * 100 AS INTEGER) > 0) > 0
    THEN count(DISTINCT CAST(l_discount * 100 AS INTEGER)) FILTER (CAST(l_discount * 100 AS INTEGER) > 0) END AS power,
  count(DISTINCT l_suppkey) AS station, count(DISTINCT k.locked) AS locked,
  CAST(sum(l_linenumber) FILTER (l_linenumber IN (1, 2)) AS BIGINT) AS app_used,
  count(DISTINCT l_linenumber % 4) AS link, count(*) AS app_install, count(DISTINCT (w.t, l_returnflag)) AS account, count(DISTINCT w.t) AS active
FROM w JOIN k ON w.c = k.c AND w.t = k.t GROUP BY w.c""", log=False)
def signal_counts(v):
    return _day_table_signals(v)


def _rule_sql(count: str, ids: tuple) -> str:
    return f"CASE WHEN {count} = 0 THEN {ids[0]} WHEN {count} = 1 THEN {ids[1]} WHEN {count} < 5 THEN {ids[2]} ELSE {ids[3]} END"


_SCORE = _LINES + f""",
w AS (SELECT * FROM l WHERE t >= DATE '1998-07-01' - 200 AND t < DATE '1998-07-01'),
i AS (SELECT c_custkey AS c, c_nationkey AS n FROM customer WHERE c_acctbal > 0),
k AS (SELECT c, sum(CAST(l_quantity AS INTEGER)) AS locked, sum(l_linenumber) FILTER (l_linenumber IN (1, 2)) AS used FROM w GROUP BY c, t),
g AS (
  SELECT c, CASE WHEN n % 2 = 1 THEN 1 ELSE 2 END AS rule FROM i
  UNION ALL SELECT c, CASE WHEN n % 3 = 1 THEN 3 ELSE 4 END FROM i
  UNION ALL SELECT c, CASE WHEN n * 20000000 / 86400000.0 < 1 THEN 5 WHEN n * 20000000 / 86400000.0 > 3 THEN 6 ELSE 7 END FROM i
  UNION ALL SELECT c, CASE WHEN n % 5 > 0 AND n % 2 = 1 THEN 8 ELSE 9 END FROM i
  UNION ALL SELECT c, {_rule_sql('count(DISTINCT CAST(l_discount * 100 AS INTEGER))', (10, 11, 12, 13))} FROM w
    WHERE CAST(l_discount * 100 AS INTEGER) > 0 GROUP BY c
  UNION ALL SELECT c, {_rule_sql('count(DISTINCT l_suppkey)', (14, 15, 16, 17))} FROM w GROUP BY c
  UNION ALL SELECT c, {_rule_sql('count(DISTINCT locked)', (18, 19, 20, 21))} FROM k GROUP BY c
  UNION ALL SELECT c, CASE WHEN sum(used) = 0 THEN 22 WHEN sum(used) < 10 THEN 23 ELSE 24 END FROM k WHERE used IS NOT NULL GROUP BY c
  UNION ALL SELECT c, CASE WHEN count(DISTINCT l_linenumber % 4) > 2 THEN 25 ELSE 26 END FROM w GROUP BY c
  UNION ALL SELECT c, CASE WHEN count(*) > 3 THEN 27 ELSE 28 END FROM w GROUP BY c
  UNION ALL SELECT c, 29 FROM w GROUP BY c
  UNION ALL SELECT c, CASE WHEN count(DISTINCT t) = 1 THEN 31 WHEN count(DISTINCT t) > 3 THEN 32 ELSE 33 END FROM w GROUP BY c)"""


@query("score_log", _SCORE + " SELECT 'u' || c AS uuid, rule AS rule_id, '1998-07-01' AS create_date FROM g", log=False)
def score_log(v):
    return scoring.score_log(_score_signals(v), "1998-07-01")


_POINTS = " UNION ALL ".join(f"SELECT {i} AS id, {s} AS score" for i, s in scoring.RULE_SCORES.items())


@query("score_devices", _SCORE + f""", p AS ({_POINTS})
SELECT 'u' || c AS uuid, '1998-07-01' AS create_date, CAST(sum(score) AS BIGINT) AS score, count(*) AS rule_count
FROM g JOIN p ON rule = id GROUP BY c""", log=False)
def score_devices(v):
    return scoring.score_devices(_score_signals(v), scoring.rule_table(v.spark), "1998-07-01")


def _channel_tables(v):
    """Channels are suppliers; ratios come from their account balance and nation."""
    s = v.table("supplier")
    x = F.pmod(F.floor(F.col("s_acctbal")).cast("long"), F.lit(1000)) / 1000
    y = F.pmod(F.col("s_suppkey") * 37, F.lit(100)) / 100
    ident = F.concat(F.lit("ch"), F.col("s_suppkey").cast("string")).alias("channel_id")
    keep = s.select(ident, (F.col("s_suppkey") % 90 + 40).alias("user_count"), F.round(x / 2, 3).alias("keep_pct_1"),
                    F.round(x / 3, 3).alias("keep_pct_3"), F.round(x / 6, 3).alias("keep_pct_6"))
    quality = s.select(ident, F.round(y / 4, 3).alias("vpn_pct"), F.round(1 - y, 3).alias("phone_pct"),
                       *[y.alias(c) for c in ("network_pct", "runtime_pct", "battery_pct", "station_pct")])
    return keep, quality


_GRADES = """s AS (SELECT 'ch' || s_suppkey AS channel_id, s_suppkey % 90 + 40 AS user_count,
  (CAST(floor(s_acctbal) AS BIGINT) % 1000 + 1000) % 1000 / 1000.0 AS x, (s_suppkey * 37) % 100 / 100.0 AS y FROM supplier),
q AS (SELECT channel_id, user_count, round(x / 2, 3) AS k1, round(x / 3, 3) AS k3, round(x / 6, 3) AS k6, round(y / 4, 3) AS vpn,
  round(1 - y, 3) AS phone, y FROM s),
g AS (SELECT *, CASE
  WHEN user_count > 50 AND k1 > 0.3 AND k3 > 0.2 AND k6 > 0.1 AND vpn < 0.05 AND phone > 0.6 AND y < 0.6 THEN 'A'
  WHEN user_count > 50 AND k1 > 0.15 AND k3 > 0.1 AND k6 > 0.05 AND vpn < 0.15 AND phone > 0.2 AND y < 0.85 THEN 'B'
  WHEN user_count > 50 AND k1 > 0.1 AND k3 > 0.05 AND k6 > 0.02 AND vpn < 0.3 AND phone > 0.1 AND y < 0.95 THEN 'C'
  WHEN user_count > 50 AND (k1 < 0.05 OR k3 < 0.02 OR k6 < 0.01) AND (vpn > 0.6 OR phone < 0.05 OR y > 0.98) THEN 'E'
  ELSE 'D' END AS channel_rank FROM q)"""


@query("grade_channels", _GRADES + """
SELECT channel_id, user_count, k1 AS keep_pct_1, k3 AS keep_pct_3, k6 AS keep_pct_6, vpn AS vpn_pct, phone AS phone_pct,
  y AS network_pct, y AS runtime_pct, y AS battery_pct, y AS station_pct, channel_rank, '20240131' AS stat_date FROM g""", log=False)
def grade_channels(v):
    return scoring.grade_channels(*_channel_tables(v), "20240131")


_PCT = "CASE WHEN {0} = 0 THEN '' ELSE printf('%.2f%%', CAST({0} AS DOUBLE) * 100) END AS {1}"


@query("bad_channels", _GRADES + " SELECT channel_id, channel_rank, user_count, " + ", ".join(
    _PCT.format(c, n) for c, n in (("k1", "keep_pct_1"), ("k3", "keep_pct_3"), ("k6", "keep_pct_6"), ("vpn", "vpn_pct"),
                                   ("phone", "phone_pct"), ("y", "network_pct"), ("y", "runtime_pct"), ("y", "battery_pct"),
                                   ("y", "station_pct"))) + " FROM g WHERE channel_rank IN ('D', 'E')", log=False)
def bad_channels(v):
    return daily.channel_report(*_channel_tables(v), "20240131")


# --- roll-ups --------------------------------------------------------------------------------

def _sets_sql(base: str, rules, columns) -> str:
    parts = []
    for code, cols in rules:
        shown = ", ".join(c if c in cols else f"NULL AS {c}" for c in columns)
        parts.append(f"SELECT '{code}' AS rule, {shown}, count(*) AS fact_count FROM {base} GROUP BY {', '.join(cols)}")
    return " UNION ALL ".join(parts)


def _as_cte(sql: str, name: str) -> str:
    """Turn ``ctes SELECT ...`` into ``ctes, name AS (SELECT ...)``."""
    at = sql.rindex("\nSELECT")
    return f"{sql[:at]}, {name} AS ({sql[at:]})\n"


@query("rollup_new", _as_cte(NEW_USERS_SQL, "nu") + _sets_sql("nu", daily.NEW_RULES, ["create_date", "channel_code", "area"]))
def rollup_new(v):
    return daily.new_user_cube(v.visit_ad)


@query("rollup_active", _as_cte(DAILY_ACTIVE_SQL, "da") + _sets_sql(
    "da", daily.ACTIVE_RULES, ["active_date", "create_date", "date_diff", "channel_code", "area"]))
def rollup_active(v):
    return daily.activity_cube(v.visit_ad)


def _rollup_clients(v):
    merged = merge.merge_clients(None, v.clients)
    return merge.client_flags(merged, "2024-01-31").select(
        "app_key", "create_date", F.col("clnt").alias("customer_id"), F.col("app_path").alias("pkg_path"), "version", "is_upgrade")


_CLIENT_ROWS = f"""cl AS (SELECT event_type AS app_key, CAST(strftime(min(ts), '%Y%m%d') AS INTEGER) AS create_date, min(CAST(ts AS DATE)) AS born,
  arg_min(channel, ts) AS customer_id, arg_min(k % 6, ts) AS pkg_path, arg_max(version, ts) AS version,
  CASE WHEN arg_min(version, ts) <> arg_max(version, ts) THEN 1 ELSE 0 END AS is_upgrade FROM log GROUP BY uid, event_type)"""


@query("client_rollups", _CLIENT_ROWS + " " + _sets_sql(
    "cl", rollup.CLIENT_RULES, ["app_key", "create_date", "customer_id", "pkg_path", "version", "is_upgrade"]))
def client_rollups(v):
    return rollup.client_rollups(_rollup_clients(v), dims.dim_date(v.spark, "2024-01-01", "2024-12-31"))["sets"]


@query("client_calendar", _CLIENT_ROWS + """
SELECT app_key, year(born) AS the_year, CASE WHEN month(born) <= 6 THEN 1 ELSE 2 END AS half_year, quarter(born) AS the_quarter,
  month(born) AS month_of_year, count(*) AS fact_count FROM cl GROUP BY ALL""")
def client_calendar(v):
    return rollup.client_rollups(_rollup_clients(v), dims.dim_date(v.spark, "2024-01-01", "2024-12-31"))["calendar"]


# Two names for one set, a set in another order and a column named twice.
def _days_with_redone_ones(rows, col, days):
    """All days but the last three at once as the stored table, then those day by day: one with
    half of its rows first, one with rows that belong to nobody, and both done again."""
    wrong = rows.where((F.col(col) == days[0]) & F.col("aid").endswith("1"))
    other = rows.where(F.col(col) == days[1]).withColumn("area", F.lit("wrong"))
    return [(days[0], wrong), (days[1], other), (days[2], rows), (days[1], rows), (days[0], rows), (days[0], rows)]


def _through_days(v, rows, rules, col, days):
    path = scratch(v.spark, "rollup")
    first = rows.where(~F.col(col).isin(days))
    bucketed.write_bucketed(rollup.apply_delta(None, rollup.rollup_delta(rollup.finest_counts(first, rules, "aid"), None, rules)), path, ["group"], 8)
    for day, some in _days_with_redone_ones(rows, col, days):
        def step(stored, new, co_located=False):
            return rollup.refresh_day(stored, new, rules, "aid", col, day, co_located)
        table = bucketed.update_bucketed(v.spark, path, some, step, ["group"], 8)
    return rollup.stored_counts(table)


@query("rollup_new_refreshed", _as_cte(NEW_USERS_SQL, "nu") + _sets_sql("nu", daily.NEW_RULES, ["create_date", "channel_code", "area"]))
def rollup_new_refreshed(v):
    """A stored roll-up brought up to date by day, with days that are done again."""
    return _through_days(v, merge.merge_new_users(None, v.visit_ad), daily.NEW_RULES, "create_date", [20240102, 20240103, 20240104])


@query("rollup_active_refreshed", _as_cte(DAILY_ACTIVE_SQL, "da") + _sets_sql(
    "da", daily.ACTIVE_RULES, ["active_date", "create_date", "date_diff", "channel_code", "area"]))
def rollup_active_refreshed(v):
    rows = activity.daily_active(v.visit_ad, merge.merge_new_users(None, v.visit_ad))
    return _through_days(v, rows, daily.ACTIVE_RULES, "active_date", [20240128, 20240129, 20240130])


_RULE_TEXT = """
l_1 channel_code
l_2 area
l_3 channel_code,area
l_4 channel_code
l_5 area,channel_code
l_6 area,area
"""


@query("rollup_rules", _as_cte(NEW_USERS_SQL, "nu") + _sets_sql(
    "nu", [("l_1", ["channel_code"]), ("l_2", ["area"]), ("l_3", ["channel_code", "area"]), ("l_4", ["channel_code"]),
           ("l_5", ["area", "channel_code"]), ("l_6", ["area"])], ["channel_code", "area"]))
def rollup_rules(v):
    return rollup.rollup_new(merge.merge_new_users(None, v.visit_ad), rollup.parse_rules(_RULE_TEXT))
