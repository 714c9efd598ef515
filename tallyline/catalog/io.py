"""Queries that write the given tables in the shape of a log or table and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.catalog.registry import day_int, query, ts_text
from tallyline.catalog.state import NEW_USERS_SQL
from tallyline.operators import merge
from tallyline.session import scratch
from tallyline.sinks import ledger
from tallyline.sinks import tables as sinks
from tallyline.sources import checked, logs
from tallyline.sources import tables as sources
from tallyline.sources.streams import read_file_messages
from tallyline.streaming import new_users
from tallyline.streaming.channel_counts import read_stored_counts, start_stored_counts

_VISIT_SQL = f"""SELECT uid AS udid, event_type AS apppkg, channel AS clnt, version AS appversion, {ts_text('ts')} AS createtime FROM log"""


def _visits(v):
    return v.log.select(F.col("uid").alias("udid"), F.col("event_type").alias("apppkg"), F.col("channel").alias("clnt"),
                        F.col("version").alias("appversion"), F.col("ts").alias("createtime"))


_VISIT_SCHEMA = "udid string, apppkg string, clnt string, appversion string, createtime timestamp"


def _dated_logs(v) -> str:
    root = scratch(v.spark, "logs")
    sinks.split_by_event_date(_visits(v), f"{root}/visit")
    return root


@query("read_json_logs", _VISIT_SQL + " WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-11'")
def read_json_logs(v):
    """Split by event date, then a date range of directories."""
    return logs.read_json_logs(v.spark, _dated_logs(v), "visit", "2024-01-03", "2024-01-10", _VISIT_SCHEMA, layout=logs.DATE_LAYOUT)


@query("read_day_logs", _VISIT_SQL + " WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-06'")
def read_day_logs(v):
    """A third of the lines arrives in the directory of the next day."""
    root = scratch(v.spark, "late")
    day = F.when(F.col("apppkg").isin("view", "click"), F.date_add("createtime", 1)).otherwise(F.to_date("createtime"))
    (_visits(v).withColumn("event_date", F.date_format(day, "yyyy-MM-dd")).write.partitionBy("event_date")
     .json(f"{root}/visit", timestampFormat=sinks.TIMESTAMP_TEXT))
    return logs.read_day_logs(v.spark, root, "visit", "2024-01-05", _VISIT_SCHEMA, layout=logs.DATE_LAYOUT)


@query("split_by_event_date", f"SELECT strftime(ts, '%Y-%m-%d') AS event_date, count(*) AS n, count(DISTINCT uid) AS users FROM log GROUP BY 1")
def split_by_event_date(v):
    rows = v.spark.read.json(f"{_dated_logs(v)}/visit", schema=_VISIT_SCHEMA + ", event_date string")
    return rows.groupBy("event_date").agg(F.count("*").alias("n"), F.count_distinct("udid").alias("users"))


@query("rehome_files", f"""SELECT strftime(ts, '%Y-%m-%d') AS event_date, channel AS clnt, count(*) AS n, count(DISTINCT uid) AS users FROM log
GROUP BY ALL""")
def rehome_files(v):
    """Files are delivered by halves and taken after each delivery; the last run finds nothing new."""
    root, rows = scratch(v.spark, "rehome"), _visits(v)
    for test in ("apppkg IN ('view', 'click')", "apppkg NOT IN ('view', 'click')", "false"):
        rows.where(test).write.mode("append").json(f"{root}/in", timestampFormat=sinks.TIMESTAMP_TEXT)
        for _ in range(2):
            ledger.rehome_files(v.spark, f"{root}/in/*.json", f"{root}/out", _VISIT_SCHEMA)
    found = ledger.read_rehomed(v.spark, f"{root}/out", _VISIT_SCHEMA)
    return found.groupBy("event_date", "clnt").agg(F.count("*").alias("n"), F.count_distinct("udid").alias("users"))


def _damaged(v):
    """JSON lines of the log, some cut short, some with a text for a number, some without a user, some blank."""
    n, k = F.col("event_id"), F.col("k")
    line = F.to_json(F.struct(F.when(n % 10 != 3, F.col("uid")).alias("udid"), k.alias("k"), F.col("channel").alias("clnt")))
    odd = F.to_json(F.struct(F.col("uid").alias("udid"), F.lit("many").alias("k")))
    line = (F.when(n % 10 == 0, F.substring(line, 1, 12)).when(n % 10 == 1, odd).when(n % 10 == 2, "  ").otherwise(line))
    path = scratch(v.spark, "damaged")
    v.log.select(line.alias("value")).write.text(path)
    return checked.read_checked(v.spark, path, "udid string, k int, clnt string", scratch(v.spark, "checked"), required=["udid"])


@query("checked_good_rows", "SELECT uid AS udid, k, channel AS clnt FROM log WHERE event_id % 10 > 3")
def checked_good_rows(v):
    return _damaged(v).good


@query("checked_bad_lines", """
SELECT CASE event_id % 10 WHEN 3 THEN 'no udid' ELSE 'malformed' END AS reason, CASE event_id % 10
  WHEN 0 THEN substr('{"udid":"' || uid || '","k":' || k || ',"clnt":"' || channel || '"}', 1, 12)
  WHEN 1 THEN '{"udid":"' || uid || '","k":"many"}' ELSE '{"k":' || k || ',"clnt":"' || channel || '"}' END AS line
FROM log WHERE event_id % 10 IN (0, 1, 3)""")
def checked_bad_lines(v):
    return _damaged(v).bad.select("reason", "line")


@query("checked_counts", """SELECT count(*) AS lines, count(*) FILTER (event_id % 10 > 3) AS good, count(*) FILTER (event_id % 10 IN (0, 1, 3)) AS bad,
  count(*) FILTER (event_id % 10 = 2) AS blank FROM log""")
def checked_counts(v):
    return _damaged(v).counts.groupBy().agg(*[F.sum(c).alias(c) for c in ("lines", "good", "bad", "blank")])


@query("checked_events", "SELECT uid AS deviceid, k FROM log WHERE event_id % 5 > 0")
def checked_events(v):
    """Delimited lines of which every fifth has a column too few."""
    path = scratch(v.spark, "shorttsv")
    line = F.concat_ws("\t", "uid", F.col("k").cast("string"), "event_type")
    v.log.select(F.when(F.col("event_id") % 5 == 0, F.col("uid")).otherwise(line).alias("value")).write.text(path)
    return checked.read_checked(v.spark, path, "deviceid string, k int, kind string", scratch(v.spark, "checked"), "csv", sep="\t").good.drop("kind")


@query("api_rejects", """SELECT CASE WHEN k % 5 = 0 THEN 'malformed' WHEN k % 5 = 1 THEN 'no method' ELSE 'unknown method' END AS reason, count(*) AS n
FROM log WHERE k % 5 < 3 GROUP BY ALL""")
def api_rejects(v):
    k = F.col("k")
    method = F.when(k % 5 == 2, "app.api.other.list").when(k % 5 > 2, "app.api.information.list")
    line = F.to_json(F.struct(method.alias("Method"), F.col("uid").alias("UUID")))
    found = checked.api_rejects(v.log.select(F.when(k % 5 == 0, F.concat(line, F.lit("}{"))).otherwise(line).alias("value")).withColumn(
        "value", F.when(F.col("value").endswith("}{"), F.substring("value", 1, 8)).otherwise(F.col("value"))))
    return found.groupBy("reason").agg(F.count("*").alias("n"))


@query("read_delimited_events", "SELECT uid AS deviceid, event_type AS eventid, CAST(k AS VARCHAR) AS acc FROM log")
def read_delimited_events(v):
    path = scratch(v.spark, "tsv")
    rows = v.log.select(F.date_format("ts", "yyyy-MM-dd").alias("a"), F.lit("app").alias("b"), "uid", "version", "event_type",
                        F.col("k").cast("string").alias("acc"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("g"), F.lit("c").alias("h"),
                        F.lit("2").alias("i"))
    rows.write.csv(path, sep="\t")
    return logs.read_delimited_events(v.spark, path).select("deviceid", "eventid", "acc")


def _api_lines(v):
    """API log lines with a prefix before the JSON and keys in changing letter case."""
    k = F.col("k")
    method = F.when(k % 3 == 0, "app.api.information.list").when(k % 3 == 1, "app.api.information.browse").otherwise("app.api.information.index")
    line = F.when(k % 2 == 0, F.to_json(F.struct(method.alias("Method"), F.col("uid").alias("UUID"), k.cast("string").alias("categoryid"),
                                                 F.col("channel").alias("CLNT")))).otherwise(
        F.to_json(F.struct(method.alias("method"), F.col("uid").alias("udid"), k.cast("string").alias("informationId"),
                           F.col("channel").alias("clnt"))))
    return v.log.select(logs.strip_json_prefix(F.concat(F.lit("2024 host - "), line)).alias("value"))


def _api(route: str, rest: int, column: str | None, even: bool):
    shown = f", CASE WHEN k % 2 = {0 if even else 1} THEN CAST(k AS VARCHAR) END AS {column}" if column else ""

    @query(f"parse_api_log_{route}", f"SELECT uid AS udid, channel AS clnt{shown} FROM log WHERE k % 3 = {rest}")
    def run(v):
        rows = logs.parse_api_log(_api_lines(v))[route]
        return rows.select("udid", "clnt", *([column] if column else []))


_api("list", 0, "categoryId", True)
_api("browse", 1, "informationId", False)
_api("index", 2, None, True)


_COUNTS_SQL = f"SELECT {day_int('ts')} AS stat_date, event_type, count(*) AS n FROM log GROUP BY ALL"


def _daily_counts(v):
    return v.log.groupBy(F.date_format("ts", "yyyyMMdd").cast("int").alias("stat_date"), "event_type").agg(F.count("*").alias("n"))


@query("replace_range", f"c AS ({_COUNTS_SQL}) SELECT stat_date, event_type, CASE WHEN stat_date BETWEEN 20240105 AND 20240110 THEN n + 100 ELSE n END AS n "
                        "FROM c WHERE stat_date <> 20240108")
def replace_range(v):
    """Six days are replaced; one of them has no rows any more and must vanish."""
    path = scratch(v.spark, "range")
    counts = _daily_counts(v)
    sinks.replace_range(counts, path, "stat_date", 20240101, 20241231)
    again = counts.where("stat_date <> 20240108").withColumn("n", F.col("n") + 100)
    sinks.replace_range(again, path, "stat_date", 20240105, 20240110)
    return v.spark.read.parquet(path).select("stat_date", "event_type", "n")


@query("replace_partition", f"c AS ({_COUNTS_SQL}) SELECT stat_date, event_type, CASE WHEN stat_date = 20240130 THEN n + 100 ELSE n END AS n "
                            "FROM c WHERE stat_date > 20240110")
def replace_partition(v):
    """All days are stored at once; then one is replaced, twice, and those twenty days older go."""
    path = scratch(v.spark, "partition")
    counts = _daily_counts(v)
    counts.write.partitionBy("stat_date").parquet(path)
    last = counts.where("stat_date = 20240130")
    for more in (7, 100):
        sinks.replace_partition(last.withColumn("n", F.col("n") + more), path, 20240130, keep_days=20)
    return sources.read_partition(v.spark, path, 20240101, 20241231).select("stat_date", "event_type", "n")


@query("publish_snapshot", NEW_USERS_SQL)
def publish_snapshot(v):
    """Two daily runs, then the second is redone from the state before it."""
    path, log = scratch(v.spark, "snapshot"), v.visit_ad
    sinks.publish_snapshot(merge.merge_new_users(None, log.where("create_time < '2024-01-16'")), path, "20240115")
    late = log.where("create_time >= '2024-01-16'")
    wrong = late.withColumn("area", F.lit("wrong"))
    sinks.publish_snapshot(merge.merge_new_users(sinks.read_snapshot(v.spark, path), wrong), path, "20240116")
    before = sinks.restore_snapshot(v.spark, path, "20240116")
    sinks.publish_snapshot(merge.merge_new_users(before, late), path, "20240116")
    return sinks.read_snapshot(v.spark, path)


@query("overwrite_table", _COUNTS_SQL)
def overwrite_table(v):
    path = scratch(v.spark, "table")
    sinks.overwrite_table(_daily_counts(v).where("stat_date < 20240103"), path)
    sinks.overwrite_table(_daily_counts(v), path)
    return v.spark.read.parquet(path)


@query("export_table", "SELECT event_type, k, count(*) AS n FROM log WHERE channel <> 'BUILDING' GROUP BY ALL")
def export_table(v):
    path = scratch(v.spark, "export")
    for test in ("channel = 'MACHINERY'", "channel NOT IN ('MACHINERY', 'BUILDING')"):
        sinks.export_table(v.log, path, test)
    return v.spark.read.parquet(path).groupBy("event_type", "k").agg(F.count("*").alias("n"))


@query("publish_channels", f"""c AS (SELECT strftime(ts, '%Y-%m-%d') AS cdate, channel AS chacode, count(*) AS csum FROM log GROUP BY ALL)
SELECT 'in' AS target, * FROM c WHERE chacode IN ('BUILDING', 'FURNITURE') UNION ALL SELECT 'out', * FROM c WHERE chacode <> 'BUILDING'""")
def publish_channels(v):
    root = scratch(v.spark, "channels")
    daily = v.log.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("cdate"), F.col("channel").alias("chacode")).agg(F.count("*").alias("csum"))
    sinks.publish_channels(daily, {f"{root}/in": {"include": ["BUILDING", "FURNITURE"]}, f"{root}/out": {"exclude": ["BUILDING"]}})
    read = lambda t: v.spark.read.parquet(f"{root}/{t}").select(F.lit(t).alias("target"), F.col("cdate").cast("string"), "chacode", "csum")
    return read("in").unionByName(read("out"))


@query("read_range", _VISIT_SQL + " WHERE ts >= TIMESTAMP '2024-01-10 12:00:00' AND ts < TIMESTAMP '2024-01-12'")
def read_range(v):
    path = scratch(v.spark, "rangefile")
    _visits(v).write.parquet(path)
    return sources.read_range(v.spark, path, "createtime", "2024-01-10 12:00:00", "2024-01-12 00:00:00")


@query("stream_new_users", NEW_USERS_SQL)
def stream_new_users(v):
    """The log as messages in two deliveries; the first is compacted into a snapshot."""
    root, log = scratch(v.spark, "newusers"), v.visit_ad
    message = F.to_json(F.struct("aid", "channel_code", "area", "ip", F.date_format("create_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("create_time")))
    for i, test in enumerate(("create_time >= '2024-01-14'", "create_time < '2024-01-14'")):
        log.where(test).select(message.alias("value")).write.mode("append").text(f"{root}/in")
        new_users.stream_new_users(read_file_messages(v.spark, f"{root}/in"), f"{root}/out", f"{root}/checkpoint").awaitTermination()
        if i == 0:
            new_users.compact_new_users(v.spark, f"{root}/out", "20240130")
    return new_users.read_new_users(v.spark, f"{root}/out")


@query("stream_new_users_levels", NEW_USERS_SQL)
def stream_new_users_levels(v):
    """Many small batches, merged by levels of four while they come."""
    root, log = scratch(v.spark, "levels"), v.visit_ad
    message = F.to_json(F.struct("aid", "channel_code", "area", "ip", F.date_format("create_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("create_time")))
    log.select(message.alias("value")).repartition(10).write.text(f"{root}/in")
    new_users.stream_new_users(read_file_messages(v.spark, f"{root}/in", 1), f"{root}/out", f"{root}/checkpoint", fan=4).awaitTermination()
    return new_users.read_new_users(v.spark, f"{root}/out")


@query("stream_channel_counts_restarted", f"""
w AS (SELECT channel, unnest([0, 1]) AS back, ts FROM log),
x AS (SELECT channel, time_bucket(INTERVAL 5 MINUTE, ts) - back * INTERVAL 5 MINUTE AS s FROM w)
SELECT channel AS channel_code, {ts_text('s')} AS window_start, {ts_text('s + INTERVAL 10 MINUTE')} AS window_end, count(*) AS "count" FROM x GROUP BY channel, s""")
def stream_channel_counts_restarted(v):
    """Three deliveries in time order, cut inside windows; the query ends after each and goes on from its checkpoint."""
    root = scratch(v.spark, "restarted")
    message = F.to_json(F.struct(F.col("uid").alias("aid"), F.col("channel").alias("channel_code"),
                                 F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("create_time")))
    cuts = ["2000-01-01", "2024-01-09 10:03:00", "2024-01-20 00:06:00", "2100-01-01"]
    for low, high in zip(cuts, cuts[1:]):
        v.log.where((F.col("ts") >= low) & (F.col("ts") < high)).select(message.alias("value")).write.mode("append").text(f"{root}/in")
        start_stored_counts(read_file_messages(v.spark, f"{root}/in"), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return read_stored_counts(v.spark, f"{root}/out")
