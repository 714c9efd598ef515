"""Queries for content statistics, rankings, recommendation, dimensions, streams and table diffs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.catalog.registry import day_int, query, ts_text
from tallyline.functions import clean, dates, packed
from tallyline.operators import content, dims, ranking, recommend, similar
from tallyline.plans import daily
from tallyline.session import scratch
from tallyline.sinks import bucketed
from tallyline.sinks import tables as sinks
from tallyline.sources.streams import parse_messages
from tallyline.streaming.channel_counts import start_channel_counts, stream_channel_counts

_EV = """ev AS (SELECT event_id, ts, uid, CASE event_type WHEN 'view' THEN 'recreate_click' WHEN 'click' THEN 'video_click'
  WHEN 'purchase' THEN 'share' WHEN 'signup' THEN 'comments' ELSE 'search' END AS eventid, CAST(k AS VARCHAR) AS acc,
  CAST(event_id % 3 + 1 AS VARCHAR) AS label, version, strftime(ts, '%Y-%m-%d') AS d, channel FROM log)"""


@query("event_counts", _EV + """
SELECT channel AS customer_id, version, eventid AS event_id, d AS create_date, count(*) AS click_count,
  count(DISTINCT uid) AS user_count FROM ev GROUP BY ALL""")
def event_counts(v):
    return content.event_counts(v.events, v.channel_devices)


@query("event_counts_hourly", _EV + """
SELECT channel AS customer_id, version, eventid AS event_id, d AS create_date, hour(ts) AS create_hour,
  count(*) AS click_count, count(DISTINCT uid) AS user_count FROM ev GROUP BY ALL""")
def event_counts_hourly(v):
    return content.event_counts(v.events, v.channel_devices, by_hour=True)


@query("first_level_event", _EV + """
SELECT uid AS device_id, eventid AS event_id, d AS create_date, min(version) AS version, count(*) AS click_times,
  any_value(channel) AS customer_id FROM ev WHERE eventid IN ('share', 'search') GROUP BY uid, eventid, d""")
def first_level_event(v):
    return content.event_level(v.events, v.channel_devices, ["share", "search"])


@query("sub_level_event", _EV + """
SELECT uid AS device_id, eventid AS event_id, d AS create_date, acc, min(version) AS version, count(*) AS click_times,
  any_value(channel) AS customer_id FROM ev WHERE eventid IN ('share', 'search') GROUP BY uid, eventid, d, acc""")
def sub_level_event(v):
    return content.event_level(v.events, v.channel_devices, ["share", "search"], sub=True)


@query("category_share", _EV + """,
t AS (SELECT eventid, count(DISTINCT uid) AS total_count FROM ev GROUP BY eventid)
SELECT eventid, acc, count(DISTINCT uid) AS sub_count, any_value(total_count) AS total_count FROM ev JOIN t USING (eventid)
WHERE eventid IN ('recreate_click', 'video_click') GROUP BY eventid, acc""")
def category_share(v):
    return content.category_share(v.events, ["recreate_click", "video_click"])


_CONTENT = """ct AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS title, p_brand AS source, p_size AS content_type FROM part)"""


def _content(v):
    return v.table("part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("title"),
                                  F.col("p_brand").alias("source"), F.col("p_size").alias("content_type"))


_MEASURES = _EV + ", " + _CONTENT + """,
ck AS (SELECT acc, count(*) AS n, count(DISTINCT uid) AS u FROM ev WHERE eventid IN ('recreate_click', 'video_click') GROUP BY acc),
cm AS (SELECT acc, count(*) AS n, count(DISTINCT uid) AS u FROM ev WHERE eventid = 'comments' AND label IN ('1', '2') GROUP BY acc),
sh AS (SELECT acc, count(*) AS n, count(DISTINCT uid) AS u FROM ev WHERE eventid = 'share' AND label IN ('1', '2') GROUP BY acc)"""


@query("engagement", _MEASURES + """
SELECT ct.id, title, source, content_type, ck.n AS click_count, ck.u AS click_user, cm.n AS comment_count, cm.u AS comment_user,
  sh.n AS share_count, sh.u AS share_user FROM ck JOIN ct ON ck.acc = ct.id LEFT JOIN cm ON cm.acc = ck.acc
  LEFT JOIN sh ON sh.acc = ck.acc""")
def engagement(v):
    return content.engagement(v.events, _content(v))


@query("engagement_by_content", _MEASURES + """
SELECT ct.id, title, source, content_type, coalesce(ck.n, 0) AS click_count, coalesce(ck.u, 0) AS click_user,
  coalesce(cm.n, 0) AS comment_count, coalesce(cm.u, 0) AS comment_user, coalesce(sh.n, 0) AS share_count,
  coalesce(sh.u, 0) AS share_user, '20240101-20240131' AS date_range
FROM ct LEFT JOIN ck ON ck.acc = ct.id LEFT JOIN cm ON cm.acc = ct.id LEFT JOIN sh ON sh.acc = ct.id""")
def engagement_by_content(v):
    return content.engagement_by_content(_content(v), v.events, "20240101-20240131", content.INFO_EVENTS)


@query("content_clicks", _EV + """
SELECT acc, uid AS deviceid, d AS stat_date, count(*) AS click_count FROM ev
WHERE eventid IN ('recreate_click', 'video_click') AND d >= '2024-01-06' AND d <= '2024-02-04' GROUP BY ALL""")
def content_clicks(v):
    return content.recent_content_clicks(content.content_clicks(v.events), "2024-02-05")


@query("top_content", """
o AS (SELECT o_orderkey AS id, o_orderstatus AS content_type, o_orderpriority AS create_by, CAST(floor(o_totalprice) AS BIGINT) AS click_user
  FROM orders)
SELECT *, row_number() OVER (PARTITION BY content_type, create_by ORDER BY click_user DESC, id DESC) AS topn FROM o
QUALIFY topn <= 3""", log=False)
def top_content(v):
    rows = v.table("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("content_type"),
                                    F.col("o_orderpriority").alias("create_by"), F.floor("o_totalprice").alias("click_user"))
    return content.top_content(rows, 3)


@query("search_share", _EV + """
SELECT d AS date, count(DISTINCT uid) AS all_count, count(DISTINCT uid) FILTER (eventid = 'search') AS search_count FROM ev GROUP BY d""")
def search_share(v):
    return content.search_share(v.events)


def _stars(v):
    """Suppliers are stars; line items give fans, posts and comments, events the visits."""
    li = v.table("lineitem").select(F.col("l_suppkey").alias("star_id"), "l_returnflag", "l_linestatus", "l_linenumber")
    stars = v.table("supplier").select(F.col("s_suppkey").alias("star_id"), F.col("s_name").alias("real_name"))
    return (stars, v.events.where("eventid = 'recreate_click'"), li.where("l_returnflag = 'R'"),
            li.where("l_returnflag = 'A'").select("star_id", F.col("l_linenumber").alias("dynamic_num")),
            li.where("l_linestatus = 'O'"), li.where("l_linestatus = 'F' AND l_linenumber > 3"))


_STARS = _EV + """,
vi AS (SELECT CAST(acc AS BIGINT) AS s, count(*) AS c, count(DISTINCT uid) AS u FROM ev WHERE eventid = 'recreate_click' GROUP BY 1),
li AS (SELECT l_suppkey AS s, count(*) FILTER (l_returnflag = 'R') AS fans,
  CAST(sum(l_linenumber) FILTER (l_returnflag = 'A') AS BIGINT) AS dyn,
  count(*) FILTER (l_linestatus = 'O' AND l_suppkey > 0) AS posts, count(*) FILTER (l_linestatus = 'F' AND l_linenumber > 3) AS com
  FROM lineitem GROUP BY 1)"""


@query("star_daily", _STARS + """
SELECT s_suppkey AS star_id, s_name AS real_name, c AS click_count, u AS click_user, nullif(fans, 0) AS fans_count,
  dyn AS dynamic_num, nullif(posts, 0) AS post_count, nullif(com, 0) AS comment_count
FROM supplier LEFT JOIN vi ON vi.s = s_suppkey LEFT JOIN li ON li.s = s_suppkey""")
def star_daily(v):
    return content.star_daily(*_stars(v))


@query("star_daily_outer", _STARS + """
SELECT coalesce(vi.s, li.s) AS star_id, s_name AS real_name, coalesce(c, 0) AS click_count, coalesce(u, 0) AS click_user,
  coalesce(fans, 0) AS fans_count, coalesce(dyn, 0) AS dynamic_num, coalesce(posts, 0) AS post_count, coalesce(com, 0) AS comment_count
FROM vi FULL JOIN li ON vi.s = li.s LEFT JOIN supplier ON s_suppkey = coalesce(vi.s, li.s)""")
def star_daily_outer(v):
    return content.star_daily_outer(*_stars(v))


@query("content_summary", _EV + """,
b AS (SELECT p_partkey AS id, 1 AS m, p_brand AS source, p_name AS title, '2024-01-01' AS publish_time, p_type AS create_by FROM part
  UNION ALL SELECT s_suppkey, 2, NULL, s_name, '2024-01-02', 'sup' FROM supplier),
c AS (SELECT CASE eventid WHEN 'recreate_click' THEN 1 ELSE 2 END AS m, acc, count(*) AS n, count(DISTINCT uid) AS u FROM ev
  WHERE eventid IN ('recreate_click', 'video_click') GROUP BY ALL),
s AS (SELECT CAST(label AS INTEGER) AS m, acc, count(*) AS n FROM ev WHERE eventid = 'share' AND label IN ('1', '2') GROUP BY ALL),
x AS (SELECT l_partkey AS id, count(*) AS cm, CAST(sum(l_linenumber) AS BIGINT) AS pr FROM lineitem GROUP BY 1)
SELECT source, title, publish_time, create_by, CASE WHEN b.m = 1 THEN coalesce(cm, 0) ELSE 0 END AS comment_count,
  CASE WHEN b.m = 1 THEN coalesce(pr, 0) ELSE 0 END AS praise_count, coalesce(c.n, 0) AS click_count, coalesce(c.u, 0) AS user_count,
  coalesce(s.n, 0) AS share_count, CAST(b.id AS BIGINT) AS id, b.m AS model_id
FROM b LEFT JOIN x ON x.id = b.id LEFT JOIN c ON c.m = b.m AND c.acc = CAST(b.id AS VARCHAR)
LEFT JOIN s ON s.m = b.m AND s.acc = CAST(b.id AS VARCHAR)""")
def content_summary(v):
    articles = v.table("part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("source"), F.col("p_name").alias("title"),
                                      F.lit("2024-01-01").alias("publish_time"), F.col("p_type").alias("create_by"))
    videos = v.table("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("title"),
                                        F.lit("2024-01-02").alias("create_time"), F.lit("sup").alias("create_by"))
    sns = (v.table("lineitem").groupBy(F.col("l_partkey").alias("bussiness_id"))
           .agg(F.count("*").alias("comment_count"), F.sum("l_linenumber").alias("praise_count"))
           .withColumn("model_id", F.lit(1)))
    return content.content_summary(articles, videos, sns, v.events)


@query("weekly_report", """
SELECT p_brand AS id, any_value(p_brand || ' maker') AS title, CAST(sum(l_linenumber) AS BIGINT) AS click_count,
  CAST(sum(l_quantity) AS BIGINT) AS user_count, '19980105-19980111' AS date_range, any_value(r_regionkey) AS category_id,
  any_value(r_name) AS category_name
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN region ON r_regionkey = length(p_brand) % 5
WHERE l_shipdate >= DATE '1998-01-05' AND l_shipdate < DATE '1998-01-12' GROUP BY p_brand""", log=False)
def weekly_report(v):
    parts = v.table("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("id"))
    daily_rows = (v.table("lineitem").select("l_partkey", dates.date_int("l_shipdate").alias("create_date"),
                                             F.col("l_linenumber").alias("click_count"),
                                             F.col("l_quantity").cast("long").alias("user_count"))
                  .join(parts, "l_partkey"))
    described = parts.select("id").distinct().select("id", F.concat("id", F.lit(" maker")).alias("title"),
                                                    (F.length("id") % 5).alias("category_id"))
    categories = v.table("region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    return content.weekly_report(daily_rows, 19980105, 19980111, ["id"], ["click_count", "user_count"],
                                 content=described, categories=categories)


@query("counter_increment", """
c AS (SELECT k, count(*) AS n FROM log WHERE event_type = 'click' AND event_id % 2 = 1 AND k NOT IN (SELECT n_nationkey FROM nation)
  GROUP BY k)
SELECT s_suppkey AS game_id, CAST(s_nationkey AS BIGINT) + coalesce(n, 0) AS click_num FROM supplier LEFT JOIN c ON k = s_suppkey""")
def counter_increment(v):
    current = v.table("supplier").select(F.col("s_suppkey").alias("game_id"), F.col("s_nationkey").cast("long").alias("click_num"))
    clicks = v.log.select(F.when(F.col("event_type") == "click", "game_click").alias("eventid"), F.col("k").cast("string").alias("acc"),
                          (F.col("event_id") % 2 + 1).cast("string").alias("label"))
    done = v.table("nation").select(F.col("n_nationkey").cast("long").alias("game_id"))
    return content.counter_increment(current, clicks, done)


_STATE_OF = {"O": 6, "F": 9, "P": 3}


def _runs(v):
    """Orders are job runs: the status is the state, the price the seconds."""
    o = v.table("orders")
    state = F.when(F.col("o_orderstatus") == "O", 6).when(F.col("o_orderstatus") == "F", 9).otherwise(3)
    start = F.col("o_orderdate").cast("timestamp")
    return o.select(F.col("o_custkey").alias("task_id"), start.alias("run_time"), state.alias("task_state"), start.alias("start_time"),
                    F.timestamp_add("SECOND", F.floor("o_totalprice").cast("int"), start).alias("end_time"),
                    F.col("o_orderkey").alias("tried_times"))


def _tasks(v):
    return v.table("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                      F.col("c_mktsegment").alias("task_group"))


@query("job_states", f"""
SELECT {day_int('o_orderdate')} AS run_date, CASE o_orderstatus WHEN 'O' THEN '运行成功' WHEN 'F' THEN '运行失败' ELSE '正在运行' END
  AS state, count(*) AS run_count FROM orders WHERE o_orderdate >= DATE '1996-01-01' GROUP BY ALL""", log=False)
def job_states(v):
    return content.job_states(_runs(v), "1996-01-01", clean.TASK_STATE)


@query("failed_jobs", f"""
m AS (SELECT o_custkey AS c, o_orderdate AS d, min(l_returnflag || l_linenumber) AS content FROM orders JOIN lineitem
  ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT o_custkey AS task_id, {ts_text('o_orderdate')} AS run_time, o_orderkey AS tried_times, content, c_name AS name,
  c_mktsegment AS task_group FROM orders JOIN m ON c = o_custkey AND d = o_orderdate JOIN customer ON c_custkey = o_custkey
WHERE o_orderstatus = 'F'""", log=False)
def failed_jobs(v):
    o = v.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("task_id"),
                                 F.col("o_orderdate").cast("timestamp").alias("run_time"))
    logs = (v.table("lineitem").select("l_orderkey", F.concat("l_returnflag", F.col("l_linenumber").cast("string")).alias("content"))
            .join(o, "l_orderkey").withColumn("level", F.lit(3)))
    return content.failed_jobs(_runs(v), logs, _tasks(v), "1990-01-01").select(
        "task_id", "run_time", "tried_times", "content", "name", "task_group")


@query("slowest_jobs", f"""
SELECT o_custkey AS task_id, {ts_text('o_orderdate')} AS run_time, o_orderkey AS tried_times,
  round(floor(o_totalprice) / 60, 2) AS minutes, c_name AS name FROM orders JOIN customer ON c_custkey = o_custkey
ORDER BY minutes DESC, task_id, run_time LIMIT 10""", log=False)
def slowest_jobs(v):
    return content.slowest_jobs(_runs(v), _tasks(v), "1990-01-01").select("task_id", "run_time", "tried_times", "minutes", "name")


# --- rankings --------------------------------------------------------------------------------

def _fans(v):
    """Orders are a fan's month index with a star: the star is the customer's segment."""
    people = v.table("customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("star_id"))
    o = v.table("orders").select(F.col("o_custkey").alias("user_id"), F.floor("o_totalprice").alias("total_index"),
                                 F.col("o_orderdate").cast("timestamp").alias("update_time"), "o_orderkey")
    return o.join(people, "user_id").withColumns({"year": F.year("update_time"), "month": F.month("update_time")})


_FANS = """f AS (SELECT o_custkey AS user_id, CAST(floor(o_totalprice) AS BIGINT) AS total_index, o_orderdate AS t, o_orderkey,
  c_mktsegment AS star_id, year(o_orderdate) AS year, month(o_orderdate) AS month FROM orders JOIN customer ON c_custkey = o_custkey)"""


@query("top_global", f"""
SELECT o_orderkey AS fan_id, CAST(floor(o_totalprice) AS BIGINT) AS love_index, {ts_text('o_orderdate')} AS update_time FROM orders
ORDER BY love_index DESC, o_orderdate, o_orderkey LIMIT 5""", log=False)
def top_global(v):
    rows = _fans(v).select(F.col("o_orderkey").alias("fan_id"), F.col("total_index").alias("love_index"), "update_time")
    return ranking.top_global(rows)


@query("top_per_group", _FANS + f"""
SELECT star_id, o_orderkey, user_id, total_index, {ts_text('t')} AS update_time, row_number() OVER (PARTITION BY star_id
  ORDER BY total_index DESC, t, o_orderkey) AS topn FROM f QUALIFY topn <= 10""", log=False)
def top_per_group(v):
    return ranking.top_per_group(_fans(v), ["star_id"], 10, key="o_orderkey").select(
        "star_id", "o_orderkey", "user_id", "total_index", "update_time", "topn")


@query("top_per_group_month", _FANS + """
SELECT star_id, year, month, o_orderkey, user_id, total_index, row_number() OVER (PARTITION BY star_id, year, month
  ORDER BY total_index DESC, t, o_orderkey) AS topn FROM f QUALIFY topn <= 50""", log=False)
def top_per_group_month(v):
    return ranking.top_per_group(_fans(v), ["star_id", "year", "month"], 50, key="o_orderkey").select(
        "star_id", "year", "month", "o_orderkey", "user_id", "total_index", "topn")


@query("top_per_group_large", _FANS + """
SELECT star_id, o_orderkey, total_index, row_number() OVER (PARTITION BY star_id
  ORDER BY total_index DESC, t, o_orderkey) AS topn FROM f QUALIFY topn <= 1500""", log=False)
def top_per_group_large(v):
    return ranking.top_per_group(_fans(v), ["star_id"], 1500, key="o_orderkey").select("star_id", "o_orderkey", "total_index", "topn")


@query("top_per_open_group", _FANS + """,
x AS (SELECT user_id % 200 AS public_id, o_orderkey AS fan_id, total_index AS love_index, t FROM f),
k AS (SELECT *, row_number() OVER (PARTITION BY public_id ORDER BY love_index DESC, t, fan_id) AS topn FROM x),
n AS (SELECT n_nationkey AS public_id FROM nation)
SELECT public_id, fan_id, love_index, topn FROM k WHERE topn <= 20 AND public_id IN (SELECT public_id FROM n)
UNION ALL SELECT public_id, fan_id, love_index, topn FROM k WHERE topn <= 2 AND public_id NOT IN (SELECT public_id FROM n)""", log=False)
def top_per_open_group(v):
    """All groups were ranked with two places before; the open ones are ranked anew with twenty."""
    rows = _fans(v).select((F.col("user_id") % 200).alias("public_id"), F.col("o_orderkey").alias("fan_id"),
                           F.col("total_index").alias("love_index"), "update_time")
    stored = ranking.top_per_group(rows, ["public_id"], 2, value="love_index", key="fan_id")
    opened = v.table("nation").select(F.col("n_nationkey").cast("long").alias("public_id"))
    return ranking.top_per_open_group(rows, opened, stored).drop("update_time")


_TIMES = _FANS + """, w AS (SELECT star_id, user_id FROM f QUALIFY row_number() OVER (PARTITION BY star_id, year, month
  ORDER BY total_index DESC, t, user_id) <= 3), m AS (SELECT star_id, user_id, count(*) AS fan_month_num FROM w GROUP BY ALL)"""


@query("times_in_top", _TIMES + " SELECT * FROM m", log=False)
def times_in_top(v):
    return ranking.times_in_top(_fans(v))


@query("eligible_leaders", _TIMES + f""",
r AS (SELECT c_mktsegment AS star_id, o_custkey AS user_id, min(o_orderdate) AS focus, count(*) AS n,
  count(*) FILTER (o_orderstatus = 'F') AS top, count(*) FILTER (o_orderpriority = '2-HIGH') AS cream
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL)
SELECT r.star_id, r.user_id, {ts_text('focus')} AS focus_time, n AS fan_dynamic_num, top AS fan_dynamic_top_num, cream AS fan_dynamic_cream_num,
  fan_month_num, CASE WHEN focus < DATE '1996-01-01' - 30 AND n >= 12 AND top + cream >= 5 AND fan_month_num >= 1 THEN 1 ELSE 0 END
  AS is_satisfy_header FROM r LEFT JOIN m ON m.star_id = r.star_id AND m.user_id = r.user_id""", log=False)
def eligible_leaders(v):
    people = v.table("customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("star_id"))
    records = (v.table("orders").withColumnRenamed("o_custkey", "user_id").join(people, "user_id").groupBy("star_id", "user_id")
               .agg(F.min(F.col("o_orderdate").cast("timestamp")).alias("focus_time"), F.count("*").alias("fan_dynamic_num"),
                    F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("fan_dynamic_top_num"),
                    F.count(F.when(F.col("o_orderpriority") == "2-HIGH", 1)).alias("fan_dynamic_cream_num")))
    records = records.join(ranking.times_in_top(_fans(v)), ["star_id", "user_id"], "left")
    return ranking.eligible_leaders(records, "1996-01-01", dynamics=12, top_cream=5)


@query("fan_score", """
f AS (SELECT o_custkey AS user_id, count(*) * 50 AS p FROM orders GROUP BY 1)
SELECT c_custkey AS user_id, 1 AS post_good_score, coalesce(p, 0) AS focus_score, 2 AS hot_comment_score, 3 AS comment_score,
  c_nationkey AS fan_dynamic_score, 4 AS gift_index, 5 AS pull_ring_index, 15 + c_nationkey + coalesce(p, 0) AS total_index
FROM customer LEFT JOIN f ON user_id = c_custkey""", log=False)
def fan_score(v):
    const = lambda n, name: F.lit(n).alias(name)
    index = v.table("customer").select(F.col("c_custkey").alias("user_id"), const(1, "post_good_score"), F.lit(0).cast("long").alias("focus_score"),
                                       const(2, "hot_comment_score"), const(3, "comment_score"), F.col("c_nationkey").alias("fan_dynamic_score"),
                                       const(4, "gift_index"), const(5, "pull_ring_index"))
    return ranking.fan_score(index, v.table("orders").select(F.col("o_custkey").alias("user_id")))


@query("fan_pool", f"""
SELECT p_partkey AS star_id, CAST(NULL AS BIGINT) AS user_id, '2024-01-01' AS create_time, p_partkey AS dynamic_id, p_size % 2 AS is_top,
  0 AS is_cream, 1 AS dynamic_type, '2024-01-01' AS update_time FROM part WHERE p_size % 3 = 0
UNION ALL SELECT o_orderkey % 100, o_custkey, strftime(o_orderdate, '%Y-%m-%d'), o_orderkey, 0, CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END, 2,
  '2024-01-01' FROM orders WHERE (o_orderstatus = 'O' OR (o_orderstatus = 'F' AND o_orderpriority = '5-LOW'))""", log=False)
def fan_pool(v):
    stars = v.table("part").select(F.col("p_partkey").alias("star_id"), F.lit("2024-01-01").alias("publish_time"), F.col("p_partkey").alias("id"),
                                   (F.col("p_size") % 2).alias("is_top"), (F.col("p_size") % 3).alias("is_delete"), F.lit(1).alias("is_online"),
                                   F.lit("2024-01-01").alias("update_time"))
    st = F.col("o_orderstatus")
    fans = v.table("orders").select(
        (F.col("o_orderkey") % 100).alias("star_id"), F.col("o_custkey").alias("fan_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("publish_time"),
        F.col("o_orderkey").alias("id"), F.lit(0).alias("is_top"), F.when(F.col("o_orderkey") % 4 == 0, 1).alias("is_cream"),
        F.when(st == "O", 0).otherwise(1).alias("is_need_audit"), F.when(st == "F", 2).otherwise(0).alias("is_audit"),
        F.when(F.col("o_orderpriority") == "5-LOW", 2).otherwise(1).alias("audit_score"), F.lit(0).alias("is_delete"),
        F.lit("2024-01-01").alias("update_time"))
    return ranking.fan_pool(stars, fans)


# --- recommendation --------------------------------------------------------------------------

@query("user_clicks", _EV + """
SELECT uid AS device_id, CAST(acc AS BIGINT) AS info_id, eventid AS event_name, d AS click_date, count(*) AS click_count FROM ev
WHERE eventid = 'recreate_click' OR (eventid IN ('share', 'comments') AND label = '1') GROUP BY ALL""")
def user_clicks(v):
    return recommend.user_clicks(v.events)


_CLICKS = _EV + """,
uc AS (SELECT uid, CAST(acc AS BIGINT) AS info, eventid, d, count(*) AS n FROM ev
  WHERE eventid = 'recreate_click' OR (eventid IN ('share', 'comments') AND label = '1') GROUP BY ALL),
iu AS (SELECT info, d, count(DISTINCT uid) AS users FROM uc GROUP BY ALL)"""


@query("item_users", _CLICKS + " SELECT info AS info_id, d AS click_date, users AS user_count FROM iu")
def item_users(v):
    return recommend.item_users(recommend.user_clicks(v.events))


WEIGHTS = {"recreate_click": 1.0, "comments": 0.5, "share": 0.8}


def _score_sql(factor: str) -> str:
    return _CLICKS + f""",
sc AS (SELECT uid, info, sum(CASE eventid WHEN 'recreate_click' THEN 1.0 WHEN 'comments' THEN 0.5 ELSE 0.8 END::DOUBLE
  * ({factor}) * (least(n, 3)::DOUBLE / users)) AS score
  FROM (SELECT *, date_diff('day', CAST(d AS DATE), DATE '2024-02-01') AS gap FROM uc JOIN iu USING (info, d)) GROUP BY ALL)"""


_SMOOTH = _score_sql("1.0 / ln(greatest(gap, 1) + 1) + 1")
_REFERENCE = _score_sql("CASE WHEN gap = 1 THEN CAST('Infinity' AS DOUBLE) ELSE 1.0 / ln(greatest(gap, 0.5)) + 1 END")


@query("user_item_score", _SMOOTH + " SELECT uid AS device_id, info AS info_id, round(score, 9) AS score FROM sc")
def user_item_score(v):
    clicks = recommend.user_clicks(v.events)
    scores = recommend.user_item_score(clicks, recommend.item_users(clicks), WEIGHTS, "2024-02-01", decay="smooth")
    return scores.withColumn("score", F.round("score", 9))


def _items(v):
    """Parts are items; their packed tags are the type and the size class with size as weight."""
    tag = lambda t, w: F.concat_ws(":", t.cast("string"), w.cast("string"))
    size = F.col("p_size")
    return v.table("part").select(
        F.col("p_partkey").alias("id"),
        F.concat_ws(",", tag(F.length("p_type"), size), tag(size % 10 + 100, (51 - size)), tag(F.length("p_name") + 200, size % 7 + 1)).alias("idwords"),
        F.timestamp_add("SECOND", (F.col("p_partkey") * 120).cast("int"), F.lit("2024-01-01").cast("timestamp")).alias("publish_time"),
        (size % 10 + 100).cast("long").alias("category_id"))


_TAGS = """tg AS (SELECT p_partkey AS id, unnest([length(p_type), p_size % 10 + 100, length(p_name) + 200]) AS tag_id,
  unnest([p_size, 51 - p_size, p_size % 7 + 1])::DOUBLE AS weight, TIMESTAMP '2024-01-01' + INTERVAL 1 SECOND * (p_partkey * 120) AS pub FROM part)"""


@query("item_tags", _TAGS + " SELECT id, CAST(tag_id AS BIGINT) AS tag_id, weight FROM tg", log=False)
def item_tags(v):
    return recommend.item_tags(_items(v))


_PROFILE = _REFERENCE + ", " + _TAGS + """,
ts0 AS (SELECT uid, tag_id, sum(score * weight) AS raw FROM sc JOIN tg ON info = id GROUP BY ALL),
ts AS (SELECT uid, tag_id, CAST(raw AS DECIMAL(12, 9)) AS score FROM ts0 WHERE isfinite(raw) AND raw < 1000 AND raw > -1000),
rk AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, tag_id) AS place FROM ts WHERE score > 0),
pr AS (SELECT uid, tag_id, place, CASE WHEN place <= 50 THEN CAST(ceil(score * 100000) AS DOUBLE) / 100000 END AS tag_score,
  CASE WHEN place <= 30 THEN round(CAST(score AS DOUBLE) / sum(CASE WHEN place <= 30 THEN CAST(score AS DOUBLE) END) OVER (PARTITION BY uid), 2) END AS weight FROM rk
  WHERE place <= 50)"""


@query("user_profile_tags", _PROFILE + """
SELECT uid AS device_id, CAST(tag_id AS BIGINT) AS tag_id, place, round(tag_score, 5) AS tag_score, weight FROM pr""")
def user_profile_tags(v):
    clicks = recommend.user_clicks(v.events)
    scores = recommend.user_item_score(clicks, recommend.item_users(clicks), WEIGHTS, "2024-02-01")
    return recommend.ranked_tags(scores, recommend.item_tags(_items(v)))


@query("user_profile", _PROFILE + """
SELECT uid AS device_id, string_agg(tag_id || ':' || printf('%.5f', tag_score), ',' ORDER BY place) AS tags,
  coalesce(string_agg(tag_id || ':' || printf('%.2f', weight), ',' ORDER BY place) FILTER (weight > 0), '') AS wtags
FROM pr GROUP BY uid""")
def user_profile(v):
    clicks = recommend.user_clicks(v.events)
    return daily.interest_profiles(clicks, recommend.item_tags(_items(v)), WEIGHTS, "2024-02-01")


@query("pair_similarity", """
f AS (SELECT label, min(vec_id) AS b FROM embeddings GROUP BY label),
p AS (SELECT vec_id AS a, b FROM embeddings JOIN f USING (label)),
x AS (SELECT p.a, p.b, va.embedding AS va, vb.embedding AS vb FROM p
  JOIN embeddings va ON va.vec_id = p.a JOIN embeddings vb ON vb.vec_id = p.b),
u AS (SELECT a, b, CAST(unnest(va) AS DOUBLE) AS s, CAST(unnest(vb) AS DOUBLE) AS t FROM x)
SELECT a, b, round(sum(s * t), 6) AS dot, round(sum(s * t) / (sqrt(sum(s * s)) * sqrt(sum(t * t))), 6) AS cosine, round(corr(s, t), 6) AS pearson
FROM u GROUP BY a, b""", log=False)
def pair_similarity(v):
    """Every vector against the first one of its label."""
    e = v.table("embeddings")
    values = F.transform("embedding", lambda x: x.cast("double"))
    vectors = e.select(F.col("vec_id").alias("id"), F.map_from_arrays(F.sequence(F.lit(1), F.size("embedding")), values).alias("vector"))
    first = e.groupBy("label").agg(F.min("vec_id").alias("b"))
    pairs = e.select(F.col("vec_id").alias("a"), "label").join(first, "label").select("a", "b")
    sims = recommend.pair_similarity(vectors, pairs)
    return sims.select("a", "b", *[F.round(c, 6).alias(c) for c in ("dot", "cosine", "pearson")])


_BASKETS = """
li AS (SELECT l_orderkey AS id, l_partkey AS key, sum(l_quantity) AS w FROM lineitem GROUP BY ALL),
sz AS (SELECT id, sqrt(sum(w * w)) AS size, list(key || ':' || w ORDER BY key) AS body FROM li GROUP BY id),
rp AS (SELECT body, min(id) AS id, count(*) AS copies, any_value(size) AS size FROM sz GROUP BY body)"""


def _baskets(v):
    """What each order holds: parts as keys, quantities as weights."""
    lines = v.table("lineitem").groupBy("l_orderkey", "l_partkey").agg(F.sum("l_quantity").alias("w"))
    return lines.groupBy(F.col("l_orderkey").alias("id")).agg(F.map_from_entries(F.collect_list(F.struct("l_partkey", "w"))).alias("vector"))


@query("similar_pairs", _BASKETS + """
SELECT x.id AS a, y.id AS b, round(sum(x.w * y.w) / (rx.size * ry.size), 6) AS similarity, rx.copies AS copies_a, ry.copies AS copies_b
FROM li x JOIN li y ON x.key = y.key AND x.id < y.id JOIN rp rx ON rx.id = x.id JOIN rp ry ON ry.id = y.id
GROUP BY x.id, y.id, rx.size, ry.size, rx.copies, ry.copies HAVING sum(x.w * y.w) / (rx.size * ry.size) >= 0.7""", log=False)
def similar_pairs(v):
    """Orders that hold much the same."""
    return similar.similar_pairs(_baskets(v), 0.7).withColumn("similarity", F.round("similarity", 6))


@query("similar_pairs_pearson", _BASKETS + """,
pr AS (SELECT x.id AS a, y.id AS b, count(*) AS n, sum(x.w) AS sx, sum(y.w) AS sy, sum(x.w * x.w) AS xx, sum(y.w * y.w) AS yy, sum(x.w * y.w) AS xy
  FROM li x JOIN li y ON x.key = y.key AND x.id < y.id WHERE x.id IN (SELECT id FROM rp) AND y.id IN (SELECT id FROM rp) GROUP BY x.id, y.id),
co AS (SELECT a, b, sqrt(abs(xx - sx * sx / n) * abs(yy - sy * sy / n)) AS den, xy - sx * sy / n AS num FROM pr WHERE n >= 2)
SELECT a, b, round(num / den, 6) AS similarity, x.copies AS copies_a, y.copies AS copies_b FROM co JOIN rp x ON x.id = a JOIN rp y ON y.id = b
WHERE den > 0 AND num / den >= 0.5""", log=False)
def similar_pairs_pearson(v):
    """Orders whose shared parts are bought in like proportions."""
    return similar.similar_pairs(_baskets(v), 0.5, "pearson").withColumn("similarity", F.round("similarity", 6))


_ITEM_VECTORS = """
vc AS (SELECT p_partkey AS id, [length(p_type), p_size % 10 + 100, length(p_name) + 200] AS k, [p_size, 51 - p_size, p_size % 7 + 1] AS w FROM part),
cl AS (SELECT id, k, w, min(id) OVER (PARTITION BY k, w) AS representative FROM vc)"""


@query("vector_classes", _ITEM_VECTORS + " SELECT id, representative FROM cl", log=False)
def vector_classes(v):
    """Items with the same tags and weights."""
    return similar.vector_classes(_item_vectors(v))


def _item_vectors(v):
    tags = recommend.item_tags(_items(v)).groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("tag_id", "weight"))).alias("vector"))
    return tags


@query("similar_pairs_tags", _ITEM_VECTORS + """,
rp AS (SELECT id, any_value(k) AS k, any_value(w) AS w, any_value(n) AS copies FROM (SELECT *, count(*) OVER (PARTITION BY representative) AS n FROM cl)
  WHERE id = representative GROUP BY id),
en AS (SELECT id, copies, unnest(k) AS k, unnest(w)::DOUBLE AS w, sqrt(list_sum(list_transform(w, lambda x: x * x))) AS size FROM rp)
SELECT x.id AS a, y.id AS b, round(sum(x.w * y.w) / any_value(x.size * y.size), 6) AS similarity,
  any_value(x.copies) AS copies_a, any_value(y.copies) AS copies_b
FROM en x JOIN en y ON x.k = y.k AND x.id < y.id GROUP BY x.id, y.id HAVING sum(x.w * y.w) / any_value(x.size * y.size) >= 0.995""", log=False)
def similar_pairs_tags(v):
    """Items with much the same tags: few tags, each with very many items, and many items alike."""
    return similar.similar_pairs(_item_vectors(v), 0.995).withColumn("similarity", F.round("similarity", 6))


NOW = "2024-01-04 00:00:00"


def _recommend_inputs(v):
    clicks = recommend.user_clicks(v.events)
    scores = recommend.user_item_score(clicks, recommend.item_users(clicks), WEIGHTS, "2024-02-01", decay="smooth")
    top = recommend.ranked_tags(scores, recommend.item_tags(_items(v)))
    tag = F.struct(F.col("tag_id").alias("tag"), F.col("tag_score").cast("double").alias("weight"))
    profiles = top.where("tag_score > 0").groupBy("device_id").agg(F.collect_list(tag).alias("tags"))
    items = _items(v).select("id", packed.parse_pairs("idwords").alias("tags"), "publish_time", "category_id")
    active = v.log.select(F.col("uid").alias("device_id"), F.col("ts").alias("active_time"))
    seen = clicks.select("device_id", "info_id")
    return profiles, active, items, seen, top


_SIMILAR = _SMOOTH + ", " + _TAGS + """,
t1 AS (SELECT uid, tag_id, CAST(sum(score * weight) AS DECIMAL(12, 9)) AS score FROM sc JOIN tg ON info = id GROUP BY ALL HAVING sum(score * weight) < 1000),
t2 AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, tag_id) AS place FROM t1 WHERE score > 0),
us AS (SELECT uid, tag_id, round(CAST(ceil(score * 100000) AS DOUBLE) / 100000, 5) AS w FROM t2 WHERE place <= 50),
un AS (SELECT uid, sqrt(sum(w * w)) AS n FROM us GROUP BY uid),
nw AS (SELECT * FROM tg WHERE pub > TIMESTAMP '2024-01-01' AND pub < TIMESTAMP '2024-01-04'),
inn AS (SELECT id, sqrt(sum(weight * weight)) AS n FROM nw GROUP BY id),
ac AS (SELECT DISTINCT uid FROM log WHERE ts >= TIMESTAMP '2023-12-28' AND ts <= TIMESTAMP '2024-01-04'),
ds AS (SELECT uid, id, any_value(pub) AS pub, sum(w * weight) AS dot FROM us JOIN nw USING (tag_id) WHERE uid IN (SELECT uid FROM ac) GROUP BY uid, id),
sm AS (SELECT ds.uid, ds.id, pub, round(dot / (un.n * inn.n), 12) AS sim FROM ds JOIN un ON ds.uid = un.uid JOIN inn ON inn.id = ds.id
  WHERE dot > 0 AND NOT EXISTS (SELECT 1 FROM uc WHERE uc.uid = ds.uid AND uc.info = ds.id)),
bs AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY sim DESC, pub DESC, id DESC) AS r FROM sm),
rc AS (SELECT uid, id, sim, pub, row_number() OVER (PARTITION BY uid ORDER BY pub DESC, sim DESC, id DESC) AS place FROM bs WHERE r <= 100)"""


def _similar(v):
    profiles, active, items, seen, _ = _recommend_inputs(v)
    return recommend.recommend_similar(profiles, active, items, seen, NOW)


@query("recommend_similar", _SIMILAR + f"""
SELECT uid AS device_id, place, id AS info_id, round(sim, 9) AS similarity, {ts_text('pub')} AS publish_time FROM rc""")
def recommend_similar(v):
    return _similar(v).withColumn("similarity", F.round("similarity", 9))


@query("paginate", _SIMILAR + """
SELECT uid AS device_id, CAST((place - 1) // 10 + 1 AS INTEGER) AS page, string_agg(id, ',' ORDER BY place) AS ids, 259200 AS ttl_seconds
FROM rc GROUP BY ALL""")
def paginate(v):
    return recommend.paginate(_similar(v))


@query("recommend_similar_table", _SIMILAR + """
SELECT uid AS device_id, id AS info_id, epoch_ms(pub) + 1000 - row_number() OVER (PARTITION BY uid ORDER BY pub DESC, sim DESC, id DESC) AS stamp_ms
FROM rc""")
def recommend_similar_table(v):
    profiles, active, items, seen, _ = _recommend_inputs(v)
    pending, history = seen.where("info_id < 50"), seen.where("info_id >= 50")
    recs = recommend.recommend_similar_table(profiles, active, items, pending, history, NOW)
    return recs.select("device_id", "info_id", "stamp_ms")


@query("recommendation_messages", _SIMILAR + """
SELECT uid AS key, uid || ' ' || string_agg(id || ':' || epoch_ms(pub), ',' ORDER BY place) AS value FROM rc GROUP BY uid""")
def recommendation_messages(v):
    return sinks.recommendations_to_messages(_similar(v))


_WTAGS = _SMOOTH + ", " + _TAGS + """,
t1 AS (SELECT uid, tag_id, CAST(sum(score * weight) AS DECIMAL(12, 9)) AS score FROM sc JOIN tg ON info = id GROUP BY ALL HAVING sum(score * weight) < 1000),
t2 AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, tag_id) AS place FROM t1 WHERE score > 0),
wt AS (SELECT uid, tag_id, round(CAST(score AS DOUBLE) / sum(CASE WHEN place <= 30 THEN CAST(score AS DOUBLE) END) OVER (PARTITION BY uid), 2) AS w, place FROM t2)"""


@query("recommend_by_category", _WTAGS + f""",
it AS (SELECT p_partkey AS id, p_size % 10 + 100 AS cat, TIMESTAMP '2024-01-01' + INTERVAL 1 SECOND * (p_partkey * 120) AS pub FROM part),
cd AS (SELECT uid, cat, w, id, pub, row_number() OVER (PARTITION BY uid, cat ORDER BY pub DESC, id DESC) AS r FROM wt JOIN it ON cat = tag_id
  WHERE place <= 30 AND w > 0 AND pub > TIMESTAMP '2024-01-01' AND pub < TIMESTAMP '2024-01-04'
  AND NOT EXISTS (SELECT 1 FROM uc WHERE uc.uid = wt.uid AND uc.info = it.id))
SELECT uid AS device_id, CAST(cat AS BIGINT) AS category_id, w AS weight, r AS place, id AS info_id, {ts_text('pub')} AS publish_time FROM cd
WHERE r <= round(w * 100)""")
def recommend_by_category(v):
    _, _, items, seen, top = _recommend_inputs(v)
    wtags = top.where("weight > 0").select("device_id", "tag_id", F.col("weight").cast("double").alias("weight"))
    return recommend.recommend_by_category(wtags, items.select("id", "category_id", "publish_time"), seen, NOW)


# Users active in the last day, and both results that are made from their items.
_CATEGORY = _WTAGS + """,
it AS (SELECT p_partkey AS id, p_size % 10 + 100 AS cat, TIMESTAMP '2024-01-01' + INTERVAL 1 SECOND * (p_partkey * 120) AS pub FROM part),
ac AS (SELECT DISTINCT uid FROM log WHERE ts >= TIMESTAMP '2024-01-03' AND ts <= TIMESTAMP '2024-01-04'),
cd AS (SELECT uid, cat, w, id, pub, row_number() OVER (PARTITION BY uid, cat ORDER BY pub DESC, id DESC) AS r FROM wt JOIN it ON cat = tag_id
  WHERE place <= 30 AND w > 0 AND pub > TIMESTAMP '2024-01-01' AND pub < TIMESTAMP '2024-01-04' AND uid IN (SELECT uid FROM ac)
  AND NOT EXISTS (SELECT 1 FROM uc WHERE uc.uid = wt.uid AND uc.info = it.id)),
st AS (SELECT *, epoch_ms(pub) + 1000 - row_number() OVER (PARTITION BY uid ORDER BY pub DESC, id DESC) AS stamp FROM cd WHERE r <= round(w * 100))"""


def _category_table(v):
    _, active, items, seen, top = _recommend_inputs(v)
    wtags = top.where("weight > 0").select("device_id", "tag_id", F.col("weight").cast("double").alias("weight"))
    return recommend.recommend_by_category_table(wtags, active, items.select("id", "category_id", "publish_time"), seen, NOW, days=1)


@query("recommend_by_category_table", _CATEGORY + " SELECT uid AS device_id, id AS info_id, stamp AS stamp_ms FROM st")
def recommend_by_category_table(v):
    return _category_table(v).select("device_id", "info_id", "stamp_ms")


@query("category_messages", _CATEGORY + """
SELECT uid AS key, uid || ' ' || string_agg(id || ':' || epoch_ms(pub), ',' ORDER BY stamp DESC) AS value FROM st GROUP BY uid""")
def category_messages(v):
    return sinks.recommendations_to_messages(_category_table(v), order="stamp_ms")


def _picked(v):
    top = _recommend_inputs(v)[4].where("weight > 0")
    wtags = F.transform(F.array_sort(F.collect_list(F.struct("place", F.col("tag_id").alias("tag")))), lambda t: F.struct(t["tag"].alias("tag")))
    return recommend.random_tag(top.groupBy("device_id").agg(wtags.alias("wtags")))


_PICKED = """,
w3 AS (SELECT uid, tag_id, row_number() OVER (PARTITION BY uid ORDER BY place) AS r, least(3, count(*) OVER (PARTITION BY uid)) AS c FROM wt
  WHERE place <= 30 AND w > 0),
pk AS (SELECT uid, tag_id FROM w3 WHERE r = CAST('0x' || substr(md5('0:' || uid), 1, 8) AS BIGINT) % c + 1)"""


@query("random_tag", _WTAGS + _PICKED + " SELECT uid AS device_id, CAST(tag_id AS BIGINT) AS tag_id FROM pk")
def random_tag(v):
    return _picked(v)


@query("tag_counts", _WTAGS + _PICKED + " SELECT CAST(tag_id AS BIGINT) AS tag_id, count(*) AS user_count FROM pk GROUP BY tag_id")
def tag_counts(v):
    return recommend.tag_counts(_picked(v))


# --- streams, diffs, dimensions, row functions ------------------------------------------------

_WINDOWS = f"""
w AS (SELECT channel, unnest([0, 1]) AS back, ts FROM log),
x AS (SELECT channel, time_bucket(INTERVAL 5 MINUTE, ts) - back * INTERVAL 5 MINUTE AS s FROM w)
SELECT channel AS channel_code, {ts_text('s')} AS window_start, {ts_text('s + INTERVAL 10 MINUTE')} AS window_end, count(*) AS "count" FROM x GROUP BY channel, s"""


@query("stream_channel_counts", _WINDOWS)
def channel_counts_stream(v):
    """The events as a message stream through the streaming plan, in complete mode."""
    message = F.to_json(F.struct(F.col("uid").alias("aid"), F.col("channel").alias("channel_code"),
                                 F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("create_time")))
    folder = scratch(v.spark, "channel_counts")
    v.log.select(message.alias("value")).write.mode("overwrite").text(f"{folder}/in")
    name = folder.rsplit("/", 1)[-1].replace("-", "_")
    counts = stream_channel_counts(parse_messages(v.spark.readStream.text(f"{folder}/in")))
    run = (counts.writeStream.format("memory").queryName(name).outputMode("complete")
           .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start())
    run.awaitTermination()
    return v.spark.table(name).select("channel_code", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "count")


@query("stream_channel_counts_append", _WINDOWS.replace("GROUP BY channel, s", """
WHERE s + INTERVAL 20 MINUTE <= (SELECT max(ts) FROM log) GROUP BY channel, s"""))
def channel_counts_append(v):
    """In append mode a window comes out once the watermark has passed its end."""
    message = F.to_json(F.struct(F.col("uid").alias("aid"), F.col("channel").alias("channel_code"),
                                 F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("create_time")))
    folder = scratch(v.spark, "channel_append")
    v.log.select(message.alias("value")).write.mode("overwrite").text(f"{folder}/in")
    name = folder.rsplit("/", 1)[-1].replace("-", "_")
    start_channel_counts(parse_messages(v.spark.readStream.text(f"{folder}/in")), f"{folder}/checkpoint", "append", "memory", name).awaitTermination()
    return v.spark.table(name).select("channel_code", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "count")


@query("batch_channel_counts", _WINDOWS)
def channel_counts_batch(v):
    return stream_channel_counts(v.visit_ad).select("channel_code", F.col("window.start").alias("window_start"),
                                                    F.col("window.end").alias("window_end"), "count")


@query("diff_tables", """
a AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL),
b AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY ALL)
SELECT CASE WHEN coalesce(a.n, 0) > coalesce(b.n, 0) THEN 'left' ELSE 'right' END AS side, o_custkey, o_orderstatus,
  abs(coalesce(a.n, 0) - coalesce(b.n, 0)) AS copies FROM a FULL JOIN b USING (o_custkey, o_orderstatus)
WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""", log=False)
def diff_tables(v):
    o = v.table("orders")
    return sinks.diff_tables(o.where("o_orderstatus <> 'P'"), o.where("o_orderpriority <> '5-LOW'"), ["o_custkey", "o_orderstatus"])


_CUR = "SELECT o_custkey AS id, min(o_orderpriority) AS a, min(o_orderstatus) AS b FROM orders WHERE o_custkey % 2 = 0 GROUP BY 1"
_NEW = "SELECT l_partkey AS id, max(l_returnflag) AS a, max(l_linestatus) AS b FROM lineitem GROUP BY 1"


def _state_tables(v):
    current = v.table("orders").where("o_custkey % 2 = 0").groupBy(F.col("o_custkey").alias("id")).agg(
        F.min("o_orderpriority").alias("a"), F.min("o_orderstatus").alias("b"))
    new = v.table("lineitem").select(F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("a"), F.col("l_linestatus").alias("b"))
    return current, new.groupBy("id").agg(F.max("a").alias("a"), F.max("b").alias("b"))


@query("upsert", f"""c AS ({_CUR}), n AS ({_NEW})
SELECT id, coalesce(n.a, c.a) AS a, coalesce(c.b, n.b) AS b FROM c FULL JOIN n USING (id)""", log=False)
def upsert(v):
    return sinks.upsert(*_state_tables(v), ["id"], ["a"])


@query("insert_ignore", f"""c AS ({_CUR}), n AS ({_NEW})
SELECT * FROM c UNION ALL SELECT * FROM n WHERE id NOT IN (SELECT id FROM c)""", log=False)
def insert_ignore(v):
    return sinks.insert_ignore(*_state_tables(v), ["id"])


@query("replace_into", f"""c AS ({_CUR}), n AS ({_NEW})
SELECT * FROM n UNION ALL SELECT * FROM c WHERE id NOT IN (SELECT id FROM n)""", log=False)
def replace_into(v):
    return sinks.replace_into(*_state_tables(v), ["id"])


def _bucketed_steps(v, *steps):
    """A table kept by buckets of its id through key merges, each with a part of the new rows."""
    path = scratch(v.spark, "keyed")
    current, new = _state_tables(v)
    table = bucketed.update_bucketed(v.spark, path, current, lambda stored, rows, co_located=False: rows, ["id"], 8)
    for step in steps:
        table = bucketed.update_bucketed(v.spark, path, new, step, ["id"], 8)
    return table


@query("upsert_bucketed", f"""c AS ({_CUR}), n AS ({_NEW})
SELECT id, coalesce(n.a, c.a) AS a, coalesce(c.b, n.b) AS b FROM c FULL JOIN n USING (id)""", log=False)
def upsert_bucketed(v):
    """New keys first, then the values of known ones."""
    return _bucketed_steps(v, lambda stored, rows, co_located: sinks.insert_ignore(stored, rows, ["id"]),
                           lambda stored, rows, co_located: sinks.upsert(stored, rows, ["id"], ["a"]))


@query("replace_into_bucketed", f"""c AS ({_CUR}), n AS ({_NEW})
SELECT * FROM n UNION ALL SELECT * FROM c WHERE id NOT IN (SELECT id FROM n)""", log=False)
def replace_into_bucketed(v):
    return _bucketed_steps(v, lambda stored, rows, co_located: sinks.replace_into(stored, rows, ["id"]))


@query("calendar_columns", f"""
d AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)
SELECT {day_int('d')} AS id, year(d) AS the_year, CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END AS half_year, quarter(d) AS the_quarter,
  month(d) AS month_of_year, weekofyear(d) AS week_of_year, day(d) AS day_of_month, isodow(d) - 1 AS week_day, strftime(d, '%Y-%m-%d') AS the_date,
  20890520 - {day_int('d')} AS order_no, 'Q' || quarter(d) AS quarter_name, monthname(d) AS month_name, substr(monthname(d), 1, 3) AS abbr_month_name,
  ['一月', '二月', '三月', '四月', '五月', '六月', '七月', '八月', '九月', '十月', '十一月', '十二月'][month(d)] AS cn_month_name,
  dayname(d) AS week_name, substr(dayname(d), 1, 3) AS abbr_week_name,
  ['周一', '周二', '周三', '周四', '周五', '周六', '周日'][isodow(d)] AS cn_week_name FROM d""", log=False)
def calendar_columns(v):
    """The calendar of every ship date."""
    days = v.table("lineitem").select(F.to_date("l_shipdate").alias("the_date")).distinct()
    return dims.calendar_columns(days)


_COHORT_GAPS = "g AS (SELECT DISTINCT CAST(date_diff('day', TIMESTAMP '1996-01-01', o_orderdate) AS INTEGER) AS id FROM orders)"


@query("cohort_columns", _COHORT_GAPS + """
SELECT id, CASE WHEN id < 0 THEN '未知' ELSE CAST(id + 1 AS VARCHAR) END AS day_num, CASE WHEN id < 0 THEN '未知' ELSE CAST(id // 7 + 1 AS VARCHAR) END AS week_num,
  CASE WHEN id < 0 THEN '未知' ELSE CAST(id // 365 * 12 + least(id % 365 // 30, 11) + 1 AS VARCHAR) END AS month_num,
  CASE WHEN id < 0 THEN '未知' ELSE CAST(id // 365 * 4 + least(id % 365 // 30, 11) // 3 + 1 AS VARCHAR) END AS quarter_num,
  CASE WHEN id < 0 THEN '未知' ELSE CAST(id // 365 + 1 AS VARCHAR) END AS year_num FROM g""", log=False)
def cohort_columns(v):
    gaps = v.table("orders").select(F.datediff("o_orderdate", F.lit("1996-01-01").cast("date")).alias("id")).distinct()
    return gaps.withColumns(dims.cohort_columns("id"))


def _band_sql(c: str, name: str) -> str:
    bounds, labels = dims.BANDS[name]
    number = "CASE " + " ".join(f"WHEN {c} <= {b} THEN {i}" for i, b in enumerate(bounds)) + f" ELSE {len(bounds)} END AS {name}"
    label = "CASE " + " ".join(f"WHEN {c} <= {b} THEN '{labels[i]}'" for i, b in enumerate(bounds)) + f" ELSE '{labels[-1]}' END AS {name}_desc"
    return f"{number}, {label}"


@query("bucket_labels", "SELECT l_orderkey, l_linenumber, q, " + ", ".join(_band_sql("q", n) for n in dims.BANDS) + """
FROM (SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice / 50 - 5) AS INTEGER) AS q FROM lineitem)""", log=False)
def bucket_labels(v):
    rows = v.table("lineitem").select("l_orderkey", "l_linenumber", F.floor(F.col("l_extendedprice") / 50 - 5).cast("int").alias("q"))
    return dims.bucket_labels(rows, "q")


@query("label_isp", """
SELECT o_orderkey, c AS isp_code, CASE c WHEN 46000 THEN '中国移动' WHEN 46001 THEN '中国联通' WHEN 46002 THEN '中国移动' WHEN 46003 THEN '中国电信' END AS isp_name
FROM (SELECT o_orderkey, 46000 + CAST(o_orderkey % 6 AS INTEGER) AS c FROM orders)""", log=False)
def label_isp(v):
    return dims.label_isp(v.table("orders").select("o_orderkey", (F.col("o_orderkey") % 6 + 46000).cast("int").alias("isp_code")))


PRODUCTS = {"view": "Reader", "click": "Player", "purchase": "Shop", "signup": "Account"}


@query("label_product", """
SELECT event_type AS id, CASE event_type WHEN 'view' THEN 'Reader' WHEN 'click' THEN 'Player' WHEN 'purchase' THEN 'Shop' WHEN 'signup' THEN 'Account' END AS name,
  count(*) AS n FROM log GROUP BY event_type""")
def label_product(v):
    """Events per product; apps that the table lacks keep a null name."""
    counts = v.log.groupBy(F.col("event_type").alias("id")).agg(F.count("*").alias("n"))
    return counts.join(dims.dim_product(v.spark, PRODUCTS), "id", "left").select("id", "name", "n")


@query("clean_rows", """
SELECT event_id, CASE WHEN k % 5 < 2 THEN 'unknown' ELSE 'c' || k END AS name, CASE WHEN k % 3 = 1 THEN 1 ELSE 2 END AS isroot,
  CASE WHEN k % 2 = 1 THEN 1 ELSE 2 END AS gp, CASE WHEN k % 2 = 1 THEN 1 ELSE 0 END AS havaapn,
  CASE WHEN k % 8 BETWEEN 1 AND 5 THEN k % 8 ELSE 0 END AS path, CASE WHEN k % 4 = 0 THEN 9 ELSE k END AS extra, 7 AS added,
  CASE k % 7 WHEN 0 THEN '4G' WHEN 1 THEN '3G' WHEN 2 THEN '2G' WHEN 3 THEN 'WIFI' ELSE 'unknown' END AS link
FROM log WHERE k % 9 > 1 AND length('net' || k) <= 4""")
def clean_rows(v):
    """Row filters and fills: missing and over-long texts, flags, defaults, columns that older logs lack."""
    k = F.col("k")
    text = lambda c: c.cast("string")
    free = (F.when(k % 7 == 0, "mobile 4G").when(k % 7 == 1, "3Gx").when(k % 7 == 2, "2G").when(k % 7 == 3, "WIFI 5").otherwise("cable"))
    rows = v.log.select(
        "event_id", F.when(k % 5 == 0, "").when(k % 5 == 1, None).otherwise(F.concat(F.lit("c"), text(k))).alias("name"),
        F.when(k % 9 == 0, None).when(k % 9 == 1, "").otherwise("x").alias("needed"), F.concat(F.lit("net"), text(k)).alias("limited"),
        text(k % 3).alias("isroot"), text(k % 2).alias("gp"), text(k % 2).alias("havaapn"), text(k % 8).alias("path"),
        F.when(k % 4 > 0, k).alias("extra"), clean.network_from_text(free).alias("link"))
    kept = clean.normalize_flags(clean.require_non_empty(rows, ["needed"], {"limited": 4}))
    filled = clean.add_optional_column(clean.add_optional_column(clean.default_unknown(kept, ["name"]), "extra", 9), "added", 7)
    return filled.select("event_id", "name", "isroot", "gp", "havaapn", "path", "extra", "added", "link")


@query("clean_functions", """
SELECT event_id, CASE WHEN k % 7 = 0 THEN '4G' WHEN k % 7 = 1 THEN '3G' WHEN k % 7 = 2 THEN '2G' WHEN k % 7 = 3 THEN '0WIFI' WHEN k % 7 = 4 THEN '1GPRS'
    ELSE '-Unknown' END AS network_key,
  CASE WHEN v <= 0 THEN 0 WHEN v / 60000.0 < 1 THEN 1 WHEN v / 60000.0 > 120 THEN 121 ELSE CAST(round(v / 60000.0) AS INTEGER) END AS minutes,
  CASE WHEN k - 20 <= 0 THEN 0 ELSE k - 20 END AS screen, CASE WHEN v > 0 AND v < 3600000 THEN CAST(ceil(v / 1000.0) AS BIGINT) END AS seconds,
  substr('abcdef' || k, 1, 7) AS clipped, CASE WHEN k % 4 = 0 THEN 46000 WHEN k % 4 = 1 THEN 0 ELSE 0 END AS isp,
  CASE k % 3 WHEN 0 THEN '资讯' WHEN 1 THEN '视频' ELSE '其他' END AS kind, event_type || '-' || k AS content_key, k AS item
FROM (SELECT event_id, event_type, k, CAST(floor(value * 100000) AS BIGINT) AS v FROM log)""")
def clean_functions(v):
    k = F.col("k")
    net = (F.when(k % 7 == 0, "4G").when(k % 7 == 1, "3G").when(k % 7 == 2, "2G").when(k % 7 == 3, "Wifi").when(k % 7 == 4, "GPRS")
           .when(k % 7 == 5, "Unknown").otherwise(""))
    ms = F.floor(F.col("value") * 100000).cast("long")
    imsi = F.when(k % 4 == 0, "460001234").when(k % 4 == 1, "46055999").when(k % 4 == 2, "460x").otherwise("")
    key = packed.composite_id("event_type", "k")
    return v.log.select(
        "event_id", clean.rank_network(net).alias("network_key"), clean.bucket_minutes(ms).alias("minutes"),
        clean.clamp_percent(k - 20).alias("screen"), clean.duration_seconds(ms).alias("seconds"),
        clean.clip_text(F.concat(F.lit("abcdef"), k.cast("string")), 7).alias("clipped"), clean.isp_code(imsi, known_only=True).alias("isp"),
        clean.label_codes(k % 3, clean.CONTENT_TYPE, "其他").alias("kind"), key.alias("content_key"), packed.composite_item(key).alias("item"))


@query("explode_packed", """
SELECT uid, ts0 AS day, 'a' || x AS ad_id, 'r' || x AS res_id FROM (SELECT uid, strftime(ts, '%Y-%m-%d') AS ts0, unnest([k, k + 1]) AS x FROM log)""")
def explode_packed(v):
    k = F.col("k")
    pair = lambda n: F.concat(F.lit("a"), n.cast("string"), F.lit("~r"), n.cast("string"))
    rows = v.log.select("uid", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.concat_ws(",", pair(k), pair(k + 1)).alias("ads"))
    return packed.explode_packed(rows, "ads", ("ad_id", "res_id"), inner="~")


@query("date_hour_columns", """
SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS order_date, hour(o_orderdate) AS order_hour,
  strftime(o_orderdate, '%Y-%m-%d') AS dashed, date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) AS gap FROM orders""", log=False)
def date_hour_columns(v):
    o = v.table("orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("t"))
    o = o.withColumn("gap", dates.day_gap("t", F.lit("1995-01-01").cast("date")))
    wide = dates.date_hour_columns(o, {"order": "t"})
    return wide.withColumn("dashed", dates.dashed("order_date"))
