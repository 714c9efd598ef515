"""Statistics of content, stars and events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.clean import has_text, label_codes
from tallyline.functions.dates import date_int
from tallyline.functions.packed import composite_id, composite_item, composite_model
from tallyline.operators.skew import distinct_users, top_per_key

# Events of the content statistics, as name -> (event ids, labels or None).
INFO_EVENTS = {"click": (("recreate_click", "video_click"), None),
               "comment": (("comments",), ("1", "2")),
               "share": (("share",), ("1", "2"))}
INTERACT_EVENTS = {"click": (("interact_click", "video_click"), None),
                   "comment": (("comments",), ("3",)),
                   "share": (("share",), ("15",))}


def event_counts(events: DataFrame, devices: DataFrame, by_hour: bool = False) -> DataFrame:
    """Clicks and distinct users per channel, version and event (and hour).

    Events are reduced to one row per device, version and event before the join, so a user is one
    row and needs no distinct count afterwards.
    """
    rows = events.where(has_text("deviceid") & has_text("version") & has_text("insertdate"))
    hour = [F.hour(F.try_to_timestamp("insertdate")).alias("create_hour")] if by_hour else []
    names = ["create_hour"] if by_hour else []
    per_user = (rows.groupBy("deviceid", "version", F.col("eventid").alias("event_id"),
                             F.col("date").alias("create_date"), *hour)
                .agg(F.count("*").alias("_n")))
    channels = devices.select(F.col("uuid").alias("deviceid"), "customer_id")
    return (per_user.join(channels, "deviceid")
            .groupBy("customer_id", "version", "event_id", "create_date", *names)
            .agg(F.sum("_n").alias("click_count"), F.count("*").alias("user_count")))


def event_level(events: DataFrame, devices: DataFrame, names: Sequence[str],
                sub: bool = False) -> DataFrame:
    """Per device, day and listed event (and its detail): lowest version and clicks."""
    rows = events.where(has_text("deviceid") & has_text("version") & F.col("eventid").isin(*names))
    detail = ["acc"] if sub else []
    if sub:
        rows = rows.where(has_text("acc"))
    per_user = (rows.groupBy(F.col("deviceid").alias("device_id"), F.col("eventid").alias("event_id"),
                             F.col("date").alias("create_date"), *detail)
                .agg(F.min("version").alias("version"), F.count("*").alias("click_times")))
    channels = devices.select(F.col("uuid").alias("device_id"), "customer_id")
    return per_user.join(channels, "device_id")


def category_share(events: DataFrame, names: Sequence[str]) -> DataFrame:
    """Distinct users per (event, category) beside the distinct users of the event."""
    users = events.where(F.col("eventid").isin(*names)).select("eventid", "acc", "deviceid").distinct()
    part = users.groupBy("eventid", "acc").agg(F.count("deviceid").alias("sub_count"))
    whole = (users.select("eventid", "deviceid").distinct()
             .groupBy("eventid").agg(F.count("deviceid").alias("total_count")))
    # one row per listed event name
    return part.join(F.broadcast(whole), "eventid")


def _tests(kinds: Mapping[str, tuple]) -> dict[str, Column]:
    tests = {}
    for kind, (ids, labels) in kinds.items():
        test = F.col("eventid").isin(*ids)
        tests[kind] = test if labels is None else test & F.col("label").isin(*labels)
    return tests


def content_measures(events: DataFrame, kinds: Mapping[str, tuple]) -> DataFrame:
    """Count and distinct users of every kind per content id, from one scan of the events.

    A row per content and user is built first, which splits a hot content over its users.
    """
    tests = _tests(kinds)
    wanted = None
    for test in tests.values():
        wanted = test if wanted is None else wanted | test
    per_user = (events.where(wanted).groupBy(F.col("acc").alias("id"), "deviceid")
                .agg(*[F.count(F.when(t, 1)).alias(k) for k, t in tests.items()]))
    aggs = []
    for k in tests:
        aggs.append(F.nullif(F.sum(k), F.lit(0)).alias(f"{k}_count"))
        users = F.count(F.when((F.col(k) > 0) & F.col("deviceid").isNotNull(), 1))
        aggs.append(F.when(F.sum(k) > 0, users).alias(f"{k}_user"))
    return per_user.groupBy("id").agg(*aggs)


def engagement(events: DataFrame, content: DataFrame,
               kinds: Mapping[str, tuple] = INFO_EVENTS) -> DataFrame:
    """Clicked content with its click, comment and share counts; a kind without rows is null."""
    measures = content_measures(events, kinds).where(F.col("click_count").isNotNull())
    return measures.join(content, "id")


def engagement_by_content(content: DataFrame, events: DataFrame, date_range: str,
                          kinds: Mapping[str, tuple] = INTERACT_EVENTS,
                          fill: int | None = 0) -> DataFrame:
    """All content with its counts over a labelled range; content without events gets ``fill``."""
    measures = content_measures(events, kinds)
    counts = [c for c in measures.columns if c != "id"]
    joined = content.join(measures, "id", "left")
    if fill is not None:
        joined = joined.fillna(fill, subset=counts)
    return joined.withColumn("date_range", F.lit(date_range))


def content_clicks(events: DataFrame, names: Sequence[str] = ("recreate_click", "video_click")) -> DataFrame:
    """Clicks per content, device and day, to be stored in one partition per ``stat_date``."""
    return (events.where(F.col("eventid").isin(*names))
            .groupBy("acc", "deviceid", F.col("date").alias("stat_date"))
            .agg(F.count("*").alias("click_count")))


def recent_content_clicks(stored: DataFrame, run_date: str, days: int = 30) -> DataFrame:
    """The partitions of the last ``days`` days before ``run_date``, both ends included."""
    end = F.lit(run_date).cast("date")
    day = F.col("stat_date")
    return stored.where((day >= F.date_format(F.date_sub(end, days), "yyyy-MM-dd"))
                        & (day <= F.date_format(F.date_sub(end, 1), "yyyy-MM-dd")))


def top_content(df: DataFrame, n: int = 1, day: int | None = None) -> DataFrame:
    """Per content type and author the ``n`` rows with most click users, published on ``day``."""
    rows = df if day is None else df.where(F.col("publish_date") == day)
    return top_per_key(rows, ["content_type", "create_by"], [F.desc("click_user"), F.desc("id")], n,
                       rank="topn")


def search_share(events: DataFrame) -> DataFrame:
    """All users and users who searched, per day."""
    flags = {"all_count": F.lit(True), "search_count": F.col("eventid") == "search"}
    return distinct_users(events, ["date"], "deviceid", flags)


def _star_measures(clicks: DataFrame, fans: DataFrame, dynamics: DataFrame, posts: DataFrame,
                   comments: DataFrame) -> dict[str, DataFrame]:
    star = F.col("acc").try_cast("long").alias("star_id")
    visits = (clicks.groupBy(star, "deviceid").agg(F.count("*").alias("_n")).groupBy("star_id")
              .agg(F.sum("_n").alias("click_count"), F.count("deviceid").alias("click_user")))
    return {
        "visits": visits,
        "fans": fans.groupBy("star_id").agg(F.count("*").alias("fans_count")),
        "dynamics": dynamics.groupBy("star_id").agg(F.sum("dynamic_num").alias("dynamic_num")),
        "posts": (posts.where(F.col("star_id") > 0).groupBy("star_id")
                  .agg(F.count("*").alias("post_count"))),
        "comments": comments.groupBy("star_id").agg(F.count("*").alias("comment_count")),
    }


_STAR_COUNTS = ["click_count", "click_user", "fans_count", "dynamic_num", "post_count",
                "comment_count"]


def _star_union(measures: Mapping[str, DataFrame]) -> DataFrame:
    stacked = None
    for df in measures.values():
        stacked = df if stacked is None else stacked.unionByName(df, allowMissingColumns=True)
    return stacked.groupBy("star_id").agg(*[F.sum(c).alias(c) for c in _STAR_COUNTS])


def star_daily(stars: DataFrame, clicks: DataFrame, fans: DataFrame, dynamics: DataFrame,
               posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Every star with its daily visits, users, fans, dynamics, posts and comments (null if none).

    The five measures are stacked and summed by star, then joined once.
    """
    totals = _star_union(_star_measures(clicks, fans, dynamics, posts, comments))
    return stars.select("star_id", "real_name").join(totals, "star_id", "left")


def star_daily_outer(stars: DataFrame, clicks: DataFrame, fans: DataFrame, dynamics: DataFrame,
                     posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Stars with any activity and 0 for what is missing; the name is looked up."""
    totals = _star_union(_star_measures(clicks, fans, dynamics, posts, comments))
    named = totals.join(stars.select("star_id", "real_name"), "star_id", "left")
    return named.fillna(0, subset=_STAR_COUNTS)


def content_summary(articles: DataFrame, videos: DataFrame, sns: DataFrame, events: DataFrame) -> DataFrame:
    """Articles and videos under one key with comments, praise, clicks, click users and shares."""
    both = (articles.select("id", "source", "title", "publish_time", "create_by", F.lit(1).alias("m"))
            .unionByName(videos.select("id", F.lit(None).cast("string").alias("source"), "title",
                                       F.col("create_time").alias("publish_time"), "create_by",
                                       F.lit(2).alias("m"))))
    both = both.withColumn("key", composite_id("m", "id")).drop("m", "id")
    social = sns.select(composite_id("model_id", "bussiness_id").alias("key"), "comment_count",
                        "praise_count")
    kind = F.when(F.col("eventid") == "recreate_click", 1).when(F.col("eventid") == "video_click", 2)
    is_share = (F.col("eventid") == "share") & F.col("label").isin("1", "2")
    model = F.when(is_share, F.col("label").try_cast("int")).otherwise(kind)
    rows = events.select(composite_id(model, "acc").alias("key"), "deviceid",
                         model.alias("_model"), is_share.alias("_share")).where("_model IS NOT NULL")
    measures = (rows.groupBy("key", "deviceid")
                .agg(F.count(F.when(~F.col("_share"), 1)).alias("_clicks"),
                     F.count(F.when(F.col("_share"), 1)).alias("_shares"))
                .groupBy("key")
                .agg(F.sum("_clicks").alias("click_count"),
                     F.count(F.when((F.col("_clicks") > 0) & F.col("deviceid").isNotNull(), 1))
                     .alias("user_count"),
                     F.sum("_shares").alias("share_count")))
    counts = ["comment_count", "praise_count", "click_count", "user_count", "share_count"]
    joined = both.join(social, "key", "left").join(measures, "key", "left").fillna(0, subset=counts)
    return joined.withColumns({"id": composite_item("key"), "model_id": composite_model("key")}).drop("key")


def weekly_report(df: DataFrame, start: int, end: int, names: Sequence[str], measures: Sequence[str],
                  date_col: str = "create_date", content: DataFrame | None = None,
                  categories: DataFrame | None = None) -> DataFrame:
    """Sums of daily measures from ``start`` to ``end`` by ``names``; with ``content`` (and its
    ``categories``) the sums per id are described by its row and category name."""
    week = df.where((F.col(date_col) >= start) & (F.col(date_col) <= end))
    sums = (week.groupBy(*names).agg(*[F.sum(m).alias(m) for m in measures])
            .withColumn("date_range", F.lit(f"{start}-{end}")))
    if content is not None:
        sums = sums.join(content, "id")
        if categories is not None:
            sums = sums.join(categories.select(F.col("id").alias("category_id"),
                                               F.col("name").alias("category_name")), "category_id")
    return sums


def counter_increment(current: DataFrame, clicks: DataFrame, done: DataFrame, event: str = "game_click",
                      label: str = "2") -> DataFrame:
    """Add the clicks of each game to its counter, leaving out games already applied."""
    fresh = (clicks.where((F.col("eventid") == event) & (F.col("label") == label))
             .groupBy(F.col("acc").try_cast("long").alias("game_id"))
             .agg(F.count("*").alias("_n"))
             .join(done.select("game_id").distinct(), "game_id", "left_anti"))
    joined = current.join(fresh, "game_id", "left")
    return joined.withColumn("click_num", F.col("click_num") + F.coalesce("_n", F.lit(0))).drop("_n")


def job_states(runs: DataFrame, since: str, labels: Mapping) -> DataFrame:
    """Runs per day and readable state."""
    rows = runs.where(F.col("run_time") >= F.lit(since).cast("timestamp"))
    return (rows.groupBy(date_int("run_time").alias("run_date"),
                         label_codes("task_state", labels).alias("state"))
            .agg(F.count("*").alias("run_count")))


def failed_jobs(runs: DataFrame, logs: DataFrame, tasks: DataFrame, since: str, failed=9,
                level: int = 3) -> DataFrame:
    """Failed runs started since a time with one error message each (the first in text order)."""
    bad = runs.where((F.col("task_state") == failed)
                     & (F.col("start_time") >= F.lit(since).cast("timestamp")))
    errors = (logs.where(F.col("level") == level).groupBy("task_id", "run_time")
              .agg(F.min("content").alias("content")))
    return (bad.join(errors, ["task_id", "run_time"])
            .join(tasks.withColumnRenamed("id", "task_id"), "task_id"))


def slowest_jobs(runs: DataFrame, tasks: DataFrame, since: str, n: int = 10) -> DataFrame:
    """The ``n`` longest runs started since a time, in minutes."""
    rows = runs.where(F.col("start_time") >= F.lit(since).cast("timestamp"))
    seconds = F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))
    return (rows.withColumn("minutes", F.round(seconds / 60, 2))
            .join(tasks.withColumnRenamed("id", "task_id"), "task_id")
            .orderBy(F.desc("minutes"), "task_id", "run_time").limit(n))
