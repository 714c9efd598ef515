"""Interest profiles and item recommendation."""

from __future__ import annotations

import datetime
import math
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.clean import has_text
from tallyline.functions.packed import format_pairs, parse_pairs
from tallyline.functions.vectors import cosine, dot, pearson
from tallyline.operators.skew import lookup, top_per_key
from tallyline.session import written

# Users and items of one scoring block, about, and the fewest users that are worth a task of their own.
USER_BLOCK, ITEM_BLOCK = 50_000, 20_000
LEAST_USERS = 500
FIRST_READ = 2048  # entries of all lists of a user that are read at first, since a read has its price too; each further read is twice as long


def user_clicks(events: DataFrame, day: str | None = None, browse: str = "recreate_click") -> DataFrame:
    """Browse, share and comment counts per device, item, event and day."""
    label = (F.col("label") == "1") & F.col("eventid").isin("share", "comments")
    rows = events.where(has_text("deviceid") & has_text("acc") & ((F.col("eventid") == browse) | label))
    if day is not None:
        rows = rows.where(F.col("date") == day)
    return (rows.groupBy(F.col("deviceid").alias("device_id"),
                         F.col("acc").try_cast("long").alias("info_id"),
                         F.col("eventid").alias("event_name"), F.col("date").alias("click_date"))
            .agg(F.count("*").cast("int").alias("click_count")))


def item_users(clicks: DataFrame) -> DataFrame:
    """Distinct devices per item and day."""
    return clicks.groupBy("info_id", "click_date").agg(F.count_distinct("device_id").alias("user_count"))


def click_factor(gap: Column, decay: str) -> Column:
    """Weight of a click by its age in days. ``reference``: 1/ln(age)+1 with at least half a day,
    infinite at one day (such a score is later dropped); ``smooth``: 1/ln(1+age)+1 from one day."""
    if decay == "smooth":
        return F.lit(1.0) / F.log(F.greatest(gap, F.lit(1)) + 1) + 1
    age = F.greatest(gap.cast("double"), F.lit(0.5))
    return F.when(age == 1, F.lit(float("inf"))).otherwise(F.try_divide(F.lit(1.0), F.log(age)) + 1)


def user_item_score(clicks: DataFrame, items: DataFrame, weights: Mapping[str, float], day: str,
                    days: int = 100, max_clicks: int = 3, decay: str = "reference") -> DataFrame:
    """Interest of each device in each item over the ``days`` before ``day``.

    ``items`` is :func:`item_users`. The window is compared with ``click_date`` as it is stored (a
    date, or text as yyyy-MM-dd), so that the test reaches the files.
    """
    today = F.lit(day).cast("date")
    raw, date = F.col("click_date"), F.col("click_date").try_cast("date")
    first = datetime.date.fromisoformat(day) - datetime.timedelta(days=days)
    text = isinstance(clicks.schema["click_date"].dataType, T.StringType)
    low, high = (F.lit(first.isoformat()), F.lit(day)) if text else (F.lit(first), F.lit(datetime.date.fromisoformat(day)))
    recent = clicks.where((raw >= low) & (raw < high) & date.isNotNull())
    weight = None
    for name, w in weights.items():
        test = F.col("event_name") == name
        weight = F.when(test, F.lit(float(w))) if weight is None else weight.when(test, F.lit(float(w)))
    joined = lookup(recent, items, ["click_date", "info_id"]).where(F.col("user_count").isNotNull())
    share = F.least(F.col("click_count"), F.lit(max_clicks)) / F.col("user_count")
    score = weight * click_factor(F.datediff(today, date), decay) * share
    return (joined.withColumn("_s", score).where(F.col("_s").isNotNull())
            .groupBy("device_id", "info_id").agg(F.sum("_s").alias("score")))


def item_tags(items: DataFrame) -> DataFrame:
    """Packed tags of items to rows (id, tag_id, weight)."""
    return (items.where(has_text("idwords"))
            .select("id", F.explode(parse_pairs("idwords")).alias("t"))
            .select("id", F.col("t.tag").alias("tag_id"), "t.weight"))


def tag_scores(scores: DataFrame, tags: DataFrame) -> DataFrame:
    """Positive interest of each device in each tag as decimal(12,9).

    Tags are packed to one row per item, so that a hot item meets its tags by broadcast.
    """
    packed = (tags.groupBy(F.col("id").alias("info_id"))
              .agg(F.collect_list(F.struct("tag_id", "weight")).alias("_tags")))
    rows = lookup(scores, packed, "info_id").where(F.col("_tags").isNotNull())
    return (rows.select("device_id", "score", F.explode("_tags").alias("t"))
            .groupBy("device_id", F.col("t.tag_id").alias("tag_id"))
            .agg(F.sum(F.col("score") * F.col("t.weight")).try_cast("decimal(12,9)").alias("score"))
            .where(F.col("score") > 0))


def ranked_tags(scores: DataFrame, tags: DataFrame, n: int = 50, nw: int = 30, scale: int = 5,
                weight_scale: int = 2) -> DataFrame:
    """The best ``n`` tags of each device: place, score rounded up, and among the first ``nw`` the
    share of their sum (null behind them)."""
    top = top_per_key(tag_scores(scores, tags), ["device_id"], [F.desc("score"), F.asc("tag_id")],
                      max(n, nw), rank="place")
    heavy = F.when(F.col("place") <= nw, F.col("score"))
    total = F.sum(heavy).over(Window.partitionBy("device_id"))
    return top.select("device_id", "tag_id", "place",
                      F.when(F.col("place") <= n, F.ceil("score", F.lit(scale))).alias("tag_score"),
                      F.round(F.try_divide(heavy, total), weight_scale).alias("weight"))


def user_profile(scores: DataFrame, tags: DataFrame, n: int = 50, nw: int = 30) -> DataFrame:
    """One row per device: ``tags`` and ``wtags`` as packed lists, best first."""
    rows = ranked_tags(scores, tags, n, nw)

    def packed(value: str) -> Column:
        entry = F.when(F.col(value) > 0, F.struct("place", F.col("tag_id").alias("tag"),
                                                  F.col(value).alias("weight")))
        ordered = F.array_sort(F.collect_list(entry))
        return format_pairs(F.transform(ordered, lambda e: F.struct(e["tag"].alias("tag"),
                                                                    e["weight"].alias("weight"))))

    return rows.groupBy("device_id").agg(packed("tag_score").alias("tags"),
                                         packed("weight").alias("wtags"))


def pair_similarity(vectors: DataFrame, pairs: DataFrame) -> DataFrame:
    """Dot, cosine and Pearson of given pairs (a, b) of ``vectors`` (id, vector map)."""
    left = vectors.select(F.col("id").alias("a"), F.col("vector").alias("_va"))
    right = vectors.select(F.col("id").alias("b"), F.col("vector").alias("_vb"))
    joined = lookup(lookup(pairs, left, "a"), right, "b").dropna(subset=["_va", "_vb"])
    return joined.select("a", "b", dot("_va", "_vb").alias("dot"), cosine("_va", "_vb").alias("cosine"),
                         pearson("_va", "_vb").alias("pearson"))


def active_users(active: DataFrame, now: str, days: int = 7) -> DataFrame:
    """Devices active in the last ``days`` days, with their last time."""
    end = F.lit(now).cast("timestamp")
    recent = active.where((F.col("active_time") >= end - F.make_interval(days=F.lit(days)))
                          & (F.col("active_time") <= end))
    return recent.groupBy("device_id").agg(F.max("active_time").alias("active_time"))


def recent_items(items: DataFrame, now: str, hours: int = 72) -> DataFrame:
    """Items published in the last ``hours`` hours."""
    end = F.lit(now).cast("timestamp")
    return items.where((F.col("publish_time") > end - F.make_interval(hours=F.lit(hours)))
                       & (F.col("publish_time") < end))


def _block_tables(frames: Iterator[pd.DataFrame]) -> tuple[pd.DataFrame, ...]:
    """Users, items and seen pairs of the block that fills a partition."""
    rows = pd.concat(list(frames), ignore_index=True)
    return tuple(rows[rows["kind"] == k] for k in (0, 1, 2))


class TagIndex:
    """Items by tag, for the best items of one user after the other.

    The list of a tag holds its items by falling share of the tag in the item's vector. A user's
    lists are read from the end that adds most; what is read is scored in full, and reading stops
    when no unread entry can lead to an item that beats the ``n``-th best, since an item that no
    list has shown yet scores at most the sum of what the next entries add. ``scored`` counts the
    items that were scored.
    """

    def __init__(self, ids: np.ndarray, times: np.ndarray, tags: list[np.ndarray], weights: list[np.ndarray]):
        order = np.lexsort((-ids, -times))  # newest first, so that a smaller place wins a tie
        self.ids, self.times, self.scored = ids[order], times[order], 0
        sizes = np.array([len(tags[k]) for k in order], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(sizes)])
        self.tag = np.concatenate([tags[k] for k in order]).astype(np.int64)
        self.weight = np.concatenate([weights[k] for k in order]).astype(np.float64)
        owner = np.repeat(np.arange(len(order)), sizes)
        self.length = np.sqrt(np.bincount(owner, self.weight * self.weight, len(order)))
        self.tags, self.number = np.unique(self.tag, return_inverse=True)
        # A tag that an item has twice is one entry of the list.
        entry, once = np.unique(owner * len(self.tags) + self.number, return_inverse=True)
        owner, number = np.divmod(entry, max(1, len(self.tags)))
        share = np.bincount(once, self.weight, len(entry)) / np.where(self.length > 0, self.length, 1)[owner]
        listed = np.lexsort((owner, -share, number))
        self.list_item, self.list_share = owner[listed], share[listed]
        self.list_begin = np.searchsorted(number[listed], np.arange(len(self.tags) + 1))
        self.taste = np.zeros(len(self.tags))  # the weights of the user at hand

    def _score(self, items: np.ndarray) -> np.ndarray:
        sizes = self.begin[items + 1] - self.begin[items]
        at = np.arange(int(sizes.sum())) + np.repeat(self.begin[items] - (np.cumsum(sizes) - sizes), sizes)
        self.scored += len(items)
        return np.bincount(np.repeat(np.arange(len(items)), sizes), self.taste[self.number[at]] * self.weight[at], len(items))

    def best(self, tags: np.ndarray, weights: np.ndarray, seen: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and similarities of the ``n`` most similar items, best first; ``seen`` are places
        that don't count."""
        known = np.searchsorted(self.tags, tags)
        met = self.tags[np.minimum(known, len(self.tags) - 1)] == tags
        at, inverse = np.unique(known[met], return_inverse=True)
        taste = np.bincount(inverse, weights[met], len(at))
        size = np.sqrt((weights * weights).sum())
        at, taste = at[taste != 0], taste[taste != 0]
        none = np.zeros(0, np.int64), np.zeros(0)
        if not len(at) or size == 0:
            return none
        self.taste[at] = taste
        low, high = self.list_begin[at].copy(), self.list_begin[at + 1].copy()
        step, up = max(1, FIRST_READ // len(at)), taste > 0
        gone = np.zeros(len(self.ids), bool)
        gone[seen] = True
        places, sims = none
        while True:
            # What weighs most in the item adds most; for a negative taste, what weighs least or is negative.
            take = np.minimum(high - low, step)
            first = np.where(up, low, high - take)
            low, high = low + take * up, high - take * ~up
            fresh = np.zeros(len(self.ids), bool)
            fresh[self.list_item[np.arange(int(take.sum())) + np.repeat(first - (np.cumsum(take) - take), take)]] = True
            fresh = np.flatnonzero(fresh & ~gone)
            gone[fresh] = True
            dots = self._score(fresh)
            fresh, dots = fresh[dots > 0], dots[dots > 0]
            places = np.concatenate([places, fresh])
            sims = np.concatenate([sims, np.round(dots / (self.length[fresh] * size), 12)])
            if len(places) > n:  # ties of the n-th stay
                kept = sims >= np.partition(sims, len(sims) - n)[len(sims) - n]
                places, sims = places[kept], sims[kept]
            more = low < high
            if not more.any():
                break
            next_share = np.where(up, self.list_share[np.minimum(low, len(self.list_share) - 1)], self.list_share[high - 1])
            reach = np.maximum(taste * next_share, 0)[more].sum() / size
            if reach <= 0 or (len(places) >= n and sims.min() > reach + 1e-9):
                break
            step *= 2
        self.taste[at] = 0
        order = np.lexsort((places, -sims))[:n]
        return places[order], sims[order]


def _score_block(n: int):
    """The best ``n`` unseen items for every user of a block; one partition is one pair of blocks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = next(frames, None)
        if first is None:
            return
        users, items, seen = _block_tables(iter([first, *frames]))
        if not len(users) or not len(items):
            return
        index = TagIndex(items["info_id"].to_numpy(np.int64), items["publish_us"].to_numpy(np.int64),
                         items["tag_ids"].tolist(), items["weights"].tolist())
        place = pd.Series(np.arange(len(index.ids)), index=index.ids)
        met = pd.DataFrame({"user": seen["device_id"], "place": seen["info_id"].map(place)}).dropna()
        met = {u: p.to_numpy(np.int64) for u, p in met.groupby("user")["place"]}
        nothing, rows = np.zeros(0, np.int64), []

        def found() -> pd.DataFrame:
            at = np.concatenate([r[1] for r in rows])
            return pd.DataFrame({"device_id": np.repeat([r[0] for r in rows], [len(r[1]) for r in rows]), "info_id": index.ids[at],
                                 "similarity": np.concatenate([r[2] for r in rows]), "publish_us": index.times[at]})

        for user, tags, weights in zip(users["device_id"], users["tag_ids"], users["weights"]):
            rows.append((user, *index.best(tags.astype(np.int64), weights.astype(np.float64), met.get(user, nothing), n)))
            if len(rows) == 1000:
                yield found()
                rows = []
        if rows:
            yield found()

    return run


def _vector_columns(c: str) -> list[Column]:
    return [F.transform(c, lambda t: t["tag"]).alias("tag_ids"),
            F.transform(c, lambda t: t["weight"]).alias("weights")]


def _blocks(users: int, items: int, tasks: int) -> tuple[int, int]:
    """How many blocks of users and of items: none above its size, and a pair for every task as long
    as that leaves a task enough users. What is moved is users x item blocks + items x user blocks."""
    item_blocks = max(1, math.ceil(items / ITEM_BLOCK))
    user_blocks = max(1, math.ceil(users / USER_BLOCK), min(math.ceil(tasks / item_blocks), users // LEAST_USERS))
    return user_blocks, item_blocks


def recommend_similar(profiles: DataFrame, active: DataFrame, items: DataFrame, seen: DataFrame, now: str,
                      n: int = 100, days: int = 7, hours: int = 72) -> DataFrame:
    """The ``n`` unseen recent items most like each active user's profile.

    ``profiles`` (device_id, tags) and ``items`` (id, tags, publish_time) hold arrays of
    (tag, weight). Users and items are written and counted first and dealt into blocks of about
    ``USER_BLOCK`` and ``ITEM_BLOCK``. Each pair of blocks is one partition and is scored by one task, which keeps
    the best ``n`` items of a user; the winners of several item blocks are ranked again. What was
    seen goes to the one block pair it concerns. So no frequent tag and no long item list makes
    pairs that have to be shuffled, nothing is collected, and no user or item is left out. Inside a
    block, :class:`TagIndex` scores the items that a user's tags lead to until no other can win.
    """
    spark = profiles.sparkSession
    latest = written(recent_items(items.where(F.size("tags") > 0), now, hours).select("id", "tags", "publish_time"), "items")
    people = profiles.where(F.size("tags") > 0).join(active_users(active, now, days), "device_id", "left_semi")
    people = written(people.select("device_id", "tags"), "people")
    user_blocks, item_blocks = _blocks(people.count(), latest.count(), spark.sparkContext.defaultParallelism)
    ub, ib = F.pmod(F.xxhash64("device_id"), F.lit(user_blocks)), F.pmod(F.xxhash64("info_id"), F.lit(item_blocks))
    every_item_block = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(item_blocks - 1).cast("long")))
    every_user_block = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(user_blocks - 1).cast("long")))
    nothing = F.lit(None)
    no_tags = [nothing.cast("array<long>").alias("tag_ids"), nothing.cast("array<double>").alias("weights")]
    device = profiles.schema["device_id"].dataType.simpleString()
    latest = latest.select(F.col("id").cast("long").alias("info_id"), *_vector_columns("tags"),
                           F.unix_micros("publish_time").alias("publish_us"))
    users = people.select(F.lit(0).alias("kind"), "device_id", nothing.cast("long").alias("info_id"), *_vector_columns("tags"),
                          nothing.cast("long").alias("publish_us"), ub.alias("ub"), every_item_block.alias("ib"))
    wares = latest.select(F.lit(1).alias("kind"), nothing.cast(device).alias("device_id"), "info_id", "tag_ids", "weights", "publish_us",
                          every_user_block.alias("ub"), ib.alias("ib"))
    met = (seen.select("device_id", F.col("info_id").cast("long").alias("info_id"))
           .join(latest.select("info_id"), "info_id", "left_semi").distinct()
           .select(F.lit(2).alias("kind"), "device_id", "info_id", *no_tags, nothing.cast("long").alias("publish_us"),
                   ub.alias("ub"), ib.alias("ib")))
    pair = (F.col("ub") * item_blocks + F.col("ib")).cast("int")
    dealt = users.unionByName(wares).unionByName(met).repartitionById(user_blocks * item_blocks, pair).drop("ub", "ib")
    found = dealt.mapInPandas(_score_block(n), f"device_id {device}, info_id long, similarity double, publish_us long")
    if item_blocks > 1:
        found = top_per_key(found, ["device_id"], [F.desc("similarity"), F.desc("publish_us"),
                                                   F.desc("info_id")], n).drop("_rank")
    order = Window.partitionBy("device_id").orderBy(F.desc("publish_us"), F.desc("similarity"),
                                                    F.desc("info_id"))
    return (found.withColumn("place", F.row_number().over(order))
            .select("device_id", "place", "info_id", "similarity",
                    F.timestamp_micros("publish_us").alias("publish_time")))


def paginate(recommended: DataFrame, size: int = 10, ttl_seconds: int = 3 * 24 * 3600) -> DataFrame:
    """Pages of comma-joined item ids in place order; a page holds at most ``size`` ids."""
    page = F.floor((F.col("place") - 1) / size).cast("int") + 1
    return (recommended.groupBy("device_id", page.alias("page"))
            .agg(F.array_sort(F.collect_list(F.struct("place", "info_id"))).alias("_p"))
            .select("device_id", "page",
                    F.array_join(F.transform("_p", lambda p: p["info_id"].cast("string")), ",").alias("ids"),
                    F.lit(ttl_seconds).alias("ttl_seconds")))


def stamp_recommendations(recommended: DataFrame) -> DataFrame:
    """Recommendations with the unique stamp of the result table: publish time in ms plus 999
    falling by one along the publish times of the user, over all of the user's items."""
    ties = [F.desc("similarity")] if "similarity" in recommended.columns else []
    order = Window.partitionBy("device_id").orderBy(F.desc("publish_time"), *ties, F.desc("info_id"))
    stamp = F.unix_millis("publish_time") + 1000 - F.row_number().over(order)
    return recommended.withColumn("stamp_ms", stamp)


def recommend_similar_table(profiles: DataFrame, active: DataFrame, items: DataFrame, pending: DataFrame,
                            history: DataFrame, now: str, **options) -> DataFrame:
    """:func:`recommend_similar` without what is pending or was already shown, stamped."""
    seen = pending.select("device_id", "info_id").unionByName(history.select("device_id", "info_id"))
    return stamp_recommendations(recommend_similar(profiles, active, items, seen, now, **options))


def recommend_by_category(wtags: DataFrame, items: DataFrame, seen: DataFrame, now: str | None = None,
                          n: int = 100, hours: int = 72, active: DataFrame | None = None, days: int = 7) -> DataFrame:
    """Per user tag (device_id, tag_id, weight) that is an item category: its newest
    ``round(weight * n)`` unseen items.

    ``now`` restricts the items to the last ``hours`` hours, and with ``active`` (device_id,
    active_time) the users to those active in the last ``days`` days. A category is read only as
    deep as its most demanding user can reach, which is what that user wants plus has already seen
    there; the work follows the result and not users times items. Items without a publish time,
    which only count without ``now``, come last.
    """
    if active is not None:
        if now is None:
            raise ValueError("active users are those of the days before now")
        wtags = wtags.join(active_users(active, now, days), "device_id", "left_semi")
    latest = items if now is None else recent_items(items, now, hours)
    latest = latest.select("category_id", F.col("id").alias("info_id"), "publish_time")
    sizes = latest.groupBy("category_id").agg(F.count("*").alias("_size"))
    met = (lookup(seen.select("device_id", "info_id").distinct(), latest.select("info_id", "category_id"),
                  "info_id").where(F.col("category_id").isNotNull()))
    met_counts = met.groupBy("device_id", "category_id").agg(F.count("*").alias("_met"))
    wanted = (lookup(wtags.select("device_id", F.col("tag_id").alias("category_id"), "weight",
                                  F.round(F.col("weight") * n).cast("int").alias("_want")),
                     sizes, "category_id")
              .where(F.col("_size").isNotNull() & (F.col("_want") > 0))
              .join(met_counts, ["device_id", "category_id"], "left"))
    wanted = wanted.withColumn("_reach", F.least(F.col("_want") + F.coalesce("_met", F.lit(0)), F.col("_size")).cast("int"))
    depth = wanted.groupBy("category_id").agg(F.max("_reach").alias("_depth"))
    ranked = top_per_key(lookup(latest, depth, "category_id").where("_depth IS NOT NULL"), ["category_id"],
                         [F.desc("publish_time"), F.desc("info_id")], "_depth", rank="_pos").drop("_depth")
    probes = wanted.withColumn("_pos", F.explode(F.sequence(F.lit(1), F.col("_reach"))))
    candidates = probes.join(ranked, ["category_id", "_pos"])
    fresh = candidates.join(met.select("device_id", "info_id"), ["device_id", "info_id"], "left_anti")
    order = Window.partitionBy("device_id", "category_id").orderBy("_pos")
    return (fresh.withColumn("place", F.row_number().over(order)).where(F.col("place") <= F.col("_want"))
            .select("device_id", "category_id", "weight", "place", "info_id", "publish_time"))


def recommend_by_category_table(wtags: DataFrame, active: DataFrame, items: DataFrame, seen: DataFrame, now: str,
                                **options) -> DataFrame:
    """:func:`recommend_by_category` for active users, stamped over the whole result of a user."""
    return stamp_recommendations(recommend_by_category(wtags, items, seen, now, active=active, **options))


def random_tag(profiles: DataFrame, n: int = 3, seed: int = 0) -> DataFrame:
    """One of the first ``n`` tags of each device, picked by a seeded digest of its id.

    ``profiles`` has device_id and wtags as an array of (tag, weight), best first.
    """
    count = F.least(F.lit(n), F.size("wtags"))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("device_id").cast("string")))
    # the first 32 bits of the digest: the same pick on every engine and in every run
    pick = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % count).cast("int")
    return (profiles.where(F.size("wtags") > 0)
            .select("device_id", F.element_at("wtags", pick + 1)["tag"].alias("tag_id")))


def tag_counts(picked: DataFrame) -> DataFrame:
    """Users per tag."""
    return picked.groupBy("tag_id").agg(F.count("*").alias("user_count"))
