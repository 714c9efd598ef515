"""Recommendation against brute force on small fixtures."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.operators import content, ranking, recommend
from tests.conftest import table

NOW = "2024-01-10 00:00:00"


@pytest.fixture(scope="module")
def world(spark):
    r = random.Random(5)
    users = {f"u{i}": {r.randrange(12): round(r.uniform(0.1, 2), 3) for _ in range(r.randrange(1, 5))} for i in range(40)}
    items = {i: ({r.randrange(12): round(r.uniform(0.1, 2), 3) for _ in range(r.randrange(1, 4))}, f"2024-01-0{r.randrange(5, 10)} 0{r.randrange(10)}:00:00") for i in range(120)}
    seen = {(f"u{r.randrange(40)}", r.randrange(120)) for _ in range(400)}
    pack = lambda v: [(t, w) for t, w in v.items()]
    arr = "array<struct<tag:bigint,weight:double>>"
    profiles = spark.createDataFrame([(u, pack(v)) for u, v in users.items()], f"device_id string, tags {arr}")
    stuff = spark.createDataFrame([(i, pack(v), t) for i, (v, t) in items.items()], f"id bigint, tags {arr}, publish_time string")
    active = spark.createDataFrame([(u, "2024-01-09 00:00:00" if int(u[1:]) % 5 else "2023-12-01 00:00:00") for u in users], "device_id string, active_time string")
    ts = lambda df, c: df.withColumn(c, F.col(c).cast("timestamp"))
    return users, items, seen, profiles, ts(active, "active_time"), ts(stuff, "publish_time"), spark.createDataFrame(sorted(seen), "device_id string, info_id bigint")


def brute(users, items, seen, n):
    size = lambda v: math.sqrt(sum(x * x for x in v.values()))
    out = {}
    for u, p in users.items():
        if int(u[1:]) % 5 == 0:
            continue
        found = []
        for i, (v, t) in items.items():
            dot = sum(p[k] * v[k] for k in p if k in v)
            if t > "2024-01-07 00:00:00" and dot > 0 and (u, i) not in seen:
                found.append((round(dot / (size(p) * size(v)), 9), t, i))
        best = sorted(found, reverse=True)[:n]
        if best:
            out[u] = [x[2] for x in sorted(best, key=lambda x: (x[1], x[0], x[2]), reverse=True)]
    return out


@pytest.mark.parametrize("item_block,user_block", [(20_000, 50_000), (30, 11)])
def test_similar_items_match_brute_force(world, monkeypatch, item_block, user_block):
    """In one block, and with more items and users than a block holds."""
    users, items, seen, profiles, active, stuff, seen_df = world
    monkeypatch.setattr(recommend, "ITEM_BLOCK", item_block)
    monkeypatch.setattr(recommend, "USER_BLOCK", user_block)
    got = recommend.recommend_similar(profiles, active, stuff, seen_df, NOW, n=7)
    lists = {}
    for r in got.orderBy("device_id", "place").collect():
        lists.setdefault(r.device_id, []).append(r.info_id)
        assert r.place == len(lists[r.device_id])
    assert lists == brute(users, items, seen, 7)


@pytest.mark.parametrize("seed", range(6))
def test_early_termination_is_exact(seed):
    """Every user's best items as by scoring all of them: ties, negative weights, tags given twice."""
    r = np.random.default_rng(seed)
    m, n = 400, 10
    tags = [r.integers(0, 15, r.integers(1, 5)) for _ in range(m)]
    weights = [np.round(r.choice([-1, 1], len(t), p=[0.1, 0.9]) * r.integers(1, 6, len(t)), 1).astype(float) for t in tags]
    ids, times = r.permutation(m).astype(np.int64), r.integers(0, 50, m)
    index = recommend.TagIndex(ids, times, tags, weights)
    for _ in range(60):
        mine, liking = r.integers(0, 18, r.integers(1, 8)), np.round(r.normal(1, 1, 8), 1)
        liking = liking[:len(mine)]
        seen = r.choice(m, r.integers(0, 100), replace=False)
        got, sims = index.best(mine, liking, seen, n)
        hidden, scores = set(index.ids[seen]), []
        for i in range(m):
            dot = sum(w * x for t, w in zip(mine, liking) for u, x in zip(tags[i], weights[i]) if t == u)
            size = math.sqrt((liking ** 2).sum()) * math.sqrt((weights[i] ** 2).sum())
            if dot > 1e-12 and ids[i] not in hidden:
                scores.append((-round(dot / size, 12), -times[i], -ids[i]))
        want = sorted(scores)[:n]
        assert index.ids[got].tolist() == [-i for _, _, i in want]
        assert np.allclose(sims, [-s for s, _, _ in want], atol=1e-11)


def test_few_items_are_scored():
    """Twenty thousand items of five tags out of two thousand, users of fifty tags: what is scored
    is a small part of users times items."""
    r = np.random.default_rng(1)
    m, users = 20_000, 40
    popular = lambda k: np.unique((2000 * r.random(k) ** 2).astype(np.int64))
    tags = [popular(5) for _ in range(m)]
    index = recommend.TagIndex(np.arange(m), np.zeros(m, np.int64), tags, [r.random(len(t)) + 0.1 for t in tags])
    for _ in range(users):
        mine = popular(50)
        index.best(mine, r.random(len(mine)) ** 4, np.zeros(0, np.int64), 100)
    assert index.scored < 0.2 * users * m
    print("scored", index.scored / (users * m))


def test_short_lists_are_read_at_a_time(monkeypatch):
    """Two thousand items of three tags out of twenty: a user's lists are read in a few reads."""
    r = np.random.default_rng(2)
    tags = [r.choice(20, 3, replace=False) for _ in range(2000)]
    index = recommend.TagIndex(np.arange(2000), np.zeros(2000, np.int64), tags, [r.random(3) + 0.1 for _ in tags])
    reads, score = [], recommend.TagIndex._score
    monkeypatch.setattr(recommend.TagIndex, "_score", lambda self, items: reads.append(len(items)) or score(self, items))
    for _ in range(20):
        index.best(np.arange(20), r.random(20), np.zeros(0, np.int64), 100)
    assert len(reads) <= 20 * 4


def test_users_are_made_once(world, spark):
    """Profiles are long work: what deals out the users reads them as they were written to be counted."""
    _, _, _, profiles, active, stuff, seen_df = world
    plan = recommend.recommend_similar(profiles, active, stuff, seen_df, NOW, 7)._jdf.queryExecution().executedPlan().toString()
    assert "/people-" in plan and "/items-" in plan and "active_time" not in plan


def test_block_counts():
    assert recommend._blocks(0, 0, 8) == (1, 1)
    assert recommend._blocks(10_000, 100, 8) == (8, 1) and recommend._blocks(900, 100, 8) == (1, 1)
    users, items = recommend._blocks(10**7, 10**5, 1000)
    assert (users, items) == (200, 5)
    assert recommend._blocks(10**9, 10**6, 1000) == (20_000, 50)


def test_all_users_and_items_count(world):
    _, items, _, profiles, active, stuff, seen_df = world
    assert recommend.active_users(active, NOW).count() == 32
    assert recommend.recent_items(stuff, NOW).count() == sum(t > "2024-01-07 00:00:00" for _, t in items.values())


def test_pages_and_stamps(spark):
    recs = spark.createDataFrame([("u", i + 1, 100 + i, 1.0, f"2024-01-01 00:00:{59 - i:02d}") for i in range(12)], "device_id string, place int, info_id long, similarity double, publish_time string")
    recs = recs.withColumn("publish_time", F.col("publish_time").cast("timestamp"))
    pages = [tuple(r) for r in recommend.paginate(recs, 5, 60).orderBy("page").collect()]
    assert pages == [("u", 1, "100,101,102,103,104", 60), ("u", 2, "105,106,107,108,109", 60), ("u", 3, "110,111", 60)]
    stamps = [r.stamp_ms for r in recommend.stamp_recommendations(recs).orderBy("place").collect()]
    assert stamps[0] % 1000 == 999 and stamps[1] % 1000 == 998 and len(set(stamps)) == 12


def test_category_items_match_brute_force(spark):
    r = random.Random(9)
    wtags = [(f"u{u}", c, r.choice([0.0, 0.02, 0.2, 0.5])) for u in range(20) for c in r.sample(range(6), 3)]
    items = [(i, r.randrange(5), f"2024-01-{r.randrange(1, 29):02d}") for i in range(150)]
    seen = sorted({(f"u{r.randrange(20)}", r.randrange(150)) for _ in range(600)})
    got = recommend.recommend_by_category(
        spark.createDataFrame(wtags, "device_id string, tag_id long, weight double"),
        spark.createDataFrame(items, "id long, category_id long, p string").select("id", "category_id", F.col("p").cast("timestamp").alias("publish_time")),
        spark.createDataFrame(seen, "device_id string, info_id long"), n=20)
    want, met = [], set(seen)
    for u, c, w in wtags:
        fresh = sorted(((t, i) for i, cat, t in items if cat == c and (u, i) not in met), reverse=True)
        want += [(u, c, place, i) for place, (t, i) in enumerate(fresh[:int(w * 20 + 0.5)], start=1)]
    assert sorted((x.device_id, x.category_id, x.place, x.info_id) for x in got.collect()) == sorted(want)


def test_category_table_is_for_active_users_and_stamped(spark, rows):
    wtags = spark.createDataFrame([("a", 1, 0.5), ("a", 2, 0.5), ("b", 1, 1.0)], "device_id string, tag_id long, weight double")
    active = rows("device_id string, active_time timestamp", [("a", "2024-01-09"), ("b", "2023-12-01")])
    items = rows("id long, category_id long, publish_time timestamp",
                 [(i, 1 + i % 2, f"2024-01-09 00:0{i // 2}:00") for i in range(8)])
    seen = spark.createDataFrame([("a", 7)], "device_id string, info_id long")
    got = recommend.recommend_by_category_table(wtags, active, items, seen, NOW, n=4).orderBy(F.desc("stamp_ms")).collect()
    assert [(r.device_id, r.info_id) for r in got] == [("a", 6), ("a", 5), ("a", 4), ("a", 3)]
    assert [r.stamp_ms % 1000 for r in got] == [999, 998, 997, 996]
    with pytest.raises(ValueError):
        recommend.recommend_by_category(wtags, items, seen, active=active)


def test_a_category_without_times_is_taken_whole(rows, spark):
    items = rows("id long, category_id long, publish_time timestamp", [(i, 1, None if i % 2 else "2024-01-01") for i in range(50)])
    wtags = spark.createDataFrame([("u", 1, 1.0)], "device_id string, tag_id long, weight double")
    none = spark.createDataFrame([], "device_id string, info_id long")
    got = [r.info_id for r in recommend.recommend_by_category(wtags, items, none).orderBy("place").collect()]
    assert got == [*range(48, -1, -2), *range(49, 0, -2)]


def test_decay_of_one_day_drops_the_tag(rows):
    clicks = rows("device_id string, info_id long, event_name string, click_date string, click_count int",
                  [("u", 1, "recreate_click", "2024-01-09", 1), ("u", 2, "share", "2024-01-06", 9), ("u", 9, "unknown_event", "2024-01-06", 9)])
    users = recommend.item_users(clicks)
    tags = rows("id long, tag_id long, weight double", [(1, 10, 1.0), (2, 10, 1.0), (2, 11, 0.5)])
    weights = {"recreate_click": 1.0, "share": 0.8}
    ref = recommend.user_item_score(clicks, users, weights, "2024-01-10")
    assert {r.info_id: r.score for r in ref.collect()}[1] == float("inf")
    score = 0.8 * (1 / math.log(4) + 1) * 3
    assert table(recommend.tag_scores(ref, tags)) == [("u", "11", f"{score / 2:.9f}")]
    smooth = recommend.user_item_score(clicks, users, weights, "2024-01-10", decay="smooth")
    assert {r.tag_id for r in recommend.tag_scores(smooth, tags).collect()} == {10, 11}


def test_profile_rounding(rows):
    scores = rows("device_id string, info_id long, score double", [("u", 1, 1.0)])
    tags = rows("id long, tag_id long, weight double", [(1, 1, 0.1234567), (1, 2, 0.8), (1, 3, 0.0000011), (1, 4, 0.0)])
    got = recommend.user_profile(scores, tags).first()
    assert got.tags == "2:0.80000,1:0.12346,3:0.00001" and got.wtags == "2:0.87,1:0.13"
    two = recommend.user_profile(scores, tags, n=2, nw=1).first()
    assert two.tags == "2:0.80000,1:0.12346" and two.wtags == "2:1.00"


def test_random_tag_is_repeatable_and_within_the_first(spark):
    df = spark.range(300).selectExpr("concat('u', id) AS device_id",
                                     "slice(array(named_struct('tag', 1L), named_struct('tag', 2L), named_struct('tag', 3L), named_struct('tag', 4L)), 1, CAST(id % 5 AS INT)) AS wtags")
    a, b = table(recommend.random_tag(df, 3, seed=1)), table(recommend.random_tag(df.repartition(3), 3, seed=1))
    assert a == b and len(a) == 240 and {t for _, t in a} == {"1", "2", "3"}
    assert a != table(recommend.random_tag(df, 3, seed=2))
    assert sum(r.user_count for r in recommend.tag_counts(recommend.random_tag(df)).collect()) == 240


def test_clicks_need_label_one(rows):
    ev = rows("deviceid string, eventid string, acc string, label string, date string",
              [("u", "recreate_click", "1", None, "d"), ("u", "recreate_click", "1", "9", "d"), ("u", "share", "1", "1", "d"), ("u", "share", "1", "2", "d"), ("", "share", "1", "1", "d"), ("u", "comments", "", "1", "d")])
    assert table(recommend.user_clicks(ev)) == [("u", "1", "recreate_click", "d", "2"), ("u", "1", "share", "d", "1")]


def test_engagement_nulls_and_fill(rows):
    ev = rows("deviceid string, eventid string, acc string, label string", [("u", "video_click", "1", None), ("u", "video_click", "1", None), ("w", "recreate_click", "1", None), ("u", "share", "2", "1"), ("u", "comments", "1", "3")])
    items = rows("id string, title string", [("1", "a"), ("2", "b"), ("3", "c")])
    assert table(content.engagement(ev, items)) == [("1", "3", "2", "", "", "", "", "a")]
    full = content.engagement_by_content(items, ev, "r", content.INFO_EVENTS)
    assert table(full) == [("1", "a", "3", "2", "0", "0", "0", "0", "r"), ("2", "b", "0", "0", "0", "0", "1", "1", "r"), ("3", "c", "0", "0", "0", "0", "0", "0", "r")]


def test_times_in_top_counts_months(rows):
    df = rows("star_id long, user_id long, year int, month int, total_index int, update_time timestamp",
              [(1, u, 2024, m, 100 - u, "2024-01-01") for m in (1, 2) for u in range(5)] + [(1, 9, 2024, 1, 98, "2023-01-01")])
    assert table(ranking.times_in_top(df)) == [("1", "0", "2"), ("1", "1", "2"), ("1", "2", "1"), ("1", "9", "1")]


def test_leaders(rows):
    df = rows("focus_time timestamp, fan_dynamic_num int, fan_dynamic_top_num int, fan_dynamic_cream_num int, fan_month_num int",
              [("2024-01-01", 30, 1, 1, 1), ("2024-01-31", 30, 1, 1, 1), ("2024-01-01", 29, 1, 1, 1), ("2024-01-01", 30, 1, 0, 1), (None, 30, 2, 2, 2), ("2024-01-01", 30, 2, 2, None)])
    assert [r.is_satisfy_header for r in ranking.eligible_leaders(df, "2024-02-01").collect()] == [1, 0, 0, 0, 0, 0]
