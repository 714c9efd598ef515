"""Folds against a plain Python fold, and the invariants of a merge."""

import random

import pytest
from pyspark.sql import functions as F

from tallyline.operators import merge
from tallyline.operators.fold import Policy
from tallyline.operators.skew import bucketed_lag, distinct_users, top_per_key
from tests.conftest import table

LOG = "aid string, channel_code string, area string, ip string, create_time timestamp"


def visits(seed, n=300):
    r = random.Random(seed)
    return [(f"u{r.randrange(20)}", f"c{r.randrange(3)}", r.choice(["x", "y", None]), f"ip{i}",
             f"2024-01-{r.randrange(1, 29):02d} 10:{i // 60:02d}:{i % 60:02d}") for i in range(n)]


def test_new_users_match_a_plain_fold(rows):
    data = visits(1)
    want = {}
    for aid, channel, area, ip, t in sorted(data, key=lambda x: x[4]):
        if aid not in want:
            want[aid] = [aid, channel, area, area, ip, ip, t, t]
        want[aid][3], want[aid][5], want[aid][7] = area, ip, t
    got = table(merge.merge_new_users(None, rows(LOG, data)), "aid", "channel_code", "init_area", "area", "init_ip", "ip",
                "create_time", "update_time")
    assert got == sorted(tuple("" if x is None else x for x in w) for w in want.values())


def test_new_users_drop_incomplete_rows(rows):
    df = rows(LOG, [(None, "c", "a", "i", "2024-01-01"), ("u", None, "a", "i", "2024-01-01"), ("u", "c", None, None, None),
                    ("v", "c", None, None, "2024-01-02 03:04:05")])
    assert table(merge.merge_new_users(None, df), "aid", "area", "create_date") == [("v", "", "20240102")]


def test_merging_twice_or_in_any_order_is_the_same(rows):
    a, b = visits(2, 150), visits(3, 150)
    whole = table(merge.merge_new_users(None, rows(LOG, a + b)))
    ab = merge.merge_new_users(merge.merge_new_users(None, rows(LOG, a)), rows(LOG, b))
    ba = merge.merge_new_users(merge.merge_new_users(None, rows(LOG, b)), rows(LOG, a))
    again = merge.merge_new_users(ab, rows(LOG, b))
    assert table(ab) == whole and table(ba) == whole and table(again) == whole


def test_stored_row_comes_before_a_log_row_of_the_same_time(rows):
    stored = merge.merge_new_users(None, rows(LOG, [("u", "old", "a", "i", "2024-01-01")]))
    merged = merge.merge_new_users(stored, rows(LOG, [("u", "new", "b", "j", "2024-01-01")]))
    assert table(merged, "channel_code", "init_area", "area", "ip") == [("old", "a", "b", "j")]


DEVICE = "udid string, imsi string, model string, network string, create_time timestamp, update_time timestamp"


def test_devices_take_first_usable_imsi_and_best_network(rows):
    t = [f"2024-01-0{i}" for i in range(1, 7)]
    data = [("u", "", "m1", "Wifi", t[0], t[0]), ("u", "null", "m2", "3G", t[1], t[1]), ("u", None, "m3", "GPRS", t[2], t[2]),
            ("u", "46000x", "m4", "", t[3], t[3]), ("u", "46001y", "m5", "2G", t[4], t[4]), ("w", "NULL", "m", "Unknown", t[5], t[5])]
    merged = merge.merge_devices(None, rows(DEVICE, data))
    assert table(merged) == [("u", "46000x", "m1", "3G", "2024-01-01 00:00:00", "2024-01-05 00:00:00"),
                             ("w", "", "m", "Unknown", "2024-01-06 00:00:00", "2024-01-06 00:00:00")]
    late_first = merge.merge_devices(merge.merge_devices(None, rows(DEVICE, data[3:])), rows(DEVICE, data[:3]))
    assert table(late_first) == table(merged)


def test_sdk_devices_keep_code_when_imsi_has_none(rows):
    ddl = ("uuid string, network string, have_vpn int, imsi string, wifi_mac string, phone_no string, isp_code int, "
           "create_time timestamp, update_time timestamp")
    stored = rows(ddl, [("u", "WIFI", 1, "460", None, "null", 46001, "2024-01-01", "2024-01-01")])
    log = rows(ddl, [("u", "2G", 0, "46003123", "mac", "139", 0, "2024-01-02", "2024-01-02"),
                     ("v", "x", 0, None, None, None, 0, "2024-01-02", "2024-01-02")])
    got = table(merge.merge_devices_sdk(stored, log), "uuid", "network", "have_vpn", "imsi", "wifi_mac", "phone_no", "isp_code")
    assert got == [("u", "2G", "1", "460", "mac", "139", "46001"), ("v", "Unknown", "0", "", "", "", "0")]


def test_rich_policy(rows):
    ddl = "k string, a string, b string, n int, m int, create_time timestamp, update_time timestamp"
    data = [("k", "unknown", "b1", 0, 3, "2024-01-01", "2024-01-01"), ("k", "a2", "Unknown", 5, 9, "2024-01-02", "2024-01-02"),
            ("k", "a3", "b3", -1, 4, "2024-01-03", "2024-01-03"), ("k", "a4", "", None, None, "2024-01-04", "2024-01-04")]
    policy = Policy(first=("create_time",), last=("update_time",), first_known=("a",), last_known=("b", "n"), highest=("m",))
    assert table(merge.merge_devices_rich(None, rows(ddl, data), ["k"], policy)) == [
        ("k", "a2", "b3", "5", "9", "2024-01-01 00:00:00", "2024-01-04 00:00:00")]


def test_clients_and_flags(rows):
    ddl = ("udid string, app_key string, clnt string, version string, init_version string, sdkver string, "
           "create_time timestamp, update_time timestamp")
    data = [("u", "a", "c1", "1", "1", "s1", "2024-01-01", "2024-01-01"), ("u", "a", "c2", "2", "2", "s2", "2024-01-03", "2024-01-03"),
            ("w", "a", "c1", "1", "1", "s1", "2024-01-01", "2024-01-01"), ("w", "a", "c1", "1", "1", "s1", "2024-01-02", "2024-01-02"),
            ("x", "a", "c1", "1", "1", "s1", "2024-01-09", "2024-01-09")]
    merged = merge.client_flags(merge.merge_clients(None, rows(ddl, data)), "2024-01-10")
    assert table(merged, "udid", "clnt", "version", "init_version", "sdkver", "is_upgrade", "is_silent") == [
        ("u", "c1", "2", "1", "s2", "1", "0"), ("w", "c1", "1", "1", "s1", "0", "1"), ("x", "c1", "1", "1", "s1", "0", "0")]


def test_app_version_date_is_that_of_the_last_change(rows):
    ddl = "uuid string, username string, customer_id string, app_version string, os_type int, visit_time timestamp"
    log = rows(ddl, [("u", "n", "c", v, 1, f"2024-01-0{d} 08:00:00") for d, v in ((1, "1"), (2, "2"), (3, "2"), (4, "1"), (5, "1"))])
    assert table(merge.merge_app_versions(None, log), "app_version", "init_app_version", "activate_date", "update_date") == [
        ("1", "1", "2024-01-01", "2024-01-04")]
    stored = merge.merge_app_versions(None, log.where("visit_time < '2024-01-03'"))
    again = merge.merge_app_versions(stored, log.where("visit_time >= '2024-01-03'"))
    assert table(again, "app_version", "update_date", "activate_date") == [("1", "2024-01-04", "2024-01-01")]


@pytest.mark.parametrize("seed", range(4))
def test_app_versions_match_a_plain_fold(rows, seed):
    r = random.Random(seed)
    ddl = "uuid string, username string, customer_id string, app_version string, os_type int, visit_time timestamp"
    data = [(f"u{r.choice([0, 0, 1, 2])}", "n", "c", str(r.randrange(3)), 1,
             f"2024-01-{r.randrange(1, 6):02d} {i // 60:02d}:{i % 60:02d}:00") for i in range(40)]
    want = {}
    for u, _, _, version, _, t in sorted(data, key=lambda x: x[5]):
        if u not in want or want[u][0] != version:
            want[u] = (version, t[:10])
    got = table(merge.merge_app_versions(None, rows(ddl, data)), "uuid", "app_version", "update_date")
    assert got == sorted((u, v, d) for u, (v, d) in want.items())


def test_known_ids_with_shared_and_missing_ids(rows):
    df = rows("uuid string, android_id string", [("a", "x"), ("b", "x"), ("c", None), ("d", ""), ("e", "y")])
    got = merge.flag_known_ids(df, rows("android_id string", [("x",), ("x",), ("",), (None,)]), rows("uuid string", [("c",), ("c",)]))
    assert table(got, "uuid", "is_exists", "is_registered") == [("a", "1", "0"), ("b", "1", "0"), ("c", "0", "1"), ("d", "0", "0"), ("e", "0", "0")]


@pytest.mark.parametrize("seed", range(3))
def test_bucketed_lag_equals_a_plain_lag(rows, seed):
    r = random.Random(seed)
    data = [(f"k{r.choice([0, 0, 0, 1, 2])}", r.randrange(40), i, r.choice([None, i * 10])) for i in range(200)]
    df = rows("k string, t int, i int, v int", data).withColumn("bucket", F.floor(F.col("t") / 7))
    got = {(x.k, x.i): x.p for x in bucketed_lag(df, ["k"], ["t", "i"], "v", "bucket", "p").collect()}
    want, last = {}, {}
    for k, t, i, v in sorted(data, key=lambda x: (x[0], x[1], x[2])):
        want[(k, i)] = last.get(k)
        last[k] = v
    assert got == want


def test_top_per_key_beyond_the_built_in_limit(spark):
    df = spark.range(6000).selectExpr("id", "id % 2 AS g", "(id * 7919) % 6007 AS v")
    got = top_per_key(df, ["g"], [F.desc("v"), F.asc("id")], 1200, "r")
    rows = [x.asDict() for x in df.collect()]
    want = [(x["g"], i + 1, x["id"]) for g in (0, 1) for i, x in
            enumerate(sorted((x for x in rows if x["g"] == g), key=lambda x: (-x["v"], x["id"]))[:1200])]
    assert sorted((x.g, x.r, x.id) for x in got.collect()) == sorted(want)


def test_distinct_users_ignore_null_users(rows):
    df = rows("k string, u string, e string", [("a", "1", "x"), ("a", "1", "y"), ("a", "2", "x"), ("a", None, "x"), ("b", "1", None)])
    got = distinct_users(df, ["k"], "u", {"n": F.lit(True), "y": F.col("e") == "y"})
    assert table(got) == [("a", "2", "1"), ("b", "1", "0")]


def test_rows_without_a_key_are_no_client_and_no_device(rows):
    log = rows("udid string, app_key string, clnt string, version string, init_version string, create_time timestamp, update_time timestamp, network string, imsi string",
               [(u, a, "c", "1", "1", "2024-01-01", "2024-01-02", "4G", "1") for u, a in ((None, "a"), ("", "a"), ("u1", "a"), ("u1", ""), ("u1", None), ("u1", "b"))])
    clients = merge.merge_clients(None, log.drop("network", "imsi"))
    assert table(clients, "udid", "app_key") == [("u1", "a"), ("u1", "b")]
    assert table(merge.merge_clients(clients, log.drop("network", "imsi")), "udid", "app_key") == [("u1", "a"), ("u1", "b")]
    assert table(merge.merge_devices(None, log), "udid") == [("u1",)]
