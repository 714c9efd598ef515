"""Activity, sessions, retention, funnel and score on hand rows."""

import pytest
from pyspark.sql import functions as F

from tallyline.operators import activity, devices, funnel, retention, rollup, scoring
from tests.conftest import table

USING = "deviceid string, appkey string, session_id string, start_millis timestamp, duration long, version string"
CLIENTS = "uuid string, app_key string, customer_id string, init_version string, create_time timestamp"


def test_sessions(rows):
    log = rows(USING, [("u", "a", "s1", "2024-01-01 10:00", 1400, "1"), ("u", "a", "s1", "2024-01-01 09:59", 1200, "0"),
                       ("u", "a", "s2", "2024-01-03 10:00", 0, "1"), ("u", "a", "s3", "2024-01-03 11:00", -2600, "1"),
                       ("u", "b", "s4", "2024-01-04", 5000, "1"), ("", "a", "x", "2024-01-01", 1, "1"), ("u", "a", None, "2024-01-01", 1, "1"),
                       ("nobody", "a", "s9", "2024-01-01", 1000, "1")])
    clients = rows(CLIENTS, [("u", "a", "c", "1", "2024-01-01"), ("u", "b", "d", "1", "2024-01-01")])
    got = table(activity.sessions(log, clients), "session_id", "create_time", "version", "duration", "prev_time", "date_diff", "customer_id")
    assert got == [("s1", "2024-01-01 09:59:00", "0", "3", "", "-1", "c"), ("s2", "2024-01-03 10:00:00", "1", "1", "2024-01-01 09:59:00", "2", "c"),
                   ("s3", "2024-01-03 11:00:00", "1", "3", "2024-01-03 10:00:00", "0", "c"), ("s4", "2024-01-04 00:00:00", "1", "5", "", "-1", "d")]


def test_continued_session_keeps_its_start(rows):
    clients = rows(CLIENTS, [("u", "a", "c", "1", "2024-01-01"), ("w", "a", "c", "1", "2024-01-01")])
    old = rows(USING, [("u", "a", "s0", "2024-01-01 08:00", 9000, "1"), ("u", "a", "s1", "2024-01-01 23:50", 4000, "1"),
                       ("w", "a", "t1", "2024-01-01 12:00", 1000, "1")])
    new = rows(USING, [("u", "a", "s1", "2024-01-02 00:05", 6000, "2"), ("u", "a", "s2", "2024-01-02 09:00", 1000, "2"),
                       ("w", "a", "t2", "2024-01-03 12:00", 1000, "1")])
    got = activity.sessions_incremental(activity.sessions(old, clients), new, clients)
    assert table(got, "session_id", "create_time", "version", "duration", "prev_time", "date_diff") == [
        ("s1", "2024-01-01 23:50:00", "1", "10", "", "-1"), ("s2", "2024-01-02 09:00:00", "2", "1", "2024-01-01 23:50:00", "1"),
        ("t2", "2024-01-03 12:00:00", "1", "1", "2024-01-01 12:00:00", "2")]


def test_rich_activity(rows):
    ddl = ("uuid string, appkey string, customid string, createtime timestamp, time timestamp, boottime long, version string, extsizeleft long, "
           "romsizeleft long, screenon int, battery int, logtype int, city string, region string, country string, clientip string")
    base = ("u", "a", "c")
    log = rows(ddl, [base + ("2024-01-01 09:00", "2024-01-01 09:01", 1, "1", 5, 6, 200, 50, 1, "unknown", None, "", "i1"),
                     base + ("2024-01-01 21:00", "2024-01-01 20:00", 9000000, "2", 7, 8, 1, 51, 1, "x", "r", "", "i2"),
                     base + ("2024-01-01 09:30", None, None, "3", 1, 1, None, 100, 1, "y", "q", None, "i3"),
                     base + ("2024-01-01 10:00", None, None, "3", 1, 1, None, 0, 2, "z", None, None, "i4"),
                     ("u", "a", "", "2024-01-01", None, 1, "1", 1, 1, 1, 1, 1, "", "", "", "")])
    clients = rows(CLIENTS, [("u", "a", "ch", "0", "2023-12-30 23:00")])
    sess = rows("uuid string, app_key string, session_id string, create_date int, duration long", [("u", "a", "s", 20240101, 7), ("u", "a", "t", 20240101, 3)])
    got = activity.daily_active_rich(activity.rich_log(log), sess, clients)
    assert table(got, "log_type", "active_hours", "time_diff", "boottime", "version", "screen_on", "battery", "city", "region", "country", "client_ip",
                 "visit_times", "start_times", "duration", "date_diff", "create_date") == [
        ("1", "9,21", "-3600", "121", "1", "100", "3", "y", "q", "unknown", "i2", "3", "2", "10", "2", "20231230"),
        ("2", "10", "", "0", "3", "0", "0", "z", "unknown", "unknown", "i4", "1", "1", "0", "2", "20231230")]


def test_hours_are_zero_filled(rows):
    active = rows("customer_id string, version string, active_date int, active_hours string", [("c", "1", 1, "1,11"), ("c", "1", 1, "1,23"), ("c", "1", 1, "1,11")])
    got = {r.active_hour: r.user_count for r in activity.hourly_active(active).collect()}
    assert len(got) == 24 and {h: n for h, n in got.items() if n} == {1: 3, 11: 2, 23: 1}


def test_user_totals_keep_null_for_missing_sides(rows):
    dev = rows("uuid string, customer_id string, apk_version int, create_time timestamp", [("a", "c", 1, "2024-01-02 05:00"), ("b", "c", 2, "2024-01-01"), ("z", "c", 9, "2024-01-03")])
    act = rows("uuid string, customer_id string, first_apk_version int, active_date int", [("a", "c", 1, 20240102), ("b", "c", 1, 20240102), ("q", "d", 5, 20240102), ("a", "c", 1, 20240101)])
    assert table(activity.user_totals(dev, act, "2024-01-02")) == [
        ("c", "1", "20240102", "1", "2", "1", "1"), ("c", "2", "20240102", "", "", "", "1"), ("d", "5", "20240102", "", "1", "", "")]


ALARM = "uuid string, customer_id string, install_date date, visit_date date, day_diff int"


def alarm_rows(rows):
    data = [(f"u{i}", "c", "2024-01-01", "2024-01-01", 0) for i in range(60)] + [("u1", "c", "2024-01-01", "2024-01-02", 1), ("u2", "c", "2024-01-01", "2024-01-09", 8)]
    return rows(ALARM, data + [("x", "", "2024-01-01", "2024-01-01", 0), ("y", "skip", "2024-01-01", "2024-01-01", 0)])


@pytest.mark.parametrize("mode,day,want", [("next_day", "2024-01-03", "1.67"), ("after_7", "2024-01-16", "1.67"), ("cohort", "2024-01-03", "1.67")])
def test_retention_alarm(rows, mode, day, want):
    got = retention.channel_retention_rate(alarm_rows(rows), mode, day, exclude=["skip"])
    assert table(got) == [("c", want, "60")]


def test_retention_alarm_limits(rows):
    df = alarm_rows(rows)
    assert table(retention.channel_retention_rate(df, "after_14", "2024-02-01")) == [("c", "0.0", "60")]
    assert table(retention.channel_retention_rate(df, "next_day", "2024-01-03", limit=1)) == []
    assert table(retention.channel_retention_rate(df, "next_day", "2024-01-03", begin="2024-01-02")) == []


def test_ratio_alarm_ignores_unknown_flags(rows):
    df = rows("customer_id string, install_date date, used_vpn int", [("c", "2024-01-01", 1)] * 31 + [("c", "2024-01-01", 0)] * 9 + [("c", "2024-01-01", -1)] * 20)
    num, den = retention.ratio_parts("vpn")
    assert table(retention.channel_ratio_alarm(df, num, den, *retention.RATIO_LIMITS["vpn"])) == [("c", "77.5", "60")]


def test_drop_alarm_and_summary(rows):
    act = rows("uuid string, customer_id string, activate_date date, visit_date date",
               [(f"u{i}", "c", "2024-01-01", "2024-01-08") for i in range(4)] + [("u1", "c", "2024-01-01", "2024-01-09"), ("n", "c", "2024-01-09", "2024-01-09")])
    assert table(retention.active_drop_alarm(act, "2024-01-10")) == [("c", "75.0")]
    alarms = rows("stat_date date, customer_id string, msg string, show_order int",
                  [("2024-01-10", "c", "second", 2), ("2024-01-10", "c", "first", 1), ("2024-01-09", "c", "old", 1), ("2024-01-10", "off", "x", 1)])
    channels = rows("chacode string, cusname string, alarm int", [("c", "C", 1), ("off", "O", 0)])
    assert table(retention.alarm_summary(alarms, channels, "2024-01-10")) == [("C", "c", "first | second")]
    assert retention.recent_alarms(alarms, "2024-02-10").count() == 3


SEND = "adcode string, udid string, adkey string, adverid long, position long, apppkg string, clnt string, cityid long, createtime timestamp"
REPLY = "adcode string, udid string, createtime timestamp, rtype int"


def test_ad_lifecycle_continues_stored_state(rows):
    send = rows(SEND, [("a", "u", "k1", 1, 1, "p", "c", 5, "2024-01-01 02:00"), ("a", "u", "k2", 1, 1, "p", "c", 5, "2024-01-01 03:00"), ("b", "", "k", 1, 1, "p", "c", 5, "2024-01-01")])
    reply = rows(REPLY, [("a", "u", "2024-01-01 04:00", 1), ("a", "u", "2024-01-01 05:00", 1), ("never", "u", "2024-01-01 05:00", 2), ("a", "u", "2024-01-01 05:00", 9)])
    day1 = funnel.ad_lifecycle(send, reply)
    assert table(day1, "adcode", "udid", "adkey", "send_time", "show_time", "click_time") == [("a", "u", "k1", "2024-01-01 02:00:00", "2024-01-01 04:00:00", "")]
    day2 = funnel.ad_lifecycle(rows(SEND, [("a", "u", "k9", 1, 1, "p", "c", 5, "2024-01-02")]),
                               rows(REPLY, [("a", "u", "2024-01-02 01:00", 1), ("a", "u", "2024-01-02 02:00", 5)]), day1)
    assert table(day2, "adkey", "show_time", "uninstall_time") == [("k1", "2024-01-01 04:00:00", "2024-01-02 02:00:00")]
    wide = funnel.recent_ad_facts(day2, "2024-01-31")
    assert table(wide, "send_date", "send_hour", "uninstall_date", "uninstall_hour", "click_date") == [("20240101", "2", "20240102", "2", "")]
    assert funnel.recent_ad_facts(day2, "2024-02-05").count() == 0


API = ("androidid string, ids string, apishow string, apiclick string, create_time timestamp, apiurl string, clickurl string, custom_id string, "
       "imei string, title string, adtype string")


def test_api_status_moves_forward(rows):
    extra = ("url", "click", "c", "imei", "t", "x")
    day1 = funnel.api_ad_status(rows(API, [("d", "1", "", None, "2024-01-01") + extra, ("d", "2", "2", "", "2024-01-01") + extra, ("d", None, "9", "9", "2024-01-01") + extra,
                                           ("d", "3", "", "3", "2024-01-01") + extra]))
    assert table(day1, "ad_id", "ad_status", "create_date", "show_date", "click_date") == [("1", "1", "20240101", "", ""), ("2", "2", "20240101", "20240101", ""), ("3", "1", "20240101", "", "")]
    day2 = funnel.api_ad_status(rows(API, [("d", "", "1,3", "2", "2024-01-02") + extra]), day1)
    assert table(day2, "ad_id", "ad_status", "show_date", "click_date") == [("1", "2", "20240102", ""), ("2", "3", "20240101", "20240102"), ("3", "2", "20240102", "")]


def test_sent_row_is_never_replaced(rows):
    ddl = ("androidid string, custom_id string, create_time timestamp, city_id int, nettype int, version string, advids string, hisshow string, hisclick string, hisinstall string")
    first = funnel.ad_events(rows(ddl, [("d", "c", "2024-01-01 05:00", 3, 1, None, "a~r", None, None, None), ("d", "c", "2024-01-01 06:00", 0, 2, "v", "a~r", None, None, None)]))["send"]
    assert table(first) == [("a", "d", "r", "20240101", "5", "3", "2", "v", "2")]
    facts = funnel.ad_events(rows(ddl, [("d", "c", "2024-01-02 07:00", 4, 3, "w", "a~other", "r,r", "zzz", "")]), first)
    assert table(facts["send"]) == table(first)
    assert table(facts["show"]) == [("a", "d", "20240101", "20240102", "7", "4", "3", "w", "2")]
    assert facts["click"].count() == 0 and facts["install"].count() == 0


def test_upgrades(rows):
    log = rows("udid string, apppkg string, appversion string, createtime timestamp",
               [("u", "a", "1", "2024-01-01 10:00:00.9"), ("u", "a", "2", "2024-01-05"), ("u", "a", "1", "2024-01-06"), ("u", "b", "9", "2024-01-02"), ("", "a", "1", "2024-01-01"), ("u", "a", "x" * 51, "2024-01-01")])
    seen = funnel.version_first_seen(None, log)
    assert table(seen) == [("u", "a", "1", "2024-01-01 10:00:00"), ("u", "a", "2", "2024-01-05 00:00:00"), ("u", "b", "9", "2024-01-02 00:00:00")]
    pushes = funnel.upgrade_log(rows("udid string, apppkg string, appversion string, upversion string, createtime timestamp",
                                     [("u", "a", "1", "2", "2024-01-03 01:00"), ("u", "a", "1", "2", "2024-01-03 02:00"), ("u", "a", "1", "2", "2024-01-04"), ("u", "a", "2", "3", "2024-01-04")]))
    assert pushes.count() == 3
    assert table(funnel.upgrade_success(pushes, seen)) == [("u", "a", "1", "2", "2024-01-03", "2024-01-05"), ("u", "a", "2", "3", "2024-01-04", "")]


def test_blacklist_boundaries(rows):
    clients = rows("app_key string, clnt string, create_time timestamp", [("a", "c", f"2024-01-{d:02d} 12:00") for d in (1, 6, 7, 8, 10)])
    assert table(devices.blacklist_counts(clients, rows("customid string, blackdate int", [("c", 4)]), "2024-01-10")) == [("a", "c", "3", "1", "2024-01-10")]


def test_activation_without_install_is_kept(rows):
    dev = rows("customer_id string, install_date date, activate_date date, is_activated int, aid_status int, imsi_status int",
               [("c", "2024-01-01", "2024-01-02", 1, 0, 0), ("d", "2024-01-02", None, 0, 1, 0), ("", "2024-01-02", None, 0, 0, 0)])
    sdk = rows("customer_id string, create_date date, is_exists int", [("c", "2024-01-02", 0), ("c", "2024-01-02", 1), ("e", "2024-01-02", 0)])
    assert table(devices.install_activation(dev, sdk, "2024-01-02")) == [
        ("2024-01-02", "c", "0", "0", "1", "2"), ("2024-01-02", "d", "1", "0", "0", "0"), ("2024-01-02", "e", "0", "0", "0", "1")]


def test_duplicate_ids_with_equal_times(rows):
    dev = rows("uuid string, imsi string, create_time timestamp", [("b", "x", "2024-01-01"), ("a", "x", "2024-01-01"), ("c", "x", "2024-01-02"), ("d", "Unknown", "2024-01-01"),
                                                                   ("e", "Unknown", "2024-01-01"), ("f", None, "2024-01-01"), ("g", None, "2024-01-01"), ("h", "", "2024-01-01")])
    got = devices.flag_duplicate_ids(dev, "imsi", "imsi_status")
    assert table(got, "uuid", "imsi_status") == [("a", "0"), ("b", "1"), ("c", "1"), ("d", "0"), ("e", "0"), ("f", "0"), ("g", "0"), ("h", "0")]


def test_rules_missing_from_the_table_do_not_count(rows, spark):
    signals = rows("uuid string, changed_mac int, used_vpn int, uptime long, has_phonenum int, power long, original_status string, changed_status string",
                   [("u", 1, 0, 4 * scoring.DAY_MS, 1, 5, "B", None), ("v", 0, 1, 0, None, None, "C", "G")])
    log = scoring.score_log(signals, "2024-01-01")
    assert table(log, "uuid", "rule_id") == [("u", "1"), ("u", "13"), ("u", "34"), ("u", "4"), ("u", "6"), ("u", "8"), ("v", "2"), ("v", "3"), ("v", "36"), ("v", "5"), ("v", "9")]
    assert table(scoring.score_devices(signals, scoring.rule_table(spark), "2024-01-01")) == [("u", "2024-01-01", "30", "5"), ("v", "2024-01-01", "-35", "4")]


def test_grades_and_boundary_of_users(rows):
    keep = rows("channel_id string, user_count int, keep_pct_1 double, keep_pct_3 double, keep_pct_6 double",
                [("a", 51, 0.4, 0.3, 0.2), ("a50", 50, 0.4, 0.3, 0.2), ("e", 60, 0.04, 0.3, 0.2), ("n", 60, None, None, None)])
    q = ("vpn_pct", "phone_pct", "network_pct", "runtime_pct", "battery_pct", "station_pct")
    quality = rows("channel_id string, " + ", ".join(f"{c} double" for c in q), [(n, 0.01, 0.7, 0.5, 0.5, 0.5, 0.5) for n in ("a", "a50", "n")] + [("e", 0.7, 0.7, 0.5, 0.5, 0.5, 0.5)])
    graded = scoring.grade_channels(keep, quality, "20240101")
    assert table(graded, "channel_id", "channel_rank") == [("a", "A"), ("a50", "D"), ("e", "E"), ("n", "D")]
    bad = [tuple(r) for r in scoring.bad_channels(graded).collect()]
    assert [b[0] for b in bad] == ["e", "a50", "n"] and bad[0][3] == "4.00%" and bad[2][3] == ""


def test_rules_of_a_rollup():
    assert rollup.parse_rules("l_1 a,b\r\nl_2 c\n") == [("l_1", ["a", "b"]), ("l_2", ["c"])]
    assert rollup.combination_rules(["id", "name", "gender"]) == [
        ("l_1", ["id"]), ("l_2", ["name"]), ("l_3", ["gender"]), ("l_4", ["id", "name"]), ("l_5", ["id", "gender"]), ("l_6", ["name", "gender"]), ("l_7", ["id", "name", "gender"])]
    assert rollup.combination_rules(["a"], ["m"]) == [("l_1", ["m"]), ("l_2", ["m", "a"])]


def test_rollup_tells_null_values_from_rolled_columns(rows):
    df = rows("aid string, a string, b string", [("1", None, "x"), ("2", "p", "x"), ("3", None, None)])
    rules = [("r1", ["a"]), ("r2", ["b"]), ("r3", ["a", "b"])]
    rolled = rollup.rollup_new(df, rules)
    assert table(rolled.where("rule = 'r1'"), "a", "fact_count") == [("", "2"), ("p", "1")]
    assert table(rollup.split_rollup(rolled, rules)["r2"]) == [("", "1"), ("x", "2")]
    assert rolled.where("rule = 'r3'").count() == 3


def test_device_fact_bounds_and_default(rows):
    dev = rows("uuid string, customer_id string, install_date int", [("u", "c", 1), ("v", "c", 1)])
    log = rows("uuid string, low_power int, create_time timestamp", [("u", 0, "2024-01-05"), ("u", 100, "2024-01-02"), ("u", 101, "2024-01-06"), ("u", 100, "2024-01-03"), ("u", 7, "2024-01-01")])
    got = devices.device_fact(dev, log, F.count_distinct("low_power"), "n", where=F.col("low_power").between(1, 100))
    assert table(got, "uuid", "n", "stat_date") == [("u", "2", "2024-01-03"), ("v", "0", "")]
    assert table(devices.device_fact(dev, log, F.sum("low_power"), "n", default=None), "uuid", "n") == [("u", "308"), ("v", "")]


def test_rules_that_share_a_set_each_get_their_rows(rows):
    df = rows("aid string, c string, d string", [("1", "x", "p"), ("2", "x", "q"), ("3", "y", "q"), (None, "y", "q")])
    got = table(rollup.rollup_new(df, rollup.parse_rules("l_1 c\nl_2 c\nl_3 c,d\nl_4 d,c\nl_5 d,d")))
    one = [("x", "", "2"), ("y", "", "1")]
    two = [("x", "p", "1"), ("x", "q", "1"), ("y", "q", "1")]
    want = [(r, *v) for r, vs in (("l_1", one), ("l_2", one), ("l_3", two), ("l_4", two), ("l_5", [("", "p", "1"), ("", "q", "2")])) for v in vs]
    assert got == sorted(want)


def test_stacked_device_signals(rows):
    active = rows("uuid string, boottime int, screen_on int, battery int, time_diff double, active_date int",
                  [("a", 5, 1, 90, 0.0, 20240105), ("a", 9, 3, 90, 1900.0, 20240106), ("a", 99, 99, 1, None, 20240106), ("a", 99, 9, 2, 5.0, 20231201),
                   ("b", 1, 1, None, -9000.0, 20240106)])
    at = "2024-01-06"
    stations = rows("uuid string, stationcode long, createtime timestamp", [("a", 7, at), ("a", 7, at), ("a", 0, at), ("c", 9, at), ("a", 8, "2023-01-01")])
    apps = rows("uuid string, app_pkgname string, createtime timestamp", [("a", "x", at), ("a", "y", at), ("", "x", at), ("b", None, at)])
    clients = rows("uuid string, customer_id string, create_date int", [("a", "c1", 1), ("b", "c2", 2), ("c", "c3", 3)])
    got = devices.device_signals(clients, devices.stack_device_signals(active, stations, apps, apps.where("app_pkgname = 'x'"), apps, "2024-01-08", 7))
    columns = ("uuid", "customer_id", "create_date", "runtime", "unlock_cnt", "battery_cnt", "etime_cnt", "station_cnt", "account_cnt", "install_cnt", "appuse_cnt")
    assert table(got, *columns) == [("a", "c1", "1", "9", "3", "1", "1", "1", "2", "1", "2"), ("b", "c2", "2", "1", "1", "0", "1", "0", "0", "0", "0")]
