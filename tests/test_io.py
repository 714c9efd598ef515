"""Sources, sinks, snapshots and streams on files."""

import os

import pytest
from pyspark.sql import functions as F

from tallyline.operators import merge
from tallyline.sinks import tables as sinks
from tallyline.sources import logs, streams
from tallyline.sources.tables import range_predicates, read_partition
from tallyline.streaming import channel_counts, new_users
from tests.conftest import table

LOG = "aid string, channel_code string, area string, ip string, create_time timestamp"


def put(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines))


def test_json_logs_of_a_date_range(spark, tmp_path):
    put(str(tmp_path / "2024-01-01/ad/a.json"), '{"aid":"1","create_time":"2024-01-01 10:00:00"}', "not json")
    put(str(tmp_path / "2024-01-03/ad/a.json"), '{aid:"3",area:"x"}')
    put(str(tmp_path / "2024-01-04/ad/a.json"), '{"aid":"4"}')
    df = logs.read_json_logs(spark, str(tmp_path), "ad", "2024-01-01", "2024-01-03", "visit_ad", unquoted=True, missing="skip")
    assert table(df.where("aid IS NOT NULL"), "aid", "area", "ip") == [("1", "", ""), ("3", "x", "")]
    with pytest.raises(FileNotFoundError):
        logs.read_json_logs(spark, str(tmp_path), "ad", "2025-01-01", "2025-01-02", "visit_ad")


def test_day_logs_take_late_lines(spark, tmp_path):
    line = '{{"aid":"{}","create_time":"{}"}}'.format
    put(str(tmp_path / "2024-01-01/ad/a.json"), line("before", "2023-12-31 23:59:59"), line("day", "2024-01-01 00:00:00"))
    put(str(tmp_path / "2024-01-02/ad/a.json"), line("late", "2024-01-01 23:59:59"), line("next", "2024-01-02 00:00:00"))
    args = (spark, str(tmp_path), "ad", "2024-01-01", "visit_ad", "create_time")
    assert table(logs.read_day_logs(*args), "aid") == [("day",), ("late",)]
    assert table(logs.read_day_logs(*args, strict=False), "aid") == [("day",)]


def test_range_predicates():
    assert range_predicates("t", "2024-01-01", "2024-01-06", 2) == [
        "t >= '2024-01-01 00:00:00' AND t < '2024-01-03 00:00:00'", "t >= '2024-01-03 00:00:00' AND t < '2024-01-05 00:00:00'",
        "t >= '2024-01-05 00:00:00' AND t < '2024-01-06 00:00:00'"]
    assert len(range_predicates("t", "2024-01-01", "2024-01-02", 8, "hours")) == 3


def test_api_log_routes_and_letter_case(rows):
    df = rows("value string", [('{"METHOD":"app.api.information.list","UUID":"a","CategoryID":"7"}',), ('x {"method":"app.api.information.browse","udid":"b","informationId":"9"}',),
                               ('{"method":"other"}',), ("broken",), (None,)])
    routes = logs.parse_api_log(df.select(logs.strip_json_prefix("value").alias("value")))
    assert table(routes["list"], "udid", "categoryId") == [("a", "7")]
    assert table(routes["browse"], "udid", "informationId") == [("b", "9")]
    assert routes["index"].count() == 0


def test_replace_range_is_repeatable_and_empties_days(rows, spark, tmp_path):
    path = str(tmp_path / "t")
    df = rows("k int, d int", [(1, 20240101), (2, 20240102), (3, 20240103)])
    sinks.replace_range(df, path, "d", 20240101, 20240103)
    new = rows("k int, d int", [(9, 20240102), (8, 20240109)])
    for _ in range(2):
        sinks.replace_range(new, path, "d", 20240102, 20240103)
        assert table(spark.read.parquet(path), "k", "d") == [("1", "20240101"), ("9", "20240102")]
    sinks.replace_range(new.where("k < 0"), path, "d", 20240102, 20240102)
    assert table(spark.read.parquet(path), "k") == [("1",)]


def test_snapshot_versions_redo_and_retention(rows, spark, tmp_path):
    path = str(tmp_path / "s")
    one = rows("k int", [(1,)])
    assert sinks.read_snapshot(spark, path) is None
    for day in ("20240101", "20240102", "20240103", "20240104"):
        sinks.publish_snapshot(one.withColumn("d", F.lit(day)), path, day)
    assert sinks._versions(spark, path) == ["20240102", "20240103", "20240104"]
    sinks.publish_snapshot(sinks.read_snapshot(spark, path).withColumn("d", F.lit("again")), path, "20240104")
    assert table(sinks.read_snapshot(spark, path), "d") == [("again",)]
    assert table(sinks.restore_snapshot(spark, path, "20240104"), "d") == [("20240103",)]
    assert sinks._versions(spark, path) == ["20240102", "20240103"]
    os.makedirs(f"{path}/version=20240109")  # a version without a commit does not count
    assert table(sinks.read_snapshot(spark, path), "d") == [("20240103",)]


def test_partition_retention(rows, spark, tmp_path):
    path = str(tmp_path / "p")
    for day in (20240129, 20240130, 20240131, 20240201):
        sinks.replace_partition(rows("k int, stat_date int", [(day % 100, day)]), path, day, keep_days=2)
    assert table(read_partition(spark, path, 0, 99999999), "k", "stat_date") == [("1", "20240201"), ("31", "20240131")]
    sinks.replace_partition(rows("k int", [(5,)]), path, 20240201)
    assert table(read_partition(spark, path, 20240201), "k") == [("5",)]


def test_key_merges(rows):
    cur = rows("k int, a string, b string", [(1, "a1", "b1"), (2, "a2", "b2")])
    new = rows("k int, a string, b string", [(2, None, "n2"), (3, "n3", "m3"), (3, "z3", "m3")])
    assert table(sinks.upsert(cur, new, ["k"], ["a"])) == [("1", "a1", "b1"), ("2", "", "b2"), ("3", "z3", "m3")]
    assert table(sinks.upsert(cur, new.drop("b"), ["k"], ["a"], [F.asc("a")])) == [("1", "a1", "b1"), ("2", "", "b2"), ("3", "n3", "")]
    assert table(sinks.insert_ignore(cur, new, ["k"], [F.asc("a")])) == [("1", "a1", "b1"), ("2", "a2", "b2"), ("3", "n3", "m3")]
    assert table(sinks.replace_into(cur, new, ["k"])) == [("1", "a1", "b1"), ("2", "", "n2"), ("3", "z3", "m3")]


def test_channel_lists(rows):
    df = rows("chacode string", [("a",), ("b",), ("c",)])
    assert table(df.where(sinks.channel_filter(["a"], ["a", "b"]))) == [("a",)]
    assert table(df.where(sinks.channel_filter((), ["a"]))) == [("b",), ("c",)]
    assert df.where(sinks.channel_filter()).count() == 3


def test_diff_counts_copies_and_nulls(rows):
    a = rows("k int, v string", [(1, None), (1, None), (2, "x"), (3, "y")])
    b = rows("k int, v string", [(1, None), (2, "z"), (3, "y")])
    assert table(sinks.diff_tables(a, b, ["k", "v"])) == [("left", "1", "", "1"), ("left", "2", "x", "1"), ("right", "2", "z", "1")]
    assert sinks.diff_tables(a, a, ["k", "v"]).count() == 0


def test_split_appends_to_the_event_date(rows, spark, tmp_path):
    path = str(tmp_path / "log")
    for part in ([("a", "2024-01-01 23:59:59.123456")], [("b", "2024-01-01 00:00:00"), ("c", "2024-01-02 00:00:00")]):
        sinks.split_by_event_date(rows("k string, createtime timestamp", part), path)
    back = spark.read.schema("k string, createtime timestamp, event_date string").json(path)
    assert table(back, "k", "event_date") == [("a", "2024-01-01"), ("b", "2024-01-01"), ("c", "2024-01-02")]
    assert table(back.where("k = 'a'"), "createtime") == [("2024-01-01 23:59:59.123456",)]


def test_rollup_tables(rows, spark, tmp_path):
    sinks.write_rollups(rows("rule string, n int", [("l_1", 1), ("l_2", 2)]), str(tmp_path / "r"))
    assert sorted(n for n in os.listdir(tmp_path / "r") if "=" in n) == ["rule=l_1", "rule=l_2"]


def test_log_shapes_feed_the_merges(spark, tmp_path):
    put(str(tmp_path / "f.json"), '{udid:"u",apppkg:"a",clnt:"c",appversion:"1",sdkver:"s",path:"3",network:"Wifi",isroot:"1",gp:"0",rom:"12",cityid:"x",'
                                  'createtime:"2024-01-01 10:00:00",updatetime:"2024-01-01 10:00:00"}')
    raw = spark.read.schema(logs.log_schema("visit_fad")).option("allowUnquotedFieldNames", True).json(str(tmp_path))
    assert table(merge.merge_devices(None, merge.fad_device_log(raw)), "udid", "network", "is_root", "has_gplay", "rom", "city_id") == [("u", "WIFI", "1", "2", "12", "")]
    assert table(merge.merge_clients(None, merge.fad_client_log(raw)), "udid", "app_path", "create_date") == [("u", "3", "20240101")]
    sdk = spark.createDataFrame([], logs.log_schema("visit_sdk"))
    assert merge.merge_devices_sdk(None, merge.sdk_device_log(sdk)).count() == 0
    for name in ("visit_rich", "using_log", "event", "ad_request", "ad_reply", "upgrade_log", "adv_visitlog", "adv_apilog"):
        assert logs.log_schema(name).fields


MESSAGE = '{{"aid":"{}","channel_code":"{}","area":"{}","ip":"i","create_time":"{}"}}'.format


def test_stream_of_new_users_survives_replay_and_compaction(spark, tmp_path):
    root = str(tmp_path)
    put(f"{root}/in/1.txt", MESSAGE("u", "c1", "a1", "2024-01-02 00:00:00"), MESSAGE("w", "c", "a", "2024-01-01 00:00:00"), "broken", MESSAGE("", "c", "a", "bad time"))
    run = lambda ck: new_users.stream_new_users(streams.read_file_messages(spark, f"{root}/in"), f"{root}/out", f"{root}/{ck}").awaitTermination()
    run("ck1")
    first = table(new_users.read_new_users(spark, f"{root}/out"))
    run("ck2")  # a lost checkpoint replays everything
    assert table(new_users.read_new_users(spark, f"{root}/out")) == first
    assert table(new_users.compact_new_users(spark, f"{root}/out", "20240103")) == first
    put(f"{root}/in/2.txt", MESSAGE("u", "c2", "a2", "2024-01-03 00:00:00"), MESSAGE("u", "c0", "a0", "2024-01-01 00:00:00"))
    run("ck1")
    assert table(new_users.read_new_users(spark, f"{root}/out"), "aid", "channel_code", "init_area", "area") == [("u", "c0", "a0", "a2"), ("w", "c", "a", "a")]
    new_users.compact_new_users(spark, f"{root}/out", "20240103")  # again on the same day
    assert table(new_users.read_new_users(spark, f"{root}/out"), "aid", "area") == [("u", "a2"), ("w", "a")]


def test_append_mode_drops_rows_behind_the_watermark(spark, tmp_path):
    root, name = str(tmp_path), "late_rows"
    put(f"{root}/in/1.txt", MESSAGE("u", "c", "a", "2024-01-01 10:07:00"))
    counts = channel_counts.stream_channel_counts(streams.read_file_messages(spark, f"{root}/in", files_per_batch=1))
    writer = lambda: counts.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{root}/ck").option(
        "path", f"{root}/{name}").trigger(availableNow=True).start().awaitTermination()
    writer()
    put(f"{root}/in/2.txt", MESSAGE("u", "c", "a", "2024-01-01 11:30:00"))
    writer()
    put(f"{root}/in/3.txt", MESSAGE("u", "c", "a", "2024-01-01 10:08:00"), MESSAGE("u", "c", "a", "2024-01-01 13:00:00"))
    writer()
    got = table(spark.read.parquet(f"{root}/{name}").select(F.date_format("window.start", "HH:mm"), "channel_code", "count"))
    assert got == [("10:00", "c", "1"), ("10:05", "c", "1"), ("11:25", "c", "1"), ("11:30", "c", "1")]


def test_complete_mode_counts_everything(spark, tmp_path):
    root = str(tmp_path)
    put(f"{root}/in/1.txt", MESSAGE("u", "c", "a", "2024-01-01 10:07:00"), MESSAGE("w", "d", "a", "2024-01-01 10:02:00"))
    q = channel_counts.start_channel_counts(streams.read_file_messages(spark, f"{root}/in"), f"{root}/ck", sink="memory", name="complete_counts")
    q.awaitTermination()
    got = table(spark.table("complete_counts").select(F.date_format("window.start", "HH:mm"), "channel_code", "count"))
    assert got == [("09:55", "d", "1"), ("10:00", "c", "1"), ("10:00", "d", "1"), ("10:05", "c", "1")]


def test_kafka_source_needs_its_connector(spark):
    from pyspark.errors import AnalysisException
    with pytest.raises(AnalysisException):
        streams.read_kafka_json(spark, "localhost:1", "t")


def test_missing_log_days(spark, tmp_path):
    from tallyline.sources import logs
    for day in ("2024-01-01", "2024-01-03"):
        spark.createDataFrame([(day,)], "a string").write.json(f"{tmp_path}/{day}/p")
    read = lambda **o: logs.read_json_logs(spark, str(tmp_path), "p", "2024-01-01", "2024-01-03", "a string", **o)
    with pytest.raises(FileNotFoundError, match="2024-01-02"):
        read()
    assert sorted(r.a for r in read(missing="skip").collect()) == ["2024-01-01", "2024-01-03"]
    with pytest.raises(FileNotFoundError):
        logs.read_json_logs(spark, str(tmp_path), "p", "2025-01-01", "2025-01-02", "a string", missing="skip")
    with pytest.raises(ValueError):
        read(missing="ignore")


def test_missing_late_half_of_a_day(spark, tmp_path):
    from tallyline.sources import logs
    spark.createDataFrame([("2024-01-01 10:00:00",)], "createtime string").write.json(f"{tmp_path}/2024-01-01/p")
    day = lambda **o: logs.read_day_logs(spark, str(tmp_path), "p", "2024-01-01", "createtime timestamp", **o)
    with pytest.raises(FileNotFoundError):
        day()
    assert day(missing="skip").count() == day(strict=False).count() == 1


def test_only_one_machine_may_do_without_a_shared_folder():
    from types import SimpleNamespace as Fake

    from tallyline.session import checkpoint_dir

    def session(master, shared=None):
        conf = Fake(get=lambda key, default=None: shared or default)
        return Fake(sparkContext=Fake(master=master, getConf=lambda: conf), conf=Fake(get=lambda key, default=None: default))
    assert checkpoint_dir(session("local[4]")) and checkpoint_dir(session("yarn", "hdfs://x/y")) == "hdfs://x/y"
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://https://host"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_dir(session(master))
