"""Second runs, late files, bad lines, failed writes and restarts."""

import glob

import pytest
from pyspark.sql import functions as F

from tallyline.session import scratch
from tallyline.sinks import files, ledger, tables
from tallyline.sources import checked
from tallyline.sources.streams import read_file_messages
from tallyline.streaming import channel_counts, new_users

SCHEMA = "k string, createtime timestamp"


def deliver(spark, path, name, rows):
    files.write_text(spark, f"{path}/{name}", "".join(f'{{"k":"{k}","createtime":"{t}"}}\n' for k, t in rows))


def rehomed(spark, path, **days):
    return sorted((r.k, r.event_date) for r in ledger.read_rehomed(spark, path, SCHEMA, **days).collect())


def test_files_are_taken_once(spark):
    root = scratch(spark, "files")
    assert rehomed(spark, f"{root}/out") == []
    deliver(spark, f"{root}/in/2024-01-01", "a.json", [("a", "2024-01-01 23:00:00"), ("b", "2024-01-02 00:00:00"), ("b", "2024-01-02 00:00:00")])
    assert [ledger.rehome_files(spark, f"{root}/in", f"{root}/out", SCHEMA) for _ in range(2)] == [1, 0]
    deliver(spark, f"{root}/in/2024-01-02", "a.json", [("late", "2024-01-01 05:00:00"), ("none", "?")])
    assert ledger.rehome_files(spark, f"{root}/in", f"{root}/out", SCHEMA) == 1
    want = [("a", "2024-01-01"), ("b", "2024-01-02"), ("b", "2024-01-02"), ("late", "2024-01-01"), ("none", None)]
    assert rehomed(spark, f"{root}/out") == want
    assert rehomed(spark, f"{root}/out", first="2024-01-01", last="2024-01-01") == [want[0], want[3]]
    deliver(spark, f"{root}/in/2024-01-02", "a.json", [("changed", "2024-01-01 05:00:00")])
    with pytest.raises(ValueError, match="changed after"):
        ledger.rehome_files(spark, f"{root}/in", f"{root}/out", SCHEMA)


def test_a_run_that_fails_before_its_record_counts_nothing(spark, monkeypatch):
    root = scratch(spark, "halfway")
    deliver(spark, f"{root}/in", "a.json", [("a", "2024-01-01 23:00:00")])

    def stop(*_):
        raise RuntimeError("stopped")
    with monkeypatch.context() as m:
        m.setattr(spark, "createDataFrame", stop, raising=False)
        m.setattr(ledger, "read_ledger", lambda s, p: s.read.schema(ledger.LEDGER).parquet(f"{root}/empty"))
        spark.range(0).selectExpr("cast(id as string) file", "id length").write.parquet(f"{root}/empty")
        with pytest.raises(RuntimeError):
            ledger.rehome_files(spark, f"{root}/in", f"{root}/out", SCHEMA)
    assert files.children(spark, f"{root}/out/rows") and rehomed(spark, f"{root}/out") == []
    deliver(spark, f"{root}/in", "b.json", [("b", "2024-01-03 23:00:00")])
    assert ledger.rehome_files(spark, f"{root}/in", f"{root}/out", SCHEMA) == 2
    assert rehomed(spark, f"{root}/out") == [("a", "2024-01-01"), ("b", "2024-01-03")]


def test_good_bad_and_counted_lines(spark):
    root = scratch(spark, "lines")
    files.write_text(spark, f"{root}/in/a.json", '{"k":"x","n":1}\n{"k":"y","n":"two"}\n{"k":"z"\n\n{"k":"","n":3}\n[1]\n{"n":4,"more":1}\n')
    files.write_text(spark, f"{root}/in/b.json", '{"k":"w","n":5}\nnull\n')
    found = checked.read_checked(spark, f"{root}/in", "k string, n int", f"{root}/out", required=["k"])
    assert sorted(tuple(r) for r in found.good.collect()) == [("w", 5), ("x", 1)]
    bad = sorted((r.file[-6:], r.line, r.reason) for r in found.bad.collect())
    assert bad == [("a.json", "[1]", "malformed"), ("a.json", '{"k":"","n":3}', "no k"), ("a.json", '{"k":"y","n":"two"}', "malformed"),
                   ("a.json", '{"k":"z"', "malformed"), ("a.json", '{"n":4,"more":1}', "no k"), ("b.json", "null", "malformed")]
    assert found.totals == {"lines": 9, "good": 2, "bad": 6, "blank": 1}
    assert sorted((r.lines, r.good, r.bad, r.blank) for r in found.counts.collect()) == [(2, 1, 1, 0), (7, 1, 5, 1)]
    files.write_text(spark, f"{root}/none/a.json", "")
    nothing = checked.read_checked(spark, f"{root}/none", "k string", f"{root}/out2")
    assert nothing.good.collect() == [] and nothing.bad.collect() == [] and nothing.totals["lines"] == 0
    with pytest.raises(ValueError):
        checked.read_checked(spark, f"{root}/in", "k string", f"{root}/out3", "xml")


def test_a_failed_write_leaves_the_old_day(spark):
    path = scratch(spark, "day")
    df = spark.createDataFrame([(20240101, 1), (20240102, 2)], "stat_date int, n int")
    df.write.partitionBy("stat_date").parquet(path)
    with pytest.raises(Exception, match="stopped"):
        tables.replace_partition(df.withColumn("n", F.raise_error(F.lit("stopped")).cast("int")), path, 20240101)
    read = lambda: sorted((r.stat_date, r.n) for r in spark.read.parquet(path).collect())
    assert read() == [(20240101, 1), (20240102, 2)]
    tables.replace_partition(df.where("n = 2"), path, 20240101)
    assert read() == [(20240101, 2), (20240102, 2)]
    tables.replace_partition(df.limit(0), path, 20240101)
    assert read() == [(20240102, 2)]


def visits(spark, n):
    return spark.range(n).selectExpr(
        "concat('u', id % 17) aid", "concat('c', id % 3) channel_code", "concat('a', id) area", "concat('i', id) ip",
        "timestamp_seconds(1704067200 + id * 61) create_time")


def rows_of(df):
    return sorted(tuple(map(str, r)) for r in df.select(sorted(df.columns)).collect())


def test_fifty_batches_leave_few_runs(spark, monkeypatch):
    """Levels of four: at most three runs a level. A crash between merging and deleting, and a batch
    that is written again, change nothing."""
    path, log = scratch(spark, "levels"), visits(spark, 300)
    merged = new_users.merge_new_users(None, log)
    for batch in range(52):
        part = log.where((F.col("area").substr(2, 9).cast("int") % 52) == batch)
        new_users.merge_new_users(None, part).coalesce(1).write.parquet(f"{path}/delta/batch=q-{batch:012d}")
    assert new_users.merge_runs(spark, path, 4) <= 3 * 3
    assert rows_of(new_users.read_new_users(spark, path)) == rows_of(merged)
    # the inputs of a finished merge are still there, and a batch comes again
    for batch in range(52, 56):
        part = log.where((F.col("area").substr(2, 9).cast("int") % 52) == batch - 52)
        new_users.merge_new_users(None, part).coalesce(1).write.parquet(f"{path}/delta/batch=q-{batch:012d}")
    before = len(new_users._level(spark, path, 1))
    monkeypatch.setattr(files, "delete", lambda *_: (_ for _ in ()).throw(RuntimeError("crashed")))
    with pytest.raises(RuntimeError):
        new_users.merge_runs(spark, path, 4)
    monkeypatch.undo()
    assert len(new_users._level(spark, path, 0)) == 4 and len(new_users._level(spark, path, 1)) == before + 1
    assert rows_of(new_users.read_new_users(spark, path)) == rows_of(merged)
    new_users.merge_runs(spark, path, 4)
    assert new_users._level(spark, path, 0) == []
    assert rows_of(new_users.read_new_users(spark, path)) == rows_of(merged)


def test_counts_go_on_after_a_restart(spark):
    """The state comes from the checkpoint's change log, not from the rows of the first run."""
    root, log = scratch(spark, "restart"), visits(spark, 120)
    message = F.to_json(F.struct("aid", "channel_code", F.date_format("create_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("create_time")))
    run = lambda: channel_counts.start_stored_counts(
        read_file_messages(spark, f"{root}/in"), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    for low, high in ((0, 55), (55, 56), (56, 120)):
        log.where(F.col("area").substr(2, 9).cast("int").between(low, high - 1)).select(message.alias("value")).write.mode("append").text(f"{root}/in")
        run()
    run()  # nothing new
    got = rows_of(channel_counts.read_stored_counts(spark, f"{root}/out"))
    whole = channel_counts.stream_channel_counts(log)
    assert got == rows_of(whole.select("channel_code", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "count"))
    assert glob.glob(f"{root.removeprefix('file:')}/checkpoint/state/**/*.changelog", recursive=True)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) != channel_counts.STATE_CONF["spark.sql.streaming.stateStore.providerClass"]
