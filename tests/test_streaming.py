import os

from pyspark.sql import functions as F

from airnet import streaming
from airnet.operators import windows

SF = "/root/testdata/sf0.001"


def _two_files(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    mid = "2024-01-15 00:00:00"
    d = os.path.join(tmp_dir, "in")
    ev.where(F.col("ts") < mid).coalesce(1).write.parquet(os.path.join(d, "a"))
    ev.where(F.col("ts") >= mid).coalesce(1).write.parquet(os.path.join(d, "b"))
    # flatten into one directory: two files, two micro-batches with maxFilesPerTrigger=1
    flat = os.path.join(tmp_dir, "flat")
    os.makedirs(flat)
    for i, sub in enumerate(("a", "b")):
        src = [p for p in os.listdir(os.path.join(d, sub)) if p.endswith(".parquet")][0]
        os.link(os.path.join(d, sub, src), os.path.join(flat, f"part{i}.parquet"))
    return ev, flat


def test_stream_equals_batch_over_two_batches(spark, tmp_dir):
    ev, flat = _two_files(spark, tmp_dir)
    s = streaming.event_stream(spark, flat, "*.parquet", max_files_per_trigger=1)
    got = streaming.stream_window_stats(spark, s.select("ts", "event_type", "value"), "ts", ["event_type"],
                                        ["value"], duration="6 hours", slide="2 hours")
    exp = windows.window_stats(ev.select("ts", "event_type", "value"), "ts", ["event_type"], ["value"],
                               duration="6 hours", slide="2 hours")
    cols = ["window_start", "event_type", "value_max"]
    a = sorted(tuple(r) for r in got.select(*cols, F.round("value_mean", 9)).collect())
    b = sorted(tuple(r) for r in exp.select(*cols, F.round("value_mean", 9)).collect())
    assert a == b and len(a) > 100


def test_upsert_latest_state_keeps_last_version(spark, tmp_dir):
    p = os.path.join(tmp_dir, "ups")
    spark.createDataFrame([("w1", 1.0, 0), ("w2", 5.0, 0)], "k string, v double, batch_id long").write.parquet(p)
    spark.createDataFrame([("w1", 2.0, 1), ("w1", 2.0, 1)], "k string, v double, batch_id long").write.mode("append").parquet(p)
    st = {r["k"]: r["v"] for r in streaming.latest_state(spark, p, ["k"]).collect()}
    assert st == {"w1": 2.0, "w2": 5.0}


def test_round_robin_stream(spark):
    ev = streaming.event_stream(spark, SF, "events.parquet").select("event_id")
    out = streaming.stream_round_robin(spark, ev, "event_id", ["a", "b", "c"])
    got = {r["event_id"]: r["station"] for r in out.collect()}
    assert len(got) == 1000 and all(got[i] == "abc"[i % 3] for i in got)


def _counts(frame):
    return {r["window_start"]: r["rows"] for r in frame.collect()}


def test_open_windows_are_returned_beside_the_emitted_ones(spark, tmp_dir):
    ev, flat = _two_files(spark, tmp_dir)
    want = _counts(ev.groupBy(F.window("ts", "1 day").alias("w")).agg(F.count("*").alias("rows"))
                   .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "rows"))
    s = streaming.event_stream(spark, flat, "*.parquet", max_files_per_trigger=1).select("ts")
    out = streaming.stream_watermarked_counts(spark, s, "ts", duration="1 day", watermark="10 minutes")
    assert _counts(out) == want
    held = _counts(out.where("not final"))
    assert set(held) == {max(want)}                       # the last day alone is open
    assert out.where("final").count() == len(want) - 1


def test_watermarked_counts_go_on_from_a_checkpoint(spark, tmp_dir):
    ev, flat = _two_files(spark, tmp_dir)
    first = os.path.join(tmp_dir, "grow")
    os.makedirs(first)
    os.link(os.path.join(flat, "part0.parquet"), os.path.join(first, "part0.parquet"))
    path, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")

    def run():
        s = streaming.event_stream(spark, first, "*.parquet").select("ts")
        return streaming.stream_watermarked_counts(spark, s, "ts", duration="1 day", watermark="10 minutes", path=path,
                                                   checkpoint=ckpt)
    half = run()
    assert half.agg(F.sum("rows")).first()[0] == ev.where("ts < '2024-01-15'").count()
    os.link(os.path.join(flat, "part1.parquet"), os.path.join(first, "part1.parquet"))
    whole = run()
    assert whole.agg(F.sum("rows")).first()[0] == ev.count()
    assert whole.count() == whole.select("window_start").distinct().count()


def _file_stream(spark, tmp_dir, name, rows):
    d = os.path.join(tmp_dir, name)
    for i, part in enumerate(rows):
        spark.createDataFrame(part, "k string, v long").coalesce(1).write.mode("append").parquet(f"{d}/in{i:03d}")
    flat = os.path.join(tmp_dir, name + "-flat")
    os.makedirs(flat)
    for i in range(len(rows)):
        f = [p for p in os.listdir(f"{d}/in{i:03d}") if p.endswith(".parquet")][0]
        os.link(f"{d}/in{i:03d}/{f}", f"{flat}/{i:03d}.parquet")
        os.utime(f"{flat}/{i:03d}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    return streaming.event_stream(spark, flat, "*.parquet", max_files_per_trigger=1).groupBy("k").agg(F.max("v").alias("v"))


def test_rows_of_a_new_checkpoint_are_newer(spark, tmp_dir):
    out = os.path.join(tmp_dir, "sink")
    runs = [[[("a", 9)], [("b", 8)], [("c", 7)]], [[("a", 1)]]]
    for i, rows in enumerate(runs):
        streaming.run_until_done(streaming.upsert_sink(_file_stream(spark, tmp_dir, f"s{i}", rows), out, os.path.join(tmp_dir, f"c{i}")))
    assert {r["k"]: r["v"] for r in streaming.latest_state(spark, out, ["k"]).collect()} == {"a": 1, "b": 8, "c": 7}


def test_compaction_bounds_the_sink(spark, tmp_dir):
    out = os.path.join(tmp_dir, "sink")
    rows = [[(f"k{i % 4}", i)] for i in range(13)]
    q = streaming.upsert_sink(_file_stream(spark, tmp_dir, "s", rows), out, os.path.join(tmp_dir, "c"), keys=["k"], compact_every=3)
    streaming.run_until_done(q)
    want = {"k0": 12, "k1": 9, "k2": 10, "k3": 11}
    assert {r["k"]: r["v"] for r in streaming.latest_state(spark, out, ["k"]).collect()} == want
    assert len(os.listdir(out)) <= 4 and len(streaming.live_folders(spark, out)) <= 3
    # a base that was written but not renamed, and covered folders that were not deleted, change nothing
    os.makedirs(os.path.join(out, "_base-broken"))
    before = streaming.live_folders(spark, out)
    spark.createDataFrame([("k0", -1, 0, 0)], "k string, v long, __run long, __batch long").write.parquet(os.path.join(out, "b-0-5"))
    assert streaming.live_folders(spark, out) == before
    streaming.compact_sink(spark, out, ["k"])
    streaming.compact_sink(spark, out, ["k"])
    assert [f for f in os.listdir(out) if not f.startswith("_")] == ["base-1-12"]
    assert {r["k"]: r["v"] for r in streaming.latest_state(spark, out, ["k"]).collect()} == want


def test_stream_without_data_gives_empty_state(spark, tmp_dir):
    empty_dir = os.path.join(tmp_dir, "empty")
    spark.read.parquet(f"{SF}/events.parquet").limit(0).write.parquet(empty_dir)
    s = streaming.event_stream(spark, empty_dir, "*.parquet")
    out = streaming.stream_window_stats(spark, s.select("ts", "event_type", "value"), "ts", ["event_type"],
                                        ["value"], duration="6 hours", slide="2 hours")
    assert out.count() == 0 and "value_mean" in out.columns


def test_late_row_updates_emitted_window_and_single_row_window(spark, tmp_dir):
    import datetime as dt
    d = os.path.join(tmp_dir, "late")
    os.makedirs(d)
    t0 = dt.datetime(2024, 1, 1, 0, 0, 5)
    first = [(t0, "S1", 10.0, 5.0), (t0 + dt.timedelta(seconds=3), "S1", 30.0, 5.0),
             (t0 + dt.timedelta(minutes=5), "S2", 7.0, 1.0)]                 # S2: one row -> sd 0
    late = [(t0 + dt.timedelta(seconds=1), "S1", 110.0, 5.0),                 # late row for S1's window
            (t0 + dt.timedelta(minutes=10), "S1", 1.0, 1.0)]
    schema = "datetime timestamp_ntz, station string, pm10 double, pm25 double"
    for i, rows in enumerate((first, late)):
        tmp = os.path.join(tmp_dir, f"part{i}")
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(tmp)
        f = [p for p in os.listdir(tmp) if p.endswith(".parquet")][0]
        os.link(os.path.join(tmp, f), os.path.join(d, f"f{i}.parquet"))
    s = streaming.event_stream(spark, d, "*.parquet", max_files_per_trigger=1)
    out = streaming.stream_window_stats(spark, s, "datetime", ["station"], ["pm10", "pm25"],
                                        duration="30 seconds", slide="10 seconds")
    rows = {(str(r["window_start"]), r["station"]): r for r in out.collect()}
    w = rows[("2024-01-01 00:00:00", "S1")]
    assert w["pm10_max"] == 110.0 and abs(w["pm10_mean"] - 50.0) < 1e-9   # late row included
    single = [r for (ws, st), r in rows.items() if st == "S2"]
    assert single and all(r["pm10_std"] == 0.0 and r["pm10_zscore"] == 0.0 for r in single)
    alerts = windows.window_anomalies(out, ["pm10", "pm25"], 1.0)
    assert ("2024-01-01 00:00:00", "S1") in {(str(r["window_start"]), r["station"]) for r in alerts.collect()}
