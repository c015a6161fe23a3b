import math
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from airnet.operators import anomalies, profile, spatial


def _series(spark, n_hot=3000, n_cold=40, seed=7):
    rnd = random.Random(seed)
    rows = []
    eid = 0
    for key, n in (("hot", n_hot), ("c1", n_cold), ("c2", 1), (None, 30)):
        t = 1_700_000_000
        for _ in range(n):
            t += rnd.choice([1, 60, 3600, 7200])
            v = 5.0 if rnd.random() < 0.2 else round(rnd.expovariate(0.1), 2)
            rows.append((eid, key, t, v))
            eid += 1
    df = spark.createDataFrame(rows, "event_id long, k string, t long, v double")
    return df.withColumn("ts", F.timestamp_seconds("t").cast("timestamp_ntz")).drop("t")


def test_blocked_rolling_equals_plain_window(spark):
    df = _series(spark)
    plain = anomalies.rolling_stats(df, "k", ["ts", "event_id"], "v", 24, skew_safe=False)
    # tiny blocks: every block boundary and the halo are exercised many times
    blocked = anomalies.rolling_stats(df, "k", ["ts", "event_id"], "v", 24, block_rows=25)
    a = {r["event_id"]: (r["v_mean"], r["v_std"]) for r in plain.collect()}
    b = {r["event_id"]: (r["v_mean"], r["v_std"]) for r in blocked.collect()}
    assert a.keys() == b.keys() and len(a) == df.count()
    for k in a:
        assert math.isclose(a[k][0], b[k][0], rel_tol=1e-12, abs_tol=1e-12)
        assert math.isclose(a[k][1], b[k][1], rel_tol=1e-9, abs_tol=1e-9)


def test_rolling_zscore_bound_and_zero_spread(spark):
    df = _series(spark, n_hot=500)
    z = anomalies.rolling_zscore(df, "k", ["ts", "event_id"], "v", 8, block_rows=16)
    w = Window.partitionBy("k").orderBy("ts", "event_id").rowsBetween(-7, 0)
    z = z.withColumn("n", F.count("v").over(w))
    for r in z.collect():
        if r["v_zscore"] is not None:
            assert abs(r["v_zscore"]) <= math.sqrt(r["n"] - 1) + 1e-9
        else:
            assert r["v_std"] == 0.0
    const = spark.createDataFrame([(i, "s", i, 3.0) for i in range(10)], "event_id long, k string, ts long, v double")
    out = anomalies.rolling_peaks(const, "k", ["ts", "event_id"], "v", 4)
    assert out.count() == 0


def test_peaks_two_sided_catches_negative_spike(spark):
    rows = [(i, "s", i, 10.0 + (i % 2) * 0.1) for i in range(30)] + [(30, "s", 30, -50.0)]
    df = spark.createDataFrame(rows, "event_id long, k string, ts long, v double")
    up = anomalies.rolling_peaks(df, "k", ["ts", "event_id"], "v", 24, sided="up")
    both = anomalies.rolling_peaks(df, "k", ["ts", "event_id"], "v", 24, sided="both")
    assert up.count() == 0
    assert [r["event_id"] for r in both.collect()] == [30]


def test_group_zscore_null_keys_and_singletons(spark):
    rows = [("L1", 1), ("L1", 1), ("L1", 1), ("L1", 1), ("L1", 1), ("L1", 3), ("L2", 2), (None, 3), ("L3", 2), ("L3", 2)]
    df = spark.createDataFrame(rows, "line string, score int")
    z = anomalies.group_zscore(df, "line", "score")
    assert z.where(F.col("line").isNull()).count() == 0
    by = {r["line"]: r for r in z.collect()}
    assert by["L2"]["group_std"] is None and by["L2"]["z_score"] is None
    assert by["L3"]["z_score"] is None  # sd 0 -> NULL, not an error
    out = anomalies.group_outliers(df, "line", "score", threshold=1.75)
    assert [(r["line"], r["score"]) for r in out.collect()] == [("L1", 3)]


def test_nearest_points_and_unknown_reference(spark):
    df = spark.createDataFrame([("A", 0.0, 0.0), ("B", 3.0, 4.0), ("C", 1.0, 0.0), ("D", None, 1.0)],
                               "name string, x double, y double")
    out = spatial.nearest_points(df, F.col("name") == "A", "x", "y", k=None, tie=["name"]).collect()
    assert [r["name"] for r in out] == ["A", "C", "B"]
    assert out[2]["distance"] == 5.0
    assert spatial.nearest_points(df, F.col("name") == "Z", "x", "y").count() == 0


def test_profiles(spark):
    df = spark.createDataFrame([("a", "b", "ab", "a", None), ("x", "y", "xy", "x", None)],
                               "p string, q string, pq string, p2 string, n string")
    nulls = {r["column"]: r["null_fraction"] for r in profile.profile_nulls(df).collect()}
    assert nulls["n"] == 1.0 and nulls["p"] == 0.0
    eq = {(r["column_a"], r["column_b"]): r["equal"] for r in profile.profile_equal_columns(df).collect()}
    assert eq[("p", "p2")] is True and eq[("p", "q")] is False
    cc = {(r["column"], r["part_a"], r["part_b"]): r["is_concat"]
          for r in profile.profile_concat_columns(df, ["p", "q", "pq"]).collect()}
    assert cc[("pq", "p", "q")] is True and cc[("pq", "q", "p")] is False


def test_range_frame_equals_plain_range_window(spark):
    df = _series(spark, n_hot=2000)
    out = anomalies.rolling_stats_range(df, "k", "ts", "v", 3 * 3600)
    t = F.unix_micros(F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp"))
    w = Window.partitionBy("k").orderBy("__t").rangeBetween(-3 * 3600 * 1_000_000, 0)
    plain = (df.withColumn("__t", t).withColumn("m", F.avg("v").over(w)).withColumn("s", F.stddev_pop("v").over(w))
               .withColumn("n", F.count("v").over(w)))
    a = {r["event_id"]: (r["v_mean"], r["v_std"], r["v_count"]) for r in out.collect()}
    b = {r["event_id"]: (r["m"], r["s"], r["n"]) for r in plain.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][2] == b[k][2]
        assert math.isclose(a[k][0], b[k][0], rel_tol=1e-12, abs_tol=1e-12)
        assert math.isclose(a[k][1], b[k][1], rel_tol=1e-9, abs_tol=1e-9)


def test_profiles_in_batches_equal_single_pass(spark):
    df = spark.createDataFrame([("a", "b", "ab", "a"), ("x", "y", "xy", "x")], "p string, q string, pq string, p2 string")
    one = sorted(map(tuple, profile.profile_concat_columns(df).collect()))
    many = sorted(map(tuple, profile.profile_concat_columns(df, max_checks=5).collect()))
    assert one == many and len(one) == 24
    assert sorted(map(tuple, profile.profile_equal_columns(df, max_checks=2).collect())) == \
        sorted(map(tuple, profile.profile_equal_columns(df).collect()))


def test_struct_keys_with_nulls_keep_every_row(spark):
    rows = [(i, None if i % 3 == 0 else (i % 2, "x"), i, float(i % 5)) for i in range(120)]
    df = spark.createDataFrame(rows, "event_id long, k struct<a:int,b:string>, t long, v double")
    plain = anomalies.rolling_stats(df, "k", ["t", "event_id"], "v", 4, skew_safe=False)
    blocked = anomalies.rolling_stats(df, "k", ["t", "event_id"], "v", 4, block_rows=8)
    a = {r["event_id"]: (r["v_mean"], r["v_std"]) for r in plain.collect()}
    b = {r["event_id"]: (r["v_mean"], r["v_std"]) for r in blocked.collect()}
    assert len(b) == 120 and a.keys() == b.keys()
    for k in a:
        assert math.isclose(a[k][0], b[k][0], abs_tol=1e-12) and math.isclose(a[k][1], b[k][1], abs_tol=1e-9)
