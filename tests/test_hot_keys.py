"""Hot keys: NULL times, NULL keys and keys that differ by a microsecond stay what they are."""
import datetime as dt

from pyspark.sql import functions as F

from airnet.operators import anomalies, ml, reshape
from airnet.session import DEFAULT_CONF, get_session, materialize


def _rows():
    start = dt.datetime(2024, 1, 1)
    out = []
    for i in range(120):
        ts = None if i % 20 == 0 else start + dt.timedelta(minutes=17 * i)
        out.append((i, start + dt.timedelta(microseconds=i % 2), "a" if i % 3 else None, ts, float(i * i % 23)))
    return out


def test_hot_equals_plain(spark):
    df = spark.createDataFrame(_rows(), "id long, at timestamp_ntz, k string, ts timestamp_ntz, v double")
    df = df.withColumn("s", F.struct("at", "k"))
    for key in ("k", "s", "at"):
        plain = anomalies.rolling_stats(df, key, ["ts", "id"], "v", 7, skew_safe=False)
        hot = anomalies.rolling_stats(df, key, ["ts", "id"], "v", 7, block_rows=7, hot_rows=5)
        a = {r.id: (round(r.v_mean, 9), round(r.v_std, 9)) for r in plain.collect()}
        assert a == {r.id: (round(r.v_mean, 9), round(r.v_std, 9)) for r in hot.collect()} and len(a) == 120


def test_metrics_of_incomplete_and_large_labels(spark):
    df = spark.createDataFrame([(1.0, 2.0), (5.0, 3.0), (None, 1.0), (2.0, None)], "label double, prediction double")
    r = ml.regression_metrics(df).first()
    assert r.rows == 2 and abs(r.rmse - 2.5 ** 0.5) < 1e-12
    big = spark.createDataFrame([(1e9 + i, 1e9 + i + 0.1) for i in range(50)], "label double, prediction double")
    sst = sum((i - 24.5) ** 2 for i in range(50))
    assert abs(ml.regression_metrics(big).first().r2 - (1 - 50 * 0.01 / sst)) < 1e-6


def test_unpivot_of_any_name(spark):
    df = spark.createDataFrame([("x", "1", "2")], ["id", "St. Denis", "a`b"])
    got = {(r.station, r.pm) for r in reshape.wide_to_long(df, ["id"]).collect()}
    assert got == {("St. Denis", 1.0), ("a`b", 2.0)}


def test_session_keeps_the_master(spark):
    assert "spark.master" not in DEFAULT_CONF and "spark.driver.memory" not in DEFAULT_CONF
    assert get_session().sparkContext.master == spark.sparkContext.master == "local[4]"


def test_scratch_is_below_the_warehouse(spark):
    path = materialize(spark.range(3)).inputFiles()[0]
    assert spark.conf.get("spark.checkpoint.dir").replace("file:", "") in path.replace("file://", "")
