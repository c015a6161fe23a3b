"""Time frames from partial sums against a direct sum over each frame."""
import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from airnet.operators import anomalies

T0 = dt.datetime(2024, 1, 1)


def _rows(seed, n=500):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        t = None if rng.random() < 0.05 else T0 + dt.timedelta(seconds=rng.choice([rng.randint(0, 40000), rng.randint(0, 300), 3600, 7200]))
        out.append((i, rng.choice(["hot", "hot", "hot", "b", None]), t, None if rng.random() < 0.1 else 1e6 + rng.random()))
    return out


@pytest.mark.parametrize("kind,parts,bucket_rows,dense", [("timestamp_ntz", 32, 1 << 20, 0), ("timestamp", 2, 1 << 20, 0),
                                                          ("timestamp_ntz", 4, 20, 0), ("timestamp_ntz", 8, 20, 10_000)])
def test_equals_direct_sums(spark, kind, parts, bucket_rows, dense):
    rows = _rows(parts)
    df = spark.createDataFrame(rows, f"id long, k string, t {kind}, v double")
    got = anomalies.rolling_stats_range(df, "k", "t", "v", 3600, parts=parts, bucket_rows=bucket_rows, dense_rows=dense)
    assert got.columns == ["id", "k", "t", "v", "v_mean", "v_std", "v_count"]
    got = {r["id"]: r for r in got.collect()}
    assert len(got) == len(rows)
    for i, k, t, _ in rows:
        frame = [v for _, k2, t2, v in rows if k2 == k and v is not None
                 and ((t is None and t2 is None) or (t and t2 and t - dt.timedelta(hours=1) <= t2 <= t))]
        r = got[i]
        assert r["v_count"] == len(frame)
        if frame:
            m = math.fsum(frame) / len(frame)
            s = math.sqrt(math.fsum((x - m) ** 2 for x in frame) / len(frame))
            assert math.isclose(r["v_mean"], m, rel_tol=1e-12) and math.isclose(r["v_std"], s, abs_tol=1e-6)
        else:
            assert r["v_mean"] is None and r["v_std"] is None


def test_no_task_holds_a_dense_key(spark):
    # 5,000 rows of one key inside what used to be one bucket of four frames
    df = spark.range(5000).select(F.lit("k").alias("k"), F.timestamp_seconds(F.col("id") * 60).alias("t"), F.col("id").cast("double").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = anomalies.rolling_stats_range(df, "k", "t", "v", 24 * 3600, dense_rows=1000)
        placed = out.select("v_count", F.spark_partition_id().alias("p"))
        sizes = [r["n"] for r in placed.groupBy("p").agg(F.count("v_count").alias("n"), F.sum("v_count")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) >= 6 and max(sizes) < 2000
    assert out.where("v_count != least(v + 1, 1441)").count() == 0


def test_arguments(spark):
    with pytest.raises(ValueError):
        anomalies.rolling_stats_range(spark.createDataFrame([], "k string, t timestamp, v double"), "k", "t", "v", 1, parts=7)
    empty = anomalies.rolling_stats_range(spark.createDataFrame([], "k string, t timestamp, v double"), "k", "t", "v")
    assert empty.count() == 0
