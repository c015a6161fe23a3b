"""Joins and frames in which one key holds most rows: results as without skew, work bounded per task."""
import math
import statistics

import pytest
from pyspark.sql import functions as F

from airnet.operators import anomalies, joins, ml, sequence


@pytest.fixture()
def plain_joins(spark):
    """No automatic broadcast, no runtime re-planning: what is dealt to a task stays there."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _rows(n=4000):
    return [(i, "hot" if i % 4 else (None if i % 20 == 0 else f"k{i % 12}"), float(i % 97)) for i in range(n)]


def test_hot_group_is_dealt_over_tasks(spark, plain_joins):
    df = spark.createDataFrame(_rows(), "id long, k string, v double")
    out = anomalies.group_zscore(df, "k", "v", hot_rows=50)
    per_task = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    whole = anomalies.group_zscore(df, "k", "v").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"))
    assert max(r["n"] for r in whole.collect()) >= 3000            # unsplit: the hot group is one task
    assert len(per_task) == 8 and max(per_task) < 2 * 3800 / 8     # split: no task above twice its share


def test_group_zscore_equals_statistics(spark):
    rows = _rows(600)
    df = spark.createDataFrame(rows, "id long, k string, v double")
    got = {r["id"]: (r["group_mean"], r["group_std"], r["z_score"]) for r in anomalies.group_zscore(df, "k", "v", hot_rows=7).collect()}
    groups = {}
    for i, k, v in rows:
        if k is not None:
            groups.setdefault(k, []).append(v)
    assert set(got) == {i for i, k, _ in rows if k is not None}
    for i, k, v in rows:
        if k is not None:
            m, s = statistics.fmean(groups[k]), statistics.stdev(groups[k])
            assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(got[i], (m, s, (v - m) / s)))


@pytest.mark.parametrize("max_hot", [10_000, 0])
def test_left_join_keeps_null_and_unknown_keys(spark, max_hot):
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(["a"] * 50 + [None] * 30 + ["b", "zz", "zz"])], "id long, k string")
    rows = rows.union(rows.limit(1))   # a repeated row stays twice
    stats = spark.createDataFrame([("a", 50, 1.5), ("b", 1, 2.5), ("c", 9, 3.5)], "k string, n long, m double")
    got = joins.hot_group_join(rows, stats, "k", count_col="n", how="left", hot_rows=8, max_hot=max_hot)
    assert got.columns == ["k", "id", "m"] and got.count() == 84
    assert {(r["k"], r["m"]) for r in got.collect()} == {("a", 1.5), ("b", 2.5), (None, None), ("zz", None)}
    inner = joins.hot_group_join(rows, stats, "k", count_col="n", hot_rows=8, max_hot=max_hot)
    assert inner.count() == 52


def test_group_mean_predictor_with_a_hot_group(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 8.0)], "g string, label double")
    test = spark.createDataFrame([(i, "a" if i % 10 else "new", 0.0) for i in range(100)] + [(100, None, 0.0)], "id long, g string, label double")
    got = {r["id"]: r["prediction"] for r in ml.group_mean_predictor(train, test, "g", hot_rows=5).collect()}
    assert len(got) == 101 and all(got[i] == (2.0 if i % 10 and i < 100 else 4.0) for i in got)


def test_top_outliers_with_ties(spark):
    df = spark.createDataFrame([(i, "g", 0.0 if i < 50 else 10.0) for i in range(60)], "id long, k string, v double")
    top = anomalies.group_outliers(df, "k", "v", threshold=1.0, limit=4, tie=["id"])
    assert [r["id"] for r in top.collect()] == [50, 51, 52, 53]


@pytest.mark.parametrize("partitions", [1, 7])
def test_positions_need_no_spread_of_the_order(spark, partitions):
    # all rows of the hot key at one time, ordered by text; NULLs first
    rows = [("hot" if i % 3 else None, None if i % 50 == 0 else f"{(i * 7919) % 1000:04d}", i) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, t string, id long")
    got, _ = sequence.position_in_key(df, ["k"], ["t", "id"], partitions=partitions)
    got = {r["id"]: r["__idx"] for r in got.collect()}
    for key in ("hot", None):
        ordered = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or "", r[2]))
        assert [got[r[2]] for r in ordered] == list(range(len(ordered)))


def test_numbering_tasks_are_even(spark):
    rows = [("hot", 5, i) for i in range(4000)]
    placed = sequence.sorted_places(spark.createDataFrame(rows, "k string, t long, id long"), ["k"], ["t", "id"], 8)
    sizes = [r["count"] for r in placed.groupBy("__pid").count().collect()]
    assert len(sizes) >= 7 and max(sizes) < 1000
