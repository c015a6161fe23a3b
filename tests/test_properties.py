"""Property tests: header names, colours, and the task-size bound of hot-key blocks."""
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from airnet.functions.columns import EDGE_PALETTE
from airnet.functions.names import unique_names
from airnet.operators import sequence, style

cells = st.lists(st.one_of(st.none(), st.text(max_size=6), st.sampled_from(["A", "A_1", "A_2", " A ", ""])),
                 min_size=1, max_size=12)


@given(cells)
def test_unique_names_are_unique_and_clean(row):
    names = unique_names(row)
    assert len(names) == len(row) and len(set(names)) == len(names)
    assert names[0] == "datetime"
    assert all(re.fullmatch(r"[A-Za-z0-9_-]+", n) for n in names)


@given(cells)
def test_raw_names_unique(row):
    names = unique_names(row, clean=False)
    assert len(set(names)) == len(names)


@settings(max_examples=1, deadline=None)
@given(st.just(0))
def test_line_colors_rule(spark, _):
    labels = [str(i) for i in range(-3, 45)] + ["7_b", "x", "3bis", "12_"]
    got = {r["line"]: r["color"] for r in style.edge_colors(spark.createDataFrame([(x,) for x in labels], "line string")).collect()}
    for x in labels:
        base = x.split("_")[0]
        exp = EDGE_PALETTE[(int(base) - 1) % 20] if base.lstrip("-").isdigit() and int(base) >= 1 else "#000000"
        assert got[x] == exp, x


def test_hot_key_blocks_are_bounded(spark):
    # one key holds 3/4 of all rows; with block_rows=50 no window partition may exceed 50 + 23
    rows = [(i, "hot" if i % 4 else f"k{i % 13}", i) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, k string, t long")
    base, sk = sequence.key_copies(df, ["k"])
    hot_frame, _ = sequence._blocked_hot(base.where(F.col("k") == "hot"), sk, ["t", "id"], 24, 50)
    sizes = [r["n"] for r in hot_frame.groupBy(*sk, "__blk").agg(F.count(F.lit(1)).alias("n")).collect()]
    # 60 real blocks plus one that only holds the halo of the last block
    assert max(sizes) <= 50 + 23 and len(sizes) == 61
    assert hot_frame.where(F.col("__shift") == 0).count() == 3000


def test_full_outer_self_join_has_no_nulls(spark):
    from airnet.operators import joins
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    hourly = ev.groupBy(F.date_trunc("hour", "ts").alias("hour"), "user_id").agg(F.avg("value").alias("a"))
    j = joins.full_outer_measures(hourly, hourly.withColumnRenamed("a", "b"), ["hour", "user_id"])
    assert j.count() == hourly.count()
    assert j.where(F.col("a").isNull() | F.col("b").isNull() | F.col("hour").isNull()).count() == 0


def test_group_zscore_bound(spark):
    import math
    import random
    from airnet.operators import anomalies
    rnd = random.Random(3)
    rows = [(f"g{g}", float(rnd.choice([0, 1, 1, 2, 3, 50]))) for g in range(40) for _ in range(rnd.randint(1, 12))]
    df = spark.createDataFrame(rows, "g string, v double")
    z = anomalies.group_zscore(df, "g", "v").withColumn("n", F.count("v").over(Window.partitionBy("g")))
    for r in z.collect():
        if r["z_score"] is not None:
            assert abs(r["z_score"]) <= (r["n"] - 1) / math.sqrt(r["n"]) + 1e-9


@settings(max_examples=6, deadline=None)
@given(rows=st.integers(1, 6), block=st.integers(6, 30), hot_share=st.floats(0.3, 0.9), seed=st.integers(0, 10_000))
def test_blocked_frame_equals_plain_window(spark, rows, block, hot_share, seed):
    import random
    from airnet.operators import anomalies
    rnd = random.Random(seed)
    data = [(i, "hot" if rnd.random() < hot_share else rnd.choice(["a", "b", None]), rnd.randint(0, 50),
             float(rnd.randint(0, 9))) for i in range(300)]
    df = spark.createDataFrame(data, "id long, k string, t long, v double")
    plain = anomalies.rolling_stats(df, "k", ["t", "id"], "v", rows, skew_safe=False)
    blocked = anomalies.rolling_stats(df, "k", ["t", "id"], "v", rows, block_rows=block)
    a = {r["id"]: (round(r["v_mean"], 9), round(r["v_std"], 9)) for r in plain.collect()}
    b = {r["id"]: (round(r["v_mean"], 9), round(r["v_std"], 9)) for r in blocked.collect()}
    assert a == b


@settings(max_examples=4, deadline=None)
@given(names=st.sets(st.one_of(st.text(min_size=1, max_size=5), st.just("zzz"),
                               st.text(alphabet="a", min_size=1, max_size=30)), min_size=1, max_size=200),
       parts=st.integers(1, 9))
def test_dense_ids_are_rank_order(spark, names, parts):
    from airnet.operators import graph
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r["name"]: r["vertex_id"] for r in graph.dense_ids(df, partitions=parts).collect()}
    ordered = [r["name"] for r in df.orderBy("name").collect()]  # Spark's own string order
    assert got == {n: i for i, n in enumerate(ordered)}
