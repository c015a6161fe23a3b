import math

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from airnet.operators import ml
from airnet.plans import queries as Q

SF = "/root/testdata/sf0.001"


def test_hash_split_is_stable_under_repartition(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id")
    a = {r["event_id"]: r["split"] for r in ml.hash_split(ev, "event_id").collect()}
    b = {r["event_id"]: r["split"] for r in ml.hash_split(ev.repartition(7), "event_id").collect()}
    assert a == b
    share = sum(v == "train" for v in a.values()) / len(a)
    assert 0.6 < share < 0.8


def test_metrics_match_evaluator(spark):
    pred = Q._gm_predictions(spark, SF)
    m = ml.regression_metrics(pred).first()
    ev = RegressionEvaluator(labelCol="label", predictionCol="prediction")
    assert math.isclose(m["rmse"], ev.evaluate(pred, {ev.metricName: "rmse"}), rel_tol=1e-9)
    assert math.isclose(m["r2"], ev.evaluate(pred, {ev.metricName: "r2"}), rel_tol=1e-9, abs_tol=1e-12)
    assert math.isclose(m["mae"], ev.evaluate(pred, {ev.metricName: "mae"}), rel_tol=1e-9)


def test_unseen_category_encodes_as_zeros(spark):
    train = spark.createDataFrame([("a", 1, 2, 3, 1.0), ("b", 2, 3, 4, 2.0), ("a", 3, 4, 5, 3.0)],
                                  "station string, hour int, dayOfWeek int, month int, label double")
    test = spark.createDataFrame([("zzz", 1, 2, 3, 1.0)], train.schema)
    model = ml.fit_features(train)
    vec = ml.features_as_array(model.transform(test)).first()["features_dense"]
    assert vec[3:] == [0.0, 0.0]


def test_models_run_and_summary(spark):
    train, test = Q._fitted_split(spark, SF)
    lr = ml.linear_regression(10, 0.3, 0.8).fit(train)
    s = ml.lr_summary(spark, lr).first()
    assert s["iterations"] <= 11 and s["rmse"] > 0
    dt = ml.decision_tree().fit(train).transform(test)
    assert dt.where(F.col("prediction").isNull()).count() == 0
    worst = ml.worst_predictions(lr.transform(test), 10, tie=["event_id"]).collect()
    assert len(worst) == 10 and worst[0]["error"] >= worst[-1]["error"]


def _frame(spark, n=2500):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").limit(n)
    return Q.reshape.temporal_parts(ev.select("event_id", F.col("ts").alias("datetime"), F.col("event_type").alias("station"), "value"),
                                    "datetime", label_from="value").drop("value")


def test_forest_does_not_depend_on_partitions(spark, tmp_dir):
    _frame(spark).write.parquet(tmp_dir + "/f")
    f = spark.read.parquet(tmp_dir + "/f")
    got = []
    for frame in (f.repartition(2), f.repartition(16).orderBy("label")):
        train, test = ml.train_test(frame, "event_id", 70)
        fm = ml.fit_features(train)
        model = ml.random_forest(8).fit(fm.transform(train))
        rows = model.transform(fm.transform(test)).select("event_id", "prediction").collect()
        got.append({r["event_id"]: round(r["prediction"], 9) for r in rows})
    assert got[0] == got[1] and len(set(got[0].values())) > 20


def test_elastic_net_equals_coordinate_descent(spark):
    import numpy as np
    f = _frame(spark)
    ff = ml.features_as_array(ml.fit_features(f).transform(f))
    rows = ff.select("features_dense", "label").collect()
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    keep = x.std(0) > 0
    z, sy = (x - x.mean(0)) / np.where(keep, x.std(0), 1), y.std()
    t, l1, l2 = (y - y.mean()) / sy, 0.3 * 0.8 / sy, 0.3 * 0.2 / sy
    w = np.zeros(x.shape[1])
    for _ in range(2000):
        for j in np.flatnonzero(keep):
            c = z[:, j] @ (t - z @ w + z[:, j] * w[j]) / len(t)
            w[j] = np.sign(c) * max(abs(c) - l1, 0) / (1 + l2)
    want = np.where(keep, w * sy / np.where(keep, x.std(0), 1), 0)
    model = ml.linear_regression(500, 0.3, 0.8, tol=1e-12).fit(ff)
    assert np.allclose(model.coefficients.toArray(), want, atol=1e-4)
    assert math.isclose(model.intercept, y.mean() - want @ x.mean(0), rel_tol=1e-5)
    res = ml.lr_residuals(model, ff).agg(F.avg("residual").alias("m"), F.stddev_pop("residual").alias("s")).first()
    assert abs(res["m"]) < 1e-6 and math.isclose(res["s"], ml.lr_summary(spark, model).first()["rmse"], rel_tol=1e-9)


def test_elastic_net_of_a_constant_feature_and_of_no_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0), (None, 5.0), (3.0, None)], "x double, y double")
    r = ml.elastic_net_one(df, "x", "y").first()
    assert (r["coefficient"], r["intercept"], r["rows"]) == (0.0, 3.0, 2) and math.isclose(r["rmse"], 1.0)
    assert ml.elastic_net_one(df.limit(0), "x", "y").first()["rows"] == 0


def test_tree_equals_exhaustive_search(spark):
    import numpy as np
    from pyspark.ml.feature import VectorAssembler
    f = VectorAssembler(inputCols=["hour", "dayOfWeek"], outputCol="features").transform(_frame(spark))
    data = np.array([(r["hour"], r["dayOfWeek"], r["label"]) for r in f.collect()])

    def grow(rows, depth):
        y, best = rows[:, 2], (1e-9, None)
        for j in (0, 1):
            for v in np.unique(rows[:, j])[:-1]:
                left = rows[:, j] <= v
                fall = ((y - y.mean())**2).sum() - sum(((p - p.mean())**2).sum() for p in (y[left], y[~left]))
                if depth and fall > best[0] + 1e-9:
                    best = (fall, (j, v))
        if best[1] is None:
            return lambda r, m=y.mean(): m
        j, v = best[1]
        a, b = grow(rows[rows[:, j] <= v], depth - 1), grow(rows[rows[:, j] > v], depth - 1)
        return lambda r: a(r) if r[j] <= v else b(r)
    tree = grow(data, 3)
    for r in ml.decision_tree(max_depth=3).fit(f).transform(f).collect():
        assert math.isclose(r["prediction"], tree((r["hour"], r["dayOfWeek"])), rel_tol=1e-9)


def test_many_categories_are_indexed_without_a_list(spark):
    n = 200_000
    df = spark.range(n).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("c")).union(
        spark.createDataFrame([("hot",)] * 500 + [("c7",)] + [(None,)], "c string"))
    index = ml.category_index(df, "c")
    top = index.orderBy("cIndex").limit(3).collect()
    assert [(r["c"], r["cIndex"], r["rows"]) for r in top] == [("hot", 0.0, 500), ("c7", 1.0, 2), ("c0", 2.0, 1)]
    assert index.count() == n + 1 and index.agg(F.max("cIndex")).first()[0] == n
    coded = ml.index_categories(df, index, "c", hot_rows=100)
    assert coded.count() == n + 502 and coded.where("cIndex is null").count() == 1 and coded.where("cIndex = 0").count() == 500


def test_index_equals_the_library_indexer(spark):
    from pyspark.ml.feature import StringIndexer
    f = _frame(spark)
    want = StringIndexer(inputCol="station", outputCol="i").fit(f).transform(f)
    got = ml.index_categories(f, ml.category_index(f, "station"), "station")
    assert {(r["event_id"], r["i"]) for r in want.collect()} == {(r["event_id"], r["stationIndex"]) for r in got.collect()}
