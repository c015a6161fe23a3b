"""Feature preparation, stable train/test split, regression models and metrics (MLlib).

Model fitting is MLlib's distributed aggregation (tree-aggregates of gradients or
sufficient statistics); the fitted model is small and lives on the driver.  Everything
else is column expressions and aggregates.
"""
from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType,
)

from airnet.functions.columns import hash_bucket
from airnet.operators._util import as_list
from airnet.operators.joins import hot_group_join
from airnet.operators.sequence import position_in_key


def feature_stages(cat: str = "station", nums=("hour", "dayOfWeek", "month"), *,
                   features: str = "features", handle_invalid: str = "keep") -> list:
    """Stages: category -> frequency index -> one-hot (last level dropped); each numeric
    column -> 1-d vector -> scaled to unit sample sd (no centring); all -> ``features``.

    ``handle_invalid='keep'`` gives categories unseen at fit time the indexer's extra last
    index, which is exactly the slot one-hot drops: they encode as all zeros instead of
    failing.  ``'error'`` reproduces strict behaviour (one slot fewer).
    """
    stages = [StringIndexer(inputCol=cat, outputCol=f"{cat}Index", handleInvalid=handle_invalid),
              OneHotEncoder(inputCol=f"{cat}Index", outputCol=f"{cat}Vec", dropLast=True)]
    scaled = []
    for n in nums:
        stages += [VectorAssembler(inputCols=[n], outputCol=f"{n}Vec"),
                   StandardScaler(inputCol=f"{n}Vec", outputCol=f"{n}Scaled", withMean=False, withStd=True)]
        scaled.append(f"{n}Scaled")
    stages.append(VectorAssembler(inputCols=[*scaled, f"{cat}Vec"], outputCol=features))
    return stages


def fit_features(df: DataFrame, cat: str = "station", nums=("hour", "dayOfWeek", "month"), **kw) -> PipelineModel:
    return Pipeline(stages=feature_stages(cat, list(nums), **kw)).fit(df)


def features_as_array(df: DataFrame, col: str = "features", out: str = "features_dense") -> DataFrame:
    return df.withColumn(out, vector_to_array(F.col(col)))


def category_index(df: DataFrame, col: str, *, out: str | None = None, rows_col: str = "rows") -> DataFrame:
    """``col, out, rows``: the index of each category by falling count, equal counts by name (NULL is none).

    The counts are a partial aggregate and the indexes a distributed prefix sum, so a list of
    millions of categories never meets in one task or on the driver.
    """
    counts = (df.where(F.col(f"`{col}`").isNotNull()).groupBy(F.col(f"`{col}`").alias("__c"))
              .agg(F.count(F.lit(1)).alias(rows_col)).withColumn("__fall", -F.col(rows_col)))
    placed, _ = position_in_key(counts, [], ["__fall", "__c"], n_keys=1)
    return placed.select(F.col("__c").alias(col), F.col("__idx").cast("double").alias(out or f"{col}Index"), rows_col)


def index_categories(df: DataFrame, index: DataFrame, col: str, *, rows_col: str = "rows",
                     hot_rows: int = 1 << 20) -> DataFrame:
    """``df`` with the index column of a :func:`category_index` table; categories that it lacks, and NULL, get
    NULL.  A category with more than ``hot_rows`` rows is dealt over tasks."""
    return hot_group_join(df, index, col, count_col=rows_col, how="left", hot_rows=hot_rows)


def stable_layout(df: DataFrame, key, *, rows_per_partition: int = 250_000) -> DataFrame:
    """``df`` dealt by a hash of ``key`` and sorted inside each partition by key, then by its other columns.

    MLlib draws bagging weights and split candidates by partition and place.  Here the number of
    partitions comes from the number of rows alone, so the same rows give the same draws
    whatever their files, earlier shuffles or cores.  Columns that do not sort (maps, vectors) do not take part.
    """
    keys = as_list(key)
    n = max(8, -(-df.count() // rows_per_partition))
    rest = [f.name for f in df.schema.fields if f.name not in keys
            and isinstance(f.dataType, (NumericType, StringType, BooleanType, DateType, TimestampType, TimestampNTZType))]
    return df.repartition(n, *keys).sortWithinPartitions(*keys, *[F.col(f"`{c}`") for c in rest])


def hash_split(df: DataFrame, key: str, train_pct: int = 70, *, out: str = "split") -> DataFrame:
    """Label rows ``train`` / ``test`` from an MD5 bucket of ``key`` (0..99 < train_pct).

    Same rows on every run and after any repartitioning or task retry, unlike
    ``randomSplit`` which depends on partition layout.
    """
    return df.withColumn(out, F.when(hash_bucket(key) < F.lit(train_pct), F.lit("train")).otherwise(F.lit("test")))


def train_test(df: DataFrame, key: str, train_pct: int = 70) -> tuple[DataFrame, DataFrame]:
    """Stable train / test frames (see :func:`hash_split`) in a stable layout (:func:`stable_layout`), so that
    models fitted on them do not depend on partitions."""
    s = hash_split(stable_layout(df, key), key, train_pct, out="__split")
    return (s.where(F.col("__split") == "train").drop("__split"),
            s.where(F.col("__split") == "test").drop("__split"))


def linear_regression(max_iter: int = 10, reg: float = 0.3, elastic_net: float = 0.8, *,
                      label: str = "label", features: str = "features", solver: str = "auto",
                      tol: float = 1e-6) -> LinearRegression:
    return LinearRegression(maxIter=max_iter, regParam=reg, elasticNetParam=elastic_net, tol=tol,
                            labelCol=label, featuresCol=features, solver=solver)


def elastic_net_one(df: DataFrame, x: str, y: str, reg: float = 0.3, elastic_net: float = 0.8) -> DataFrame:
    """``coefficient, intercept, rmse, r2, rows``: the elastic net of one feature in closed form, from the
    moments of one aggregate (rows with both values).

    On standardised columns the loss is ``(1/2n) sum (y - w x)^2 + l1 |w| + (l2 / 2) w^2`` with
    ``l1 = reg * elastic_net / sd(y)`` and ``l2 = reg * (1 - elastic_net) / sd(y)``; its minimum is the correlation,
    moved towards 0 by ``l1`` and divided by ``1 + l2``.  A constant feature gets coefficient 0.
    """
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    m = df.where(a.isNotNull() & b.isNotNull()).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(a).alias("mx"), F.avg(b).alias("my"), F.stddev_pop(a).alias("sx"),
        F.stddev_pop(b).alias("sy"), F.covar_pop(a, b).alias("cov"))
    corr = F.coalesce(F.try_divide(F.col("cov"), F.col("sx") * F.col("sy")), F.lit(0.0))
    l1 = F.try_divide(F.lit(float(reg * elastic_net)), F.col("sy"))
    l2 = F.try_divide(F.lit(float(reg * (1 - elastic_net))), F.col("sy"))
    w = F.signum(corr) * F.greatest(F.abs(corr) - l1, F.lit(0.0)) / (F.lit(1.0) + l2)
    m = m.withColumn("coefficient", F.coalesce(w * F.try_divide(F.col("sy"), F.col("sx")), F.lit(0.0)))
    # mean squared residual, from the moments
    c = F.col("coefficient")
    mse = F.col("sy") * F.col("sy") - F.lit(2.0) * c * F.col("cov") + c * c * F.col("sx") * F.col("sx")
    return m.select("coefficient", (F.col("my") - c * F.col("mx")).alias("intercept"), F.sqrt(mse).alias("rmse"),
                    (F.lit(1.0) - F.try_divide(mse, F.col("sy") * F.col("sy"))).alias("r2"), "rows")


def decision_tree(*, label: str = "label", features: str = "features", seed: int = 42, max_depth: int = 5) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(labelCol=label, featuresCol=features, seed=seed, maxDepth=max_depth)


def random_forest(num_trees: int = 50, *, label: str = "label", features: str = "features",
                  seed: int = 42, bootstrap: bool = True, max_depth: int = 5) -> RandomForestRegressor:
    """Fit it on a :func:`stable_layout`: the bagging weights are drawn by partition and place."""
    return RandomForestRegressor(numTrees=num_trees, labelCol=label, featuresCol=features, seed=seed, maxDepth=max_depth,
                                 bootstrap=bootstrap)


def lr_summary(spark: SparkSession, model) -> DataFrame:
    """One-row DataFrame of a fitted linear model and its training summary."""
    s = model.summary
    row = (list(map(float, model.coefficients.toArray())), float(model.intercept), int(s.totalIterations),
           list(map(float, s.objectiveHistory)), float(s.rootMeanSquaredError), float(s.r2))
    return spark.createDataFrame([row], "coefficients array<double>, intercept double, iterations int, "
                                        "objective_history array<double>, rmse double, r2 double")


def lr_residuals(model, df: DataFrame, *, label: str = "label", prediction: str = "prediction",
                 out: str = "residual") -> DataFrame:
    """``df`` with the model's prediction and ``label - prediction``."""
    return model.transform(df).withColumn(out, F.col(label) - F.col(prediction))


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One aggregate pass over the rows that have both values: ``rmse = sqrt(mean((p - y)^2))``,
    ``r2 = 1 - SSE / SST`` (SST around the mean label of these rows), ``mae``, ``rows``."""
    y, p = F.col(label), F.col(prediction)
    sums = pred.where(y.isNotNull() & p.isNotNull()).agg(
        F.count(F.lit(1)).alias("rows"), F.sum((p - y) * (p - y)).alias("sse"),
        F.sum(F.abs(p - y)).alias("sae"), F.var_pop(y).alias("var"))
    sst = F.col("var") * F.col("rows")  # not a difference of large sums
    return sums.select(F.sqrt(F.try_divide(F.col("sse"), F.col("rows"))).alias("rmse"),
                       (F.lit(1.0) - F.try_divide(F.col("sse"), sst)).alias("r2"),
                       F.try_divide(F.col("sae"), F.col("rows")).alias("mae"), "rows")


def with_error(pred: DataFrame, label: str = "label", prediction: str = "prediction",
               out: str = "error") -> DataFrame:
    return pred.withColumn(out, F.abs(F.col(prediction) - F.col(label)))


def best_predictions(pred: DataFrame, k: int = 10, *, tie=None, **kw) -> DataFrame:
    """Top-k smallest absolute errors (ties broken by ``tie``)."""
    e = with_error(pred, **kw)
    return e.orderBy(F.col("error").asc(), *[F.col(c) for c in as_list(tie)]).limit(k)


def worst_predictions(pred: DataFrame, k: int = 10, *, tie=None, **kw) -> DataFrame:
    """Top-k largest absolute errors (ties broken by ``tie``)."""
    e = with_error(pred, **kw)
    return e.orderBy(F.col("error").desc(), *[F.col(c) for c in as_list(tie)]).limit(k)


def group_mean_predictor(train: DataFrame, test: DataFrame, group, label: str = "label",
                         prediction: str = "prediction", *, hot_rows: int = 1 << 20) -> DataFrame:
    """Baseline model: predict the training mean label of the row's group (the fitted
    table has one row per group; groups unseen in training get the global mean)."""
    keys = as_list(group)
    means = train.groupBy(*keys).agg(F.avg(label).alias("__gm"))
    sizes = test.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    overall = train.agg(F.avg(label)).scalar()  # one value, a scalar subquery
    j = hot_group_join(test, means.join(sizes, keys), keys, count_col="__rows", how="left", hot_rows=hot_rows)
    return j.withColumn(prediction, F.coalesce(F.col("__gm"), overall)).drop("__gm")
