"""Grouped scores, rankings and indices (hash aggregates with partial combine)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airnet.operators._util import as_list


def exposure_ranking(df: DataFrame, keys, score: str, *, k: int | None = 20,
                     mean_col: str = "score_mean", max_col: str = "score_max") -> DataFrame:
    """Mean and max score per key group, ranked by mean then max (descending, NULLs
    last, keys ascending to break ties); ``k`` makes it a top-k report."""
    keys = as_list(keys)
    out = df.groupBy(*keys).agg(F.avg(score).alias(mean_col), F.max(score).alias(max_col))
    out = out.orderBy(F.col(mean_col).desc_nulls_last(), F.col(max_col).desc_nulls_last(),
                      *[F.col(c).asc_nulls_last() for c in keys])
    return out.limit(k) if k is not None else out


def global_index(df: DataFrame, score: str, max_score: float = 3.0, *,
                 mean_col: str = "score_mean", index_col: str = "index_0_100") -> DataFrame:
    """One row: mean score and the same mean as a 0-100 index (``mean / max * 100``)."""
    return (df.agg(F.avg(score).alias(mean_col))
              .withColumn(index_col, F.col(mean_col) / F.lit(float(max_score)) * F.lit(100.0)))


def key_scores(df: DataFrame, key: str, score: str, *, out_key: str | None = None,
               out: str = "score") -> DataFrame:
    """Mean score per key, keys whose mean is NULL removed."""
    res = df.groupBy(F.col(key).alias(out_key or key)).agg(F.avg(score).cast("double").alias(out))
    return res.where(F.col(out).isNotNull())
