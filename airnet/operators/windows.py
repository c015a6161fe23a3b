"""Event-time sliding-window statistics and anomalies.  The same functions serve batch
and streaming DataFrames (``airnet.streaming`` wraps them with a source and a sink)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airnet.functions.columns import guarded_zscore
from airnet.operators._util import as_list


def window_stats(df: DataFrame, ts: str, keys, measures, *, duration: str = "30 seconds",
                 slide: str | None = "10 seconds") -> DataFrame:
    """Per (window, key): ``<m>_mean``, ``<m>_std`` (population) and ``<m>_max`` of each
    measure, plus the guarded z-score of the maximum ``<m>_zscore``
    (``(max - mean) / sd`` when sd > 0, else 0).  Output is flat: ``window_start``,
    ``window_end``, keys, statistics.  Aggregates are algebraic, so Spark combines them
    map-side before the shuffle and in the streaming state store.
    """
    keys = as_list(keys)
    win = F.window(F.col(ts), duration, slide) if slide else F.window(F.col(ts), duration)
    aggs = []
    for m in as_list(measures):
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std"), F.max(m).alias(f"{m}_max")]
    out = df.groupBy(win.alias("window"), *keys).agg(*aggs)
    for m in as_list(measures):
        out = out.withColumn(f"{m}_zscore", guarded_zscore(f"{m}_max", f"{m}_mean", f"{m}_std"))
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                      *[c for c in out.columns if c != "window"])


def window_anomalies(stats: DataFrame, measures, threshold: float = 1.75) -> DataFrame:
    """Windows where any measure's max z-score reaches ``threshold``."""
    cond = None
    for m in as_list(measures):
        c = F.col(f"{m}_zscore") >= F.lit(threshold)
        cond = c if cond is None else (cond | c)
    return stats.where(cond)


def round_robin_assign(df: DataFrame, id_col: str, keys: list, out: str = "station") -> DataFrame:
    """Attach ``keys[id mod len(keys)]`` to each row (stateless; works on streams).

    ``keys`` is a small bounded list (see :func:`airnet.operators.profile.bounded_keys`);
    it becomes a literal array folded into the expression.
    """
    if not keys:
        raise ValueError("round_robin_assign needs at least one key")
    arr = F.array(*[F.lit(k) for k in keys])
    idx = F.pmod(F.col(id_col), F.lit(len(keys))).cast("int")
    return df.withColumn(out, F.element_at(arr, idx + F.lit(1)))
