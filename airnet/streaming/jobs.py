"""Streaming jobs built from the batch operators (the same window function serves both)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airnet.operators import windows
from airnet.operators._util import as_list
from airnet.streaming.core import (
    append_sink, latest_state, open_state, run_until_done, scratch_path, to_event_time, to_wall_clock, upsert_sink,
)


def stream_window_stats(spark: SparkSession, stream: DataFrame, ts: str, keys, measures, *,
                        duration: str, slide: str | None, watermark: str | None = None,
                        timeout_s: float = 600.0) -> DataFrame:
    """Run sliding-window statistics over ``stream`` until its input is drained and
    return the final state (one row per window and key) read back from the sink table.

    Without ``watermark`` the state is kept for every window (exact, but unbounded on an
    endless stream); with it, state older than the watermark is dropped.
    """
    s = stream
    if watermark:  # watermarks need an instant; without one, windows run on the wall clock
        s = to_event_time(stream, ts).withWatermark(ts, watermark)
    stats = windows.window_stats(s, ts, keys, measures, duration=duration, slide=slide)
    path, ckpt = scratch_path(spark, "window-stats"), scratch_path(spark, "window-stats-ckpt")
    state_keys = ["window_start", "window_end", *as_list(keys)]
    run_until_done(upsert_sink(stats, path, ckpt, keys=state_keys), timeout_s)
    out = latest_state(spark, path, state_keys)
    if watermark:
        out = (out.withColumn("window_start", to_wall_clock(F.col("window_start")))
                  .withColumn("window_end", to_wall_clock(F.col("window_end"))))
    return out


def stream_anomalies(spark: SparkSession, stream: DataFrame, ts: str, keys, measures, *,
                     duration: str, slide: str | None, threshold: float = 1.75, **kw) -> DataFrame:
    """Windows whose max z-score reaches ``threshold``, judged on the latest state of each
    window (a window that stops being anomalous after a later batch is not reported)."""
    st = stream_window_stats(spark, stream, ts, keys, measures, duration=duration, slide=slide, **kw)
    return windows.window_anomalies(st, measures, threshold)


def stream_round_robin(spark: SparkSession, stream: DataFrame, id_col: str, keys: list,
                       out: str = "station", timeout_s: float = 600.0) -> DataFrame:
    """Stateless enrichment of a stream with round-robin keys; appended to a parquet sink."""
    enriched = windows.round_robin_assign(stream, id_col, keys, out)
    path, ckpt = scratch_path(spark, "round-robin"), scratch_path(spark, "round-robin-ckpt")
    run_until_done(append_sink(enriched, path, ckpt), timeout_s)
    return spark.read.parquet(path)


def stream_watermarked_counts(spark: SparkSession, stream: DataFrame, ts: str, *, duration: str,
                              watermark: str, timeout_s: float = 600.0, path: str | None = None,
                              checkpoint: str | None = None) -> DataFrame:
    """Tumbling-window row counts with a watermark: ``window_start, window_end, rows, final``.

    The stream runs in append mode: a window is emitted once, after the watermark passes its
    end, and leaves the state, which stays bounded.  The windows that are still open are read
    from the state store of the last committed batch and united with the emitted ones (``final`` is
    false for them: later rows can still raise their counts).  With ``path`` and ``checkpoint`` of
    an earlier run the stream goes on from there.
    """
    s = to_event_time(stream, ts).withWatermark(ts, watermark)
    counts = (s.groupBy(F.window(ts, duration).alias("window")).agg(F.count(F.lit(1)).alias("rows"))
               .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "rows"))
    path, ckpt = path or scratch_path(spark, "wm-counts"), checkpoint or scratch_path(spark, "wm-counts-ckpt")
    run_until_done(append_sink(counts, path, ckpt), timeout_s)
    emitted = spark.read.schema(counts.schema).parquet(path).withColumn("final", F.lit(True))
    held = open_state(spark, ckpt)
    window, rows = held.schema["key"].dataType.names[0], held.schema["value"].dataType.names[0]
    waiting = held.select(F.col(f"key.{window}.start").alias("window_start"), F.col(f"key.{window}.end").alias("window_end"),
                          F.col(f"value.{rows}").alias("rows"), F.lit(False).alias("final"))
    out = emitted.unionByName(waiting)
    return out.select(to_wall_clock(F.col("window_start")).alias("window_start"),
                      to_wall_clock(F.col("window_end")).alias("window_end"), "rows", "final")
