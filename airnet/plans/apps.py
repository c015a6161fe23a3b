"""End-to-end jobs matching the three applications the library replaces: the station /
sensor analysis, the sensor regression models, and the graph diffusion with one DOT
output per iteration; plus the live anomaly stream.  Each returns DataFrames (or a
running query); nothing is printed or collected."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from airnet.operators import aggregates, anomalies, graph, ml, profile, reshape, sequence, spatial, style, windows
from airnet.sources.csv import STATION_LEVEL_COL, ingest

STATION, LINE, LON, LAT = "Nom de la Station", "Nom de la ligne", "stop_lon", "stop_lat"


def station_report(spark: SparkSession, paths: dict[str, str], *, reference: str,
                   lon_min: float = 2.5, peak_threshold: float = 2.5, outlier_threshold: float = 1.75,
                   rows: int = 24, sided: str = "up", k: int = 20) -> dict[str, DataFrame]:
    """Ingest the station table and the wide sensor files, then every analysis of the
    batch application.  ``paths``: ``stations`` plus one entry per measure (e.g. ``pm10``,
    ``pm25``)."""
    data = ingest(spark, paths)
    st = data["stations"]
    measures = [m for m in paths if m != "stations"]
    out: dict[str, DataFrame] = {"stations": st}
    if len(measures) >= 2:
        joined = data[measures[0]]
        for m in measures[1:]:
            joined = joined.join(data[m], ["datetime", "station"], "full_outer")
        out["measures"] = joined
    for m in measures:
        out[f"{m}_long"] = data[m]
        out[f"{m}_peaks"] = anomalies.rolling_peaks(data[m], "station", ["datetime"], m, rows,
                                                    threshold=peak_threshold, sided=sided)
    out["east_of"] = spatial.filter_range(st, LON, lower=lon_min)
    out["nearest"] = spatial.nearest_points(st.select(F.col(STATION).alias("station"), F.col(LINE).alias("ligne"),
                                                      LON, LAT),
                                            F.col("station") == reference, LON, LAT, k=k, tie=["station", "ligne"])
    out["lines"] = profile.distinct_values(st, LINE)
    out["coordinates"] = profile.describe_columns(st, [LON, LAT])
    out["exposure"] = aggregates.exposure_ranking(st, [STATION, LINE], "score_pollution", k=k)
    out["global_index"] = aggregates.global_index(st, "score_pollution", 3.0)
    out["line_outliers"] = anomalies.group_outliers(st, LINE, "score_pollution", threshold=outlier_threshold)
    return out


def sensor_models(long: DataFrame, measure: str = "pm", *, key: str = "datetime", train_pct: int = 70,
                  k: int = 10) -> dict[str, DataFrame]:
    """Calendar features, feature stages fitted on the training part, linear model,
    decision tree and random forest scored on the test part, metrics and best/worst
    predictions.  The split is a stable hash of ``key`` + station."""
    spark = long.sparkSession
    f = reshape.temporal_parts(long, "datetime", label_from=measure)
    f = f.withColumn("__split_key", F.concat_ws("|", F.col(key).cast("string"), F.col("station")))
    train, test = ml.train_test(f, "__split_key", train_pct)
    fm = ml.fit_features(train)
    tr, te = fm.transform(train), fm.transform(test)
    out: dict[str, DataFrame] = {"features": ml.features_as_array(te)}
    for name, est in (("lr", ml.linear_regression()), ("tree", ml.decision_tree()), ("forest", ml.random_forest())):
        model = est.fit(tr)
        pred = model.transform(te).select("station", "datetime", "label", "prediction")
        out[f"{name}_predictions"] = pred
        out[f"{name}_metrics"] = ml.regression_metrics(pred)
        out[f"{name}_best"] = ml.best_predictions(pred, k, tie=["station", "datetime"])
        out[f"{name}_worst"] = ml.worst_predictions(pred, k, tie=["station", "datetime"])
        if name == "lr":
            out["lr_summary"] = ml.lr_summary(spark, model)
            out["lr_residuals"] = ml.lr_residuals(model, tr).select("station", "datetime", "label", "prediction", "residual")
    return out


def graph_diffusion(lines: DataFrame, stations: DataFrame, out_dir: str | None = None, *, alpha: float = 0.10,
                    steps: int = 5, line_col: str = "line", stops_col: str = "stops",
                    normalize: bool = False) -> dict[str, DataFrame]:
    """Ordered line lists + scored station table -> graph, seeded values, ``steps``
    diffusion snapshots, styling and (with ``out_dir``) one DOT output per iteration
    that has a positive value (``<out_dir>/iter=<k>``)."""
    stops = reshape.lines_to_stops(lines, line_col, stops_col)
    if normalize:
        stops = stops.withColumn("station", graph.normalize_name("station"))
    edges = sequence.sequence_edges(stops, line_col, ["stop_seq"], "station")
    verts = graph.stops_vertices(stops, "station")
    scores = aggregates.key_scores(stations, STATION, "score_pollution", out_key="station")
    seeded = graph.seed_vertices(verts, scores)
    snaps = graph.diffuse(seeded.select("name", "value"), edges, alpha, steps, snapshots=True)
    ids = graph.dense_ids(verts)
    colored = style.node_colors(snaps).join(ids, "name")
    e = style.edge_colors(edges)
    e = (e.join(ids.select(F.col("name").alias("src"), F.col("vertex_id").alias("src_id")), "src")
          .join(ids.select(F.col("name").alias("dst"), F.col("vertex_id").alias("dst_id")), "dst"))
    edge_lines = style.dot_edge_lines(e, src="src_id", dst="dst_id").select(
        F.col("src_id").alias("src"), F.col("dst_id").alias("dst"), "line", "line_text")
    bounds = graph.snapshot_bounds(snaps)
    out = {"edges": edges, "vertices": ids, "seeded": seeded, "mapped": graph.mapped_counts(verts, scores),
           "snapshots": snaps, "bounds": bounds, "node_colors": colored, "edge_lines": edge_lines}
    if out_dir:
        # iterations without any positive value get no file (bounded: steps + 1 rows)
        its = [r["iter"] for r in bounds.where(F.col("max_pos").isNotNull()).select("iter").collect()]
        nodes = style.dot_node_lines(colored, id_col="vertex_id", label="name")
        out["documents"] = style.dot_documents(nodes, edge_lines, sorted(its), "Pollution diffusion - iteration %s")
        style.write_dots(out["documents"], out_dir)
    return out


def stream_alerts(spark: SparkSession, directory: str, out_path: str, checkpoint: str, *, glob: str = "*.parquet",
                  duration: str = "30 seconds", slide: str = "10 seconds", threshold: float = 1.75,
                  watermark: str | None = "10 minutes", measures=("pm10", "pm25"),
                  available_now: bool = False) -> StreamingQuery:
    """Long-running alert stream over sensor files ``(datetime, station, pm10, pm25)``:
    sliding-window statistics per station upserted to ``out_path``; read the alerts with
    ``windows.window_anomalies(streaming.latest_state(...), measures, threshold)``."""
    from airnet.streaming import core
    s = core.to_event_time(core.event_stream(spark, directory, glob), "datetime")
    if watermark:
        s = s.withWatermark("datetime", watermark)
    stats = windows.window_stats(s, "datetime", ["station"], list(measures), duration=duration, slide=slide)
    return core.upsert_sink(stats, out_path, checkpoint, trigger_available_now=available_now,
                            keys=["window_start", "window_end", "station"])


__all__ = ["station_report", "sensor_models", "graph_diffusion", "stream_alerts", "STATION_LEVEL_COL"]
