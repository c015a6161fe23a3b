import os

from pyspark.sql import functions as F

from airnet.plans import apps

STATIONS = """Identifiant station;Nom de la Station;Nom de la ligne;Niveau de pollution;Recommandation de surveillance;stop_lon;stop_lat;pollution_air
1;Cergy Préfecture;1;FAIBLE;r;2.03;49.03;x
2;Nation;1;ELEVE;r;2.39;48.84;x
3;Gare du Nord;2;MOYENNE;r;2.35;48.88;x
4;Champs-Elysees;2;station aérienne;r;2.31;48.86;x
5;Bastille;1;FAIBLE;r;2.36;48.85;x
5;Bastille;1;FAIBLE;r;2.36;48.85;x
7;Vincennes;1;FAIBLE;r;2.44;48.84;x
8;Opera;2;FAIBLE;r;2.33;48.87;x
9;Louvre;1;FAIBLE;r;2.34;48.86;x
"""


def _wide(name, seed):
    head = ["text,,,", "text,,,", f"date,Nation,Bastille,Opera"]
    rows = []
    for h in range(60):
        base = 20 + (h * seed) % 7
        spike = 400 if h == 45 else 0
        rows.append(f"2024-01-0{1 + h // 24} {h % 24:02d}:00:00Z,{base + spike},{base + 1},{'n/d' if h % 10 == 0 else base}")
    return "\n".join(head + rows) + "\n"


def test_station_report_and_models(spark, tmp_dir):
    paths = {}
    for name, text in (("stations", STATIONS), ("pm10", _wide("pm10", 3)), ("pm25", _wide("pm25", 5))):
        paths[name] = os.path.join(tmp_dir, f"{name}.csv")
        with open(paths[name], "w", encoding="utf-8") as f:
            f.write(text)
    rep = apps.station_report(spark, paths, reference="Cergy Préfecture")
    assert rep["stations"].count() == 8  # duplicate row dropped
    assert rep["measures"].count() == 180 - 6
    peaks = rep["pm10_peaks"].collect()
    assert [(r["station"], r["datetime"].hour) for r in peaks] == [("Nation", 21)]
    near = [r["station"] for r in rep["nearest"].collect()]
    assert near[0] == "Cergy Préfecture" and len(near) == 8
    assert rep["global_index"].first()["score_mean"] == sum([1, 3, 2, 0, 1, 1, 1, 1]) / 8
    assert {r["Nom de la Station"] for r in rep["line_outliers"].collect()} == {"Nation"}
    models = apps.sensor_models(rep["pm10_long"], "pm10")
    assert models["lr_metrics"].first()["rows"] == models["lr_predictions"].count() > 0
    assert models["forest_worst"].count() == 10


def test_graph_diffusion_job(spark, tmp_dir):
    st = spark.createDataFrame([("Nation", 3), ("Bastille", 1), ("Nowhere", 2)],
                               "`Nom de la Station` string, score_pollution int")
    lines = spark.createDataFrame([("1", ["Nation", "Bastille", "Louvre"]), ("2", ["Opera", "Louvre"])],
                                  "line string, stops array<string>")
    out_dir = os.path.join(tmp_dir, "dot")
    res = apps.graph_diffusion(lines, st, out_dir, alpha=0.1, steps=2)
    assert res["mapped"].first()["mapped"] == 2
    assert sorted(os.listdir(out_dir)) == ["iter=0", "iter=1", "iter=2"]
    last = res["snapshots"].where(F.col("iter") == 2)
    assert last.where(F.col("value") > 0).count() == 4  # Opera reached after two steps


def test_stream_alerts_job(spark, tmp_dir):
    from airnet import streaming
    from airnet.operators import windows
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    sensors = ev.select(F.col("ts").alias("datetime"), F.concat(F.lit("S"), (F.col("user_id") % 3).cast("string")).alias("station"),
                        F.col("value").alias("pm10"), (F.col("value") / 2).alias("pm25"))
    src = os.path.join(tmp_dir, "in")
    sensors.coalesce(1).write.parquet(src)
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    q = apps.stream_alerts(spark, src, out, ck, duration="1 day", slide="12 hours", watermark=None, available_now=True)
    streaming.run_until_done(q, 300)
    state = streaming.latest_state(spark, out, ["window_start", "window_end", "station"])
    batch = windows.window_stats(sensors, "datetime", ["station"], ["pm10", "pm25"], duration="1 day", slide="12 hours")
    assert state.count() == batch.count()
    alerts = windows.window_anomalies(state, ["pm10", "pm25"], 1.75)
    assert 0 < alerts.count() <= state.count()
