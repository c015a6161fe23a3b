import os

import pytest
from pyspark.sql import functions as F

from airnet.functions.names import unique_names
from airnet.operators import reshape
from airnet.sources import csv as csvsrc


def test_unique_names_cleaning_and_repeats():
    cells = ["whatever", "RD934", "RD934", "", None, "Place d'Italie", "A B", "A", "A", "A_1"]
    names = unique_names(cells)
    assert names[0] == "datetime"
    assert names[1:3] == ["RD934", "RD934_1"]
    assert names[3:5] == ["col_3", "col_4"]
    assert names[5] == "Place_d_Italie"
    assert names[6] == "A_B"
    assert len(set(names)) == len(names)  # A, A -> A_1, then the real A_1 must not collide
    assert names[7:] == ["A", "A_1", "A_1_1"]


def test_unique_names_raw_variant_keeps_text():
    assert unique_names(["x", " l'a ", "l'a"], clean=False) == ["datetime", "l'a", "l'a_1"]


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_station_csv_roundtrip_and_ingest(spark, tmp_dir):
    rows = "\n".join([
        "Identifiant station;Nom de la Station;Nom de la ligne;Niveau de pollution;Recommandation de surveillance;stop_lon;stop_lat;pollution_air",
        "1;Alpha;1;FAIBLE;r;2.1;48.1;x",
        "1;Alpha;1;FAIBLE;r;2.1;48.1;x",
        "2;Beta;1;ELEVE;r;2.6;48.2;x",
        "3;Gamma;2;station aérienne;r;2.7;48.3;x",
        "4;Delta;2;inconnu;r;2.8;48.4;x",
        "5;Eps;;MOYENNE;r;;48.5;x",
    ])
    st = _write(os.path.join(tmp_dir, "st.csv"), rows + "\n")
    raw = _write(os.path.join(tmp_dir, "pm10.csv"), "\n".join([
        "free text,,", "more text,,", "date,S 1,S'2",
        "2024-01-01 00:00:00Z,1.5,n/d", "2024-01-01 01:00:00,,3", "2024-13-01 99:00:00,4,4", "notadate,5,5"]) + "\n")
    t = csvsrc.read_table_csv(spark, st)
    assert t.count() == 6
    assert dict(t.dtypes)["stop_lon"] == "double"
    out = csvsrc.ingest(spark, {"stations": st, "pm10": raw})
    scored = {r["Nom de la Station"]: r["score_pollution"] for r in out["stations"].collect()}
    # NULL row (Eps) dropped, duplicate dropped, unknown level -> NULL, aerial -> 0
    assert scored == {"Alpha": 1, "Beta": 3, "Gamma": 0, "Delta": None}
    long = {(str(r["datetime"]), r["station"], r["pm10"]) for r in out["pm10"].collect()}
    assert ("2024-01-01 00:00:00", "S_1", 1.5) in long
    assert ("2024-01-01 01:00:00", "S_2", 3.0) in long
    # n/d and empty cells dropped; invalid timestamp kept with NULL time; non-date row dropped
    assert all(v is not None for _, _, v in long)
    assert len([x for x in long if x[0] == "None"]) == 2
    assert len(long) == 4


def test_promote_header_needs_three_rows(spark, tmp_dir):
    raw = _write(os.path.join(tmp_dir, "short.csv"), "a,b\nc,d\n")
    with pytest.raises(ValueError):
        reshape.promote_header(csvsrc.read_raw_csv(spark, raw))


def test_wide_to_long_roundtrip(spark):
    long = spark.createDataFrame(
        [("t1", "a", 1.0), ("t1", "b", 2.0), ("t2", "a", 3.0), ("t2", "l'c", 4.0)], "t string, k string, v double")
    wide = long.groupBy("t").pivot("k").agg(F.first("v"))
    back = reshape.wide_to_long(wide, ["t"], "k", "v")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, long.collect()))


def test_drop_nulls_and_dups(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "b")], "x int, y string")
    assert reshape.drop_nulls(df).count() == 2
    assert reshape.drop_nulls(df, ["x"]).count() == 3
    assert reshape.drop_dups(df).count() == 3
    assert reshape.drop_dups(df, ["x"]).count() == 3


def test_parse_and_filter(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05Z",), ("2024-01-02 03:04:05",), ("junk",), (None,)], "s string")
    kept = reshape.keep_matching(df, "s")
    assert kept.count() == 2
    parsed = [r["s"] for r in reshape.parse_utc(df, "s").collect()]
    assert str(parsed[0]) == "2024-01-02 03:04:05" and parsed[0] == parsed[1]
    assert parsed[2] is None and parsed[3] is None


def test_lines_to_stops(spark):
    df = spark.createDataFrame([("1", ["a", "b", "c"]), ("2", ["c"]), ("3", [])], "line string, stops array<string>")
    stops = reshape.lines_to_stops(df, "line", "stops")
    assert sorted(map(tuple, stops.collect())) == [("1", 0, "a"), ("1", 1, "b"), ("1", 2, "c"), ("2", 0, "c")]
