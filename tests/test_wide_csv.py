"""Files with their own headers, read as one table."""
import os

import pytest
from pyspark.sql import functions as F

from airnet.sources.csv import ingest, read_raw_csv
from airnet.sources.wide_csv import header_table, read_wide_csv, wide_csv_to_long


@pytest.fixture()
def folder(tmp_dir):
    files = {
        "a.csv": "T\nunits,x,y\nwhatever,Alpha,Beta,Alpha\n2024-01-01 00:00:00Z,1,2,3\n2024-01-01 01:00:00,4,n/d,6\nfooter,9,9,9\n",
        "b.csv": "﻿only a title\n\n   \nx\ntime,Beta,\"Gam,ma\",,Alpha,Extra one\n\"2024-01-02 00:00:00Z\",5,6,7,8,9,10,11\n2024-01-02 01:00:00,12\n"
                 "2024-13-45 00:00:00,1,1,1,1,1\n",
        "c.csv": "﻿t\nu\n﻿d,Zed\n",  # a header and no rows
    }
    for name, text in files.items():
        with open(os.path.join(tmp_dir, name), "w", encoding="utf-8") as f:
            f.write(text)
    return tmp_dir


LONG = {("2024-01-01 00:00:00", "Alpha", 1.0), ("2024-01-01 00:00:00", "Beta", 2.0), ("2024-01-01 00:00:00", "Alpha_1", 3.0),
        ("2024-01-01 01:00:00", "Alpha", 4.0), ("2024-01-01 01:00:00", "Alpha_1", 6.0), ("2024-01-02 00:00:00", "Beta", 5.0),
        ("2024-01-02 00:00:00", "Gam_ma", 6.0), ("2024-01-02 00:00:00", "col_3", 7.0), ("2024-01-02 00:00:00", "Alpha", 8.0),
        ("2024-01-02 00:00:00", "Extra_one", 9.0), ("2024-01-02 01:00:00", "Beta", 12.0)}


def _long(frame):
    rows = frame.select(F.col("datetime").cast("string"), "station", "pm").collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows if r[0] is not None}


def test_each_cell_keeps_its_own_files_name(spark, folder):
    assert _long(wide_csv_to_long(spark, folder)) == LONG


def test_split_files(spark, folder):
    # a file cut into several splits: rows of later splits still meet their header
    with open(os.path.join(folder, "d.csv"), "w") as f:
        f.write("t\nu\nx,P,Q\n" + "".join(f"2024-02-01 00:00:{i % 60:02d},{i},{-i}\n" for i in range(3000)))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.text(folder).rdd.getNumPartitions() > 5
        got = wide_csv_to_long(spark, folder).where("datetime >= '2024-02-01'")
        assert {tuple(r) for r in got.groupBy("station").agg(F.count("*"), F.sum("pm")).collect()} == {
            ("P", 3000, 3000 * 2999 / 2), ("Q", 3000, -3000 * 2999 / 2)}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_joined_by_file_when_headers_are_large(spark, folder, monkeypatch):
    from airnet.sources import wide_csv
    monkeypatch.setattr(wide_csv, "BROADCAST_BYTES", 0)
    assert _long(wide_csv_to_long(spark, folder)) == LONG


def test_wide_frame_is_aligned_by_name(spark, folder):
    wide = read_wide_csv(spark, folder)
    assert wide.columns == ["datetime", "Alpha", "Beta", "Zed", "Gam_ma", "Alpha_1", "col_3", "Extra_one"]
    got = {r["datetime"]: r.asDict() for r in wide.collect()}
    assert got["2024-01-02 00:00:00Z"]["Alpha"] == "8" and got["2024-01-01 01:00:00"]["Beta"] == "n/d"
    assert got["2024-01-02 01:00:00"] == {**dict.fromkeys(wide.columns), "datetime": "2024-01-02 01:00:00", "Beta": "12"}


def test_raw_names_and_row_index(spark, folder):
    rows = header_table(spark, folder, clean=False).collect()
    names = {os.path.basename(r["file"]): r["names"] for r in rows}
    assert names["b.csv"] == ["datetime", "Beta", "Gam,ma", "col_3", "Alpha", "Extra one"] and names["c.csv"] == ["datetime", "Zed"]
    with pytest.raises(ValueError, match="c.csv"):
        header_table(spark, folder, row_index=3)


def test_short_title_keeps_the_columns_of_a_raw_file(spark, folder):
    raw = read_raw_csv(spark, os.path.join(folder, "b.csv"))
    assert len(raw.columns) == 8 and raw.where("_c0 like '2024-01-02 00%'").first()[7] == "11"
    quoted = os.path.join(folder, "q.csv")
    with open(quoted, "w") as f:
        f.write('t\n"a,b",c\n')
    assert [tuple(r) for r in read_raw_csv(spark, quoted).collect()] == [("t", None), ("a,b", "c")]


def test_ingest_reads_folders(spark, folder):
    got = ingest(spark, {"pm": folder})["pm"]
    assert got.columns == ["datetime", "station", "pm"] and _long(got) == LONG


def test_no_files(spark, tmp_dir):
    open(os.path.join(tmp_dir, "e.csv"), "w").close()
    assert wide_csv_to_long(spark, tmp_dir).count() == 0 and read_raw_csv(spark, tmp_dir).count() == 0


def test_cells_are_those_of_from_csv(spark):
    from airnet.sources.wide_csv import split_cells
    lines = ["a,b", ",", "a,,", '"a,b",c', '"a""b",c', '"a,b"c,d', '"a\\"b,c",d', '"",x', ',"",', ' "a,b",c', '"a" ,b', '"x', 'a,"b', ' a , b ', '"b,\\']
    frame = spark.createDataFrame([(x,) for x in lines], "line string")
    for sep in (",", ";", "|"):
        swapped = F.translate("line", ",", sep)
        old = F.from_csv(swapped, "c0 string, c1 string, c2 string, c3 string", {"sep": sep})
        got = frame.select("line", F.array(*[old[f"c{i}"] for i in range(4)]).alias("old"),
                           F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.get(split_cells(swapped, sep), i)).alias("new"))
        assert [(r["line"], r["new"]) for r in got.collect()] == [(r["line"], r["old"]) for r in got.collect()]


def test_files_wider_than_a_plan_can_be(spark, tmp_dir):
    n = 30_000
    with open(os.path.join(tmp_dir, "w.csv"), "w") as f:
        f.write("t\nu\n" + ",".join(["time", *(f"S{i}" for i in range(n))]) + "\n")
        for start in ("2024-01-01 00:00:00Z", '"2024-01-01 01:00:00Z"'):
            f.write(",".join([start, *map(str, range(n))]) + "\n")
    long = wide_csv_to_long(spark, tmp_dir)
    assert tuple(long.agg(F.count("*"), F.sum("pm"), F.countDistinct("station")).first()) == (2 * n, n * (n - 1.0), n)
    assert not long.where(F.concat(F.lit("S"), F.col("pm").cast("int")) != F.col("station")).count()


def test_one_file_for_each_bucket(spark):
    from airnet.plans.csv_queries import _wide_files, _write_files
    text = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(9_999)), lambda i: F.md5(F.concat_ws("|", "id", i))), "")
    head = spark.range(60).groupBy((F.col("id") % 20).alias("bucket")).agg(F.max(text).alias("line"))   # more than one partition of them
    parts = head.select("bucket", F.lit(1).alias("seq"), F.concat("line", F.col("bucket").cast("string")).alias("line")).unionByName(
        head.select("bucket", F.lit(0).alias("seq"), F.lit("t").alias("line")))
    read = spark.read.text(_write_files(parts, "test")).groupBy("bucket").agg(F.countDistinct(F.col("_metadata.file_path")).alias("files"), F.count("*"))
    assert {tuple(r)[1:] for r in read.collect()} == {(1, 2)}

    cells = spark.createDataFrame([(0, "2024-01-01 00:00:00", "b", "1"), (0, "2024-01-01 01:00:00", "a", "2"), (0, "2024-01-01 01:00:00", "d", "3"),
                                   (0, "2024-01-01 02:00:00", "c", None), (1, "2024-01-02 00:00:00", "z", "4")],
                                  "bucket int, t string, name string, text string")
    path = _wide_files(cells, cells.select("bucket", "name", F.col("name").alias("place")).distinct(), "test")
    lines = spark.read.text(path).where("bucket = 0")
    assert [r["value"] for r in lines.collect()] == [
        "Title", "unit,-", "time,a,b,c,d", "2024-01-01 00:00:00Z,n/d,1,n/d,n/d", "2024-01-01 01:00:00Z,2,n/d,n/d,3", "2024-01-01 02:00:00Z,n/d,n/d,n/d,n/d"]
