"""CSV sources of the station table and of the raw wide sensor files."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from airnet.operators.reshape import drop_dups, drop_nulls, ordinal_encode
from airnet.sources.wide_csv import wide_csv_to_long

# ---- fixed values: column layout of the station table ------------------------------------
STATION_SCHEMA = StructType([
    StructField("Identifiant station", StringType(), True),
    StructField("Nom de la Station", StringType(), True),
    StructField("Nom de la ligne", StringType(), True),
    StructField("Niveau de pollution", StringType(), True),
    StructField("Recommandation de surveillance", StringType(), True),
    StructField("stop_lon", DoubleType(), True),
    StructField("stop_lat", DoubleType(), True),
    StructField("pollution_air", StringType(), True),
])
STATION_LEVEL_COL = "Niveau de pollution"
# --------------------------------------------------------------------------------------------


def read_table_csv(spark: SparkSession, path: str, schema: StructType = STATION_SCHEMA,
                   sep: str = ";", header: bool = True) -> DataFrame:
    """Delimited file with a header row and an explicit schema (no inference pass)."""
    return spark.read.schema(schema).option("sep", sep).option("header", header).csv(path)


def read_raw_csv(spark: SparkSession, path: str, sep: str = ",", *, width: int | None = None) -> DataFrame:
    """Header-less delimited file, every column a string ``_c0 .. _cN``.

    The width is that of the widest line, found by one scan of the lines unless ``width`` gives it: a
    short first line (a title) would otherwise narrow the table.
    """
    if width is None:
        bare = F.regexp_replace("value", '"[^"]*"', "")   # separators inside quotes don't count
        cells = F.octet_length(bare) - F.octet_length(F.replace(bare, F.lit(sep), F.lit(""))) + F.lit(len(sep))
        most = spark.read.text(path).agg(F.max(F.floor(cells / len(sep)))).first()[0]
        width = int(most or 1)
    schema = StructType([StructField(f"_c{i}", StringType(), True) for i in range(width)])
    return spark.read.schema(schema).option("sep", sep).option("header", False).csv(path)


def ingest(spark: SparkSession, paths: dict[str, str], *, clean: bool = True,
           level_col: str = STATION_LEVEL_COL) -> dict[str, DataFrame]:
    """Station table (NULL rows and duplicates dropped, scored) plus every wide sensor
    file as a long ``(datetime, station, <name>)`` table; an entry may be a folder of files with
    different headers.

    ``paths``: ``{"stations": ..., "<measure>": ..., ...}``; each non-station entry is a raw
    wide file whose third row holds the station names.
    """
    out: dict[str, DataFrame] = {}
    for name, path in paths.items():
        if name == "stations":
            st = read_table_csv(spark, path)
            if clean:
                st = drop_dups(drop_nulls(st))
            out[name] = ordinal_encode(st, level_col)
        else:
            out[name] = wide_csv_to_long(spark, path, name)
    return out
