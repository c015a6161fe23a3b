"""Queries over CSV files: the tables are first written as the files such a job receives."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airnet.plans.queries import EVENT_TYPES, _events
from airnet.plans.registry import register, r6, rsql
from airnet.session import scratch_path
from airnet.sources import csv as csv_source
from airnet.sources import wide_csv
from airnet.sources.tables import load_table


def _write_files(lines: DataFrame, label: str) -> str:
    """One text file per ``bucket``, its ``line`` s in the order of ``seq``.

    Dealt by a hash of its own: a union of parts that are each dealt by ``bucket`` already would not be dealt
    again, and parts that are then coalesced apart leave a bucket's lines in several files.
    """
    path = scratch_path(lines.sparkSession, label)
    (lines.repartition(F.xxhash64("bucket")).sortWithinPartitions("bucket", "seq").select("bucket", F.col("line").alias("value"))
     .write.partitionBy("bucket").text(path))
    return path


def _wide_files(cells: DataFrame, names: DataFrame, label: str) -> str:
    """Files of wide rows.  ``cells``: bucket, t, name, text; ``names``: bucket, name, place (its column).
    Each file has a short title, an empty second row, its header and a row per time; cells that are missing say n/d."""
    header = names.groupBy("bucket").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "name"))), lambda x: x["name"]).alias("names"))
    at = header.select("bucket", F.posexplode("names").alias("i", "name"))
    named = F.coalesce("name", F.raise_error(F.lit("a cell without a column name")))  # the join would lose it
    rows = cells.withColumn("name", named).join(at, ["bucket", "name"]).groupBy("bucket", "t").agg(F.array_sort(F.collect_list(F.struct("i", "text"))).alias("m"))

    def missing(start, end):  # the cells from one column to the one before another
        return F.repeat(F.lit(",n/d"), (end - start).cast("int"))

    filled = F.transform("m", lambda x, j: F.concat(missing(F.coalesce(F.get("m", j - 1)["i"] + 1, F.lit(0)), x["i"]), F.lit(","),
                                                    F.coalesce(x["text"], F.lit("n/d"))))
    rest = missing(F.element_at("m", -1)["i"] + 1, F.col("width"))
    body = rows.join(header.select("bucket", F.size("names").alias("width")), "bucket").select(
        "bucket", F.concat(F.lit("2"), F.col("t")).alias("seq"), F.concat(F.col("t"), F.lit("Z"), F.array_join(filled, ""), rest).alias("line"))
    top = header.select("bucket", F.explode(F.array(
        F.struct(F.lit("0").alias("seq"), F.lit("Title").alias("line")), F.struct(F.lit("10").alias("seq"), F.lit("unit,-").alias("line")),
        F.struct(F.lit("11").alias("seq"), F.concat_ws(",", F.lit("time"), "names").alias("line")))).alias("x")).select("bucket", "x.*")
    return _write_files(body.unionByName(top), label)


def _daily_files(spark, sf) -> str:
    """Daily means of each event type, four files whose columns stand in different orders."""
    day = F.date_trunc("day", "ts")
    cells = _events(spark, sf).groupBy((F.dayofyear("ts") % 4).alias("bucket"), day.alias("day"), F.col("event_type").alias("name")).agg(
        F.avg("value").cast("string").alias("text"))
    names = cells.select("bucket", "name").distinct().withColumn("place", F.md5(F.concat_ws("|", "bucket", "name")))
    return _wide_files(cells.withColumn("t", F.date_format("day", "yyyy-MM-dd HH:mm:ss")), names, "csv-daily")


@register("csv_wide_to_long", f"""
SELECT day, event_type, {rsql('avg(value)')} AS value
FROM (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_type, value FROM events)
GROUP BY day, event_type
""")
def q_csv_wide_to_long(spark, sf):
    long = wide_csv.wide_csv_to_long(spark, _daily_files(spark, sf), "value", time_col="day", var_name="event_type")
    return long.select("day", "event_type", r6("value").alias("value"))


@register("csv_promote_header", "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, " + ", ".join(
    f"{rsql(f'avg(value) FILTER (WHERE event_type = {t!r})')} AS {t}" for t in EVENT_TYPES) + " FROM events GROUP BY 1")
def q_csv_promote_header(spark, sf):
    """The same files as one wide frame, aligned by name."""
    wide = wide_csv.read_wide_csv(spark, _daily_files(spark, sf), first="day")
    return wide.select(F.try_to_timestamp(F.regexp_replace("day", "Z$", ""), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz").alias("day"),
                       *[r6(F.col(t).try_cast("double")).alias(t) for t in EVENT_TYPES])


def _hourly_files(spark, sf, kind: str) -> str:
    """Hourly maxima of each user for one event type: a file per day, with the users of that day only."""
    cells = (_events(spark, sf).where(F.col("event_type") == kind)
             .groupBy(F.date_format("ts", "yyyyMMdd").alias("bucket"), F.date_trunc("hour", "ts").alias("h"),
                      F.concat(F.lit("User "), "user_id").alias("name")).agg(F.max("value").cast("string").alias("text")))
    names = cells.select("bucket", "name").distinct().withColumn("place", F.md5(F.concat_ws("|", "bucket", "name")))
    return _wide_files(cells.withColumn("t", F.date_format("h", "yyyy-MM-dd HH:mm:ss")), names, f"csv-{kind}")


_HOURLY_SQL = """(SELECT date_trunc('hour', ts) AS datetime, 'User_' || user_id AS station, max(value) AS v
   FROM events WHERE event_type = '{}' GROUP BY 1, 2)"""


def _station_files(spark, sf) -> str:
    """Customers as a station table: cells missing, rows repeated."""
    c = load_table(spark, sf, "customer")
    key = F.col("c_custkey")
    level = F.element_at(F.array(*map(F.lit, ["FAIBLE", "MOYENNE", "ELEVE", "unknown"])), (key % 4 + 1).cast("int"))
    rows = c.select(key.cast("string"), F.col("c_name"), F.when(key % 7 != 0, F.col("c_mktsegment")), level, F.lit("none"),
                    F.col("c_acctbal"), (F.col("c_acctbal") / 2), F.lit("air")).toDF(*csv_source.STATION_SCHEMA.names)
    path = scratch_path(spark, "csv-stations")
    rows.unionByName(rows.where(F.col("Identifiant station").cast("int") % 5 == 0)).write.option("sep", ";").option("header", True).csv(path)
    return path


@register("csv_station_table", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS line, c_acctbal AS lon, c_acctbal / 2 AS lat,
       CASE c_custkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 END AS score
FROM customer WHERE c_custkey % 7 <> 0
""")
def q_csv_station_table(spark, sf):
    """The station part of an ingest: rows with NULLs and repeated rows go, levels are scored."""
    st = csv_source.ingest(spark, {"stations": _station_files(spark, sf)})["stations"]
    return st.select(F.col("Identifiant station").alias("id"), F.col("Nom de la Station").alias("name"), F.col("Nom de la ligne").alias("line"),
                     F.col("stop_lon").alias("lon"), F.col("stop_lat").alias("lat"), F.col("score_pollution").alias("score"))


@register("csv_ingest_measures", f"""
SELECT datetime, station, a.v AS pm10, b.v AS pm25
FROM {_HOURLY_SQL.format('view')} a FULL OUTER JOIN {_HOURLY_SQL.format('click')} b USING (datetime, station)
""")
def q_csv_ingest_measures(spark, sf):
    """Ingest of a station table and two folders of wide files, the measures joined."""
    from airnet.operators import joins
    data = csv_source.ingest(spark, {"stations": _station_files(spark, sf), "pm10": _hourly_files(spark, sf, "view"),
                                     "pm25": _hourly_files(spark, sf, "click")})
    return joins.full_outer_measures(data["pm10"], data["pm25"], ["datetime", "station"]).select("datetime", "station", "pm10", "pm25")


def _header_files(spark, sf) -> str:
    """Fifty files with headers of order priorities: repeated, empty and unsafe names."""
    o = load_table(spark, sf, "orders").select((F.col("o_custkey") % 50).alias("bucket"), F.col("o_orderkey").alias("place"),
                                               F.when(F.col("o_orderstatus") == "P", F.lit("  ")).otherwise(F.concat(F.lit(" "), "o_orderpriority")).alias("cell"))
    header = o.groupBy("bucket").agg(F.concat_ws(",", F.lit("time"), F.transform(
        F.array_sort(F.collect_list(F.struct("place", "cell"))), lambda x: x["cell"])).alias("line"))
    lines = header.select("bucket", F.lit(2).alias("seq"), "line").unionByName(
        header.select("bucket", F.explode(F.array(F.lit(0), F.lit(1))).alias("seq"), F.lit("t").alias("line")))
    return _write_files(lines, "csv-headers-in")


def _names_sql(clean: bool) -> str:
    cell = "regexp_replace(o_orderpriority, '[^A-Za-z0-9_-]', '_', 'g')" if clean else "o_orderpriority"
    return f"""
WITH o AS (SELECT o_custkey % 50 AS bucket, o_orderstatus, o_orderpriority,
                  row_number() OVER (PARTITION BY o_custkey % 50 ORDER BY o_orderkey) AS place FROM orders),
b AS (SELECT bucket, place, CASE WHEN o_orderstatus = 'P' THEN 'col_' || place ELSE {cell} END AS base FROM o),
n AS (SELECT bucket, place, base, row_number() OVER (PARTITION BY bucket, base ORDER BY place) - 1 AS n FROM b)
SELECT CAST(bucket AS INTEGER) AS bucket, CAST(place AS INTEGER) AS place, base || CASE WHEN n > 0 THEN '_' || n ELSE '' END AS name FROM n
UNION ALL SELECT DISTINCT CAST(bucket AS INTEGER), 0, 'datetime' FROM b
"""


def _header_names(spark, sf, clean: bool) -> DataFrame:
    headers = wide_csv.header_table(spark, _header_files(spark, sf), clean=clean)
    return headers.select(F.regexp_extract("file", r"bucket=(\d+)", 1).cast("int").alias("bucket"),
                          F.posexplode("names").alias("place", "name"))


@register("csv_header_names", _names_sql(True))
def q_csv_header_names(spark, sf):
    return _header_names(spark, sf, True)


@register("csv_header_names_raw", _names_sql(False))
def q_csv_header_names_raw(spark, sf):
    return _header_names(spark, sf, False)


@register("csv_raw_rename", "SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderstatus AS status, o_orderpriority AS priority FROM orders")
def q_csv_raw_rename(spark, sf):
    """Header-less files behind a one-cell title: all columns as strings, renamed by position."""
    o = load_table(spark, sf, "orders").select((F.col("o_orderkey") % 16).alias("bucket"), F.col("o_orderkey").cast("long").alias("seq"), F.concat_ws(
        ",", F.col("o_orderkey"), "o_orderstatus", F.concat(F.lit('"'), "o_orderpriority", F.lit('"'))).alias("line"))
    titles = o.select("bucket").distinct().select("bucket", F.lit(-1).cast("long").alias("seq"), F.lit('"Orders, all"').alias("line"))
    raw = csv_source.read_raw_csv(spark, _write_files(o.unionByName(titles), "csv-raw") + "/bucket=*")
    return raw.toDF("key", "status", "priority").where(F.col("key").rlike("^[0-9]+$"))
