"""Registered queries over the driver tables (see SURVEY §7.4 for the domain mapping).

Mapping: sensor series = ``events`` (key ``user_id``, time ``ts``, measure ``value``),
station table = ``orders`` / ``customer`` / ``part``, category = ``o_orderpriority``,
line sequences = ``lineitem`` (line ``l_orderkey``, position ``l_linenumber``,
station ``l_partkey``), point coordinates = ``part (p_size, p_retailprice)``.
"""
from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from airnet import streaming
from airnet.functions.columns import EDGE_PALETTE
from airnet.operators import (
    aggregates, anomalies, graph, joins, ml, profile, reshape, sequence, spatial, style, windows,
)
from airnet.plans.registry import register, r6, rsql
from airnet.session import materialize
from airnet.sources.tables import load_table

EV_KEY, EV_ORDER = "user_id", ["ts", "event_id"]


def _events(spark, sf):
    return load_table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")


# --------------------------------------------------------------------------- rolling (W1-W3)
_ROLL_WINDOW = ("window w AS (PARTITION BY user_id ORDER BY ts, event_id "
                "ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)")


@register("rolling_stats", f"""
SELECT user_id, event_id, ts, value,
       {rsql('avg(value) OVER w')} AS value_mean,
       {rsql('stddev_pop(value) OVER w')} AS value_std
FROM events {_ROLL_WINDOW}
""")
def q_rolling_stats(spark, sf):
    ev = _events(spark, sf).select("user_id", "event_id", "ts", "value")
    out = anomalies.rolling_stats(ev, EV_KEY, EV_ORDER, "value", 24)
    return out.select("user_id", "event_id", "ts", "value",
                      r6("value_mean").alias("value_mean"), r6("value_std").alias("value_std"))


_Z_SQL = ("(value - avg(value) OVER w) / nullif(stddev_pop(value) OVER w, 0)")


@register("rolling_zscore", f"""
SELECT user_id, event_id, ts, value, {rsql(_Z_SQL)} AS value_zscore
FROM events {_ROLL_WINDOW}
""")
def q_rolling_zscore(spark, sf):
    ev = _events(spark, sf).select("user_id", "event_id", "ts", "value")
    out = anomalies.rolling_zscore(ev, EV_KEY, EV_ORDER, "value", 24)
    return out.select("user_id", "event_id", "ts", "value", r6("value_zscore").alias("value_zscore"))


@register("rolling_peaks", f"""
SELECT user_id, event_id, ts, value, {rsql('m')} AS value_mean, {rsql('s')} AS value_std,
       {rsql('z')} AS value_zscore
FROM (SELECT *, (value - m) / nullif(s, 0) AS z FROM (
        SELECT user_id, event_id, ts, value, avg(value) OVER w AS m, stddev_pop(value) OVER w AS s
        FROM events {_ROLL_WINDOW}))
WHERE s > 0 AND z >= 2.5
""")
def q_rolling_peaks(spark, sf):
    ev = _events(spark, sf).select("user_id", "event_id", "ts", "value")
    out = anomalies.rolling_peaks(ev, EV_KEY, EV_ORDER, "value", 24, threshold=2.5, sided="up")
    return out.select("user_id", "event_id", "ts", "value", r6("value_mean").alias("value_mean"),
                      r6("value_std").alias("value_std"), r6("value_zscore").alias("value_zscore"))


@register("rolling_peaks_two_sided", f"""
SELECT user_id, event_id, ts, neg_value, {rsql('z')} AS neg_value_zscore
FROM (SELECT *, (neg_value - m) / nullif(s, 0) AS z FROM (
        SELECT user_id, event_id, ts, -value AS neg_value,
               avg(-value) OVER w AS m, stddev_pop(-value) OVER w AS s
        FROM events {_ROLL_WINDOW}))
WHERE s > 0 AND abs(z) >= 2.5
""")
def q_rolling_peaks_two_sided(spark, sf):
    # Test values are right-skewed (no low peaks): mirror them so the two-sided test bites.
    ev = _events(spark, sf).select("user_id", "event_id", "ts", (-F.col("value")).alias("neg_value"))
    out = anomalies.rolling_peaks(ev, EV_KEY, EV_ORDER, "neg_value", 24, threshold=2.5, sided="both")
    return out.select("user_id", "event_id", "ts", "neg_value",
                      r6("neg_value_zscore").alias("neg_value_zscore"))


def _peaks_top50(value: str, sided: str):
    """The report of the 50 strongest peaks; ties go by key and order."""
    score = "abs(z)" if sided == "both" else "z"
    sql = f"""
SELECT user_id, event_id, ts, v AS peak, {rsql('z')} AS peak_zscore
FROM (SELECT *, (v - m) / nullif(s, 0) AS z FROM (
        SELECT user_id, event_id, ts, {value} AS v, avg({value}) OVER w AS m, stddev_pop({value}) OVER w AS s
        FROM events {_ROLL_WINDOW}))
WHERE s > 0 AND {score} >= 2.5
ORDER BY round({score}, 9) DESC, user_id, ts, event_id LIMIT 50
"""

    def query(spark, sf):
        ev = _events(spark, sf).select("user_id", "event_id", "ts", F.expr(value).alias("peak"))
        out = anomalies.rolling_peaks(ev, EV_KEY, EV_ORDER, "peak", 24, threshold=2.5, sided=sided, limit=50)
        return out.select("user_id", "event_id", "ts", "peak", r6("peak_zscore").alias("peak_zscore"))
    return sql, query


for _name, _value, _sided in (("rolling_peaks_top50", "value", "up"), ("rolling_peaks_two_sided_top50", "-value", "both")):
    _sql, _top50 = _peaks_top50(_value, _sided)
    register(_name, _sql)(_top50)


# --------------------------------------------------------------------------- cleaning (C1-C4)


def _events_with_nulls(spark, sf):
    """events with NULLs injected from the data itself: ``event_type`` NULL for errors,
    ``value`` NULL for cheap views (the driver tables hold no NULLs)."""
    ev = _events(spark, sf)
    return ev.select(
        "event_id", "ts", "user_id",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"),
        F.when(~((F.col("event_type") == "view") & (F.col("value") < 5.0)), F.col("value")).alias("value"))


_EV_NULLS_SQL = """(SELECT event_id, ts, user_id, nullif(event_type, 'error') AS event_type,
        CASE WHEN event_type = 'view' AND value < 5.0 THEN NULL ELSE value END AS value
   FROM events)"""


@register("clean_rows", f"""
SELECT * FROM {_EV_NULLS_SQL}
WHERE event_id IS NOT NULL AND ts IS NOT NULL AND user_id IS NOT NULL
  AND event_type IS NOT NULL AND value IS NOT NULL
""")
def q_clean_rows(spark, sf):
    return reshape.drop_nulls(_events_with_nulls(spark, sf))


@register("clean_rows_subset", f"SELECT * FROM {_EV_NULLS_SQL} WHERE value IS NOT NULL")
def q_clean_rows_subset(spark, sf):
    return reshape.drop_nulls(_events_with_nulls(spark, sf), ["value"])


@register("dedup_rows", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def q_dedup_rows(spark, sf):
    li = load_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return reshape.drop_dups(li)


@register("dedup_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY l_orderkey, l_linenumber
""")
def q_dedup_keys(spark, sf):
    # duplicate census by key: how many copies each kept row had
    li = load_table(spark, sf, "lineitem")
    return li.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("copies"))


@register("dedup_keys_first", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice, l_partkey) = 1
""")
def q_dedup_keys_first(spark, sf):
    """Of the rows that share a key the one of the least price stays."""
    li = load_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return reshape.drop_dups(li, ["l_orderkey", "l_linenumber"], order=["l_extendedprice"])


@register("profile_nulls", f"""
SELECT 'event_id' AS "column", avg(CASE WHEN event_id IS NULL THEN 1.0 ELSE 0.0 END) AS null_fraction, count(*) AS rows FROM {_EV_NULLS_SQL}
UNION ALL SELECT 'ts', avg(CASE WHEN ts IS NULL THEN 1.0 ELSE 0.0 END), count(*) FROM {_EV_NULLS_SQL}
UNION ALL SELECT 'user_id', avg(CASE WHEN user_id IS NULL THEN 1.0 ELSE 0.0 END), count(*) FROM {_EV_NULLS_SQL}
UNION ALL SELECT 'event_type', avg(CASE WHEN event_type IS NULL THEN 1.0 ELSE 0.0 END), count(*) FROM {_EV_NULLS_SQL}
UNION ALL SELECT 'value', avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END), count(*) FROM {_EV_NULLS_SQL}
""")
def q_profile_nulls(spark, sf):
    return profile.profile_nulls(_events_with_nulls(spark, sf))


def _documents_profiled(spark, sf):
    d = load_table(spark, sf, "documents")
    return d.select("doc_id", "n_chars", F.length("text").cast("long").alias("text_chars"),
                    "lang", "source", F.concat_ws("", "lang", "source").alias("lang_source"))


_DOCS_SQL = """(SELECT doc_id, n_chars, CAST(length(text) AS BIGINT) AS text_chars, lang, source,
        concat_ws('', lang, source) AS lang_source FROM documents)"""


def _pairs_sql(pairs):
    return "\nUNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, bool_and({a} IS NOT DISTINCT FROM {b}) AS equal FROM {_DOCS_SQL}"
        for a, b in pairs)


@register("profile_equal_columns", _pairs_sql(
    [("doc_id", "n_chars"), ("doc_id", "text_chars"), ("n_chars", "text_chars"),
     ("lang", "source"), ("lang", "lang_source"), ("source", "lang_source")]))
def q_profile_equal_columns(spark, sf):
    return profile.profile_equal_columns(_documents_profiled(spark, sf))


@register("profile_concat_columns", "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{a}' AS part_a, '{b}' AS part_b, "
    f"bool_and({c} IS NOT DISTINCT FROM concat_ws('', {a}, {b})) AS is_concat FROM {_DOCS_SQL}"
    for c, a, b in [("lang", "source", "lang_source"), ("lang", "lang_source", "source"),
                    ("source", "lang", "lang_source"), ("source", "lang_source", "lang"),
                    ("lang_source", "lang", "source"), ("lang_source", "source", "lang")]))
def q_profile_concat_columns(spark, sf):
    return profile.profile_concat_columns(
        _documents_profiled(spark, sf).select("lang", "source", "lang_source"))


_WIDE = 48


@register("profile_wide_table", f"""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem)
SELECT 'equal' AS kind, 'm' || i || ', m' || j AS columns FROM range({_WIDE}) a(i), range({_WIDE}) b(j) WHERE i < j AND i % 40 = j % 40
UNION ALL SELECT 'concat', 'key = l_orderkey, l_linenumber' FROM t HAVING bool_and(l_orderkey || '-' || l_linenumber = concat_ws('-', l_orderkey, l_linenumber))
""")
def q_profile_wide_table(spark, sf):
    """A table of 51 number columns, some of them equal, one a key made of two others with a separator."""
    li = load_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key"),
        *[((F.col("l_partkey") * (i % 40 + 2) + F.col("l_linenumber") * (i % 40)) % 997).alias(f"m{i}") for i in range(_WIDE)])
    equal = profile.profile_equal_columns(li).where("equal").select(F.lit("equal").alias("kind"), F.concat_ws(", ", "column_a", "column_b").alias("columns"))
    made = profile.profile_concat_columns(li, sep="-", numbers=True, only_true=True).select(
        F.lit("concat").alias("kind"), F.concat("column", F.lit(" = "), F.concat_ws(", ", "part_a", "part_b")).alias("columns"))
    return equal.unionByName(made)


# --------------------------------------------------------------------------- parsing (C7, C9, C10)
def _ts_text(spark, sf):
    """A text column mixing ``yyyy-MM-dd HH:mm:ssZ`` stamps with non-date text (props)."""
    ev = load_table(spark, sf, "events")
    txt = F.when(F.col("event_type") == "error", F.col("props")).otherwise(
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("Z")))
    return ev.select("event_id", "event_type", txt.alias("datetime"))


_TS_TEXT_SQL = """(SELECT event_id, event_type,
        CASE WHEN event_type = 'error' THEN props ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') || 'Z' END AS datetime
   FROM events)"""


@register("regex_filter", f"""
SELECT event_id, event_type FROM {_TS_TEXT_SQL} WHERE regexp_matches(datetime, '^\\d{{4}}-\\d{{2}}-\\d{{2}}')
""")
def q_regex_filter(spark, sf):
    return reshape.keep_matching(_ts_text(spark, sf), "datetime").select("event_id", "event_type")


@register("parse_timestamp", f"""
SELECT event_id, try_strptime(regexp_replace(datetime, 'Z$', ''), '%Y-%m-%d %H:%M:%S') AS datetime
FROM {_TS_TEXT_SQL}
""")
def q_parse_timestamp(spark, sf):
    return reshape.parse_utc(_ts_text(spark, sf), "datetime").select("event_id", "datetime")


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@register("wide_to_long", f"""
SELECT day, event_type, {rsql('avg(value)')} AS value
FROM (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_type, value FROM events)
GROUP BY day, event_type
""")
def q_wide_to_long(spark, sf):
    ev = _events(spark, sf)
    wide = (ev.withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz")).groupBy("day")
              .pivot("event_type", EVENT_TYPES).agg(F.avg("value")))
    long = reshape.wide_to_long(wide, ["day"], "event_type", "value")
    return long.select("day", "event_type", r6("value").alias("value"))


_PRIORITY_SQL = """CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '2-HIGH' THEN 3
        WHEN '4-NOT SPECIFIED' THEN 0 ELSE NULL END"""
# Ordinal levels used on the order table (same shape as the pollution levels: three
# graded levels, one level scored 0, anything else unscored).
PRIORITY_LEVELS = {"5-LOW": 1, "3-MEDIUM": 2, "2-HIGH": 3, "4-NOT SPECIFIED": 0}


def _scored_orders(spark, sf):
    o = load_table(spark, sf, "orders")
    return reshape.ordinal_encode(o, "o_orderpriority", PRIORITY_LEVELS, "score")


@register("ordinal_encode", f"""
SELECT o_orderkey, o_orderpriority, CAST({_PRIORITY_SQL} AS INTEGER) AS score FROM orders
""")
def q_ordinal_encode(spark, sf):
    return _scored_orders(spark, sf).select("o_orderkey", "o_orderpriority", "score")


@register("temporal_parts", """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(dayofweek(ts) + 1 AS INTEGER) AS "dayOfWeek",
       CAST(month(ts) AS INTEGER) AS month, CAST(value AS DOUBLE) AS label
FROM events
""")
def q_temporal_parts(spark, sf):
    out = reshape.temporal_parts(_events(spark, sf), "ts", label_from="value")
    return out.select("event_id", "hour", "dayOfWeek", "month", "label")


# --------------------------------------------------------------------------- P1-P3, P7, A1-A6
@register("filter_range", "SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_retailprice > 950")
def q_filter_range(spark, sf):
    p = load_table(spark, sf, "part")
    return spatial.filter_range(p, "p_retailprice", lower=950).select("p_partkey", "p_name", "p_retailprice")


@register("nearest_points", f"""
WITH ref AS (SELECT p_size AS x0, p_retailprice AS y0 FROM part WHERE p_name = 'red widget'
             ORDER BY p_partkey LIMIT 1)
SELECT p_partkey, p_name, p_size, p_retailprice,
       {rsql('sqrt((p_size - x0) * (p_size - x0) + (p_retailprice - y0) * (p_retailprice - y0))')} AS distance
FROM part, ref
ORDER BY sqrt((p_size - x0) * (p_size - x0) + (p_retailprice - y0) * (p_retailprice - y0)), p_partkey
LIMIT 20
""")
def q_nearest_points(spark, sf):
    p = load_table(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    out = spatial.nearest_points(p, F.col("p_name") == "red widget", "p_size", "p_retailprice",
                                 k=20, tie=["p_partkey"])
    return out.select("p_partkey", "p_name", "p_size", "p_retailprice", r6("distance").alias("distance"))


@register("distinct_values", "SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL")
def q_distinct_values(spark, sf):
    return profile.distinct_values(load_table(spark, sf, "customer"), "c_mktsegment")


@register("describe_columns", f"""
SELECT {rsql('avg(p_size)')} AS p_size_avg, min(p_size) AS p_size_min, max(p_size) AS p_size_max,
       {rsql('avg(p_retailprice)')} AS p_retailprice_avg, min(p_retailprice) AS p_retailprice_min,
       max(p_retailprice) AS p_retailprice_max
FROM part
""")
def q_describe_columns(spark, sf):
    out = profile.describe_columns(load_table(spark, sf, "part"), ["p_size", "p_retailprice"])
    return out.select(r6("p_size_avg").alias("p_size_avg"), "p_size_min", "p_size_max",
                      r6("p_retailprice_avg").alias("p_retailprice_avg"),
                      "p_retailprice_min", "p_retailprice_max")


@register("exposure_ranking", f"""
SELECT o_custkey, o_orderstatus, {rsql('avg(s)')} AS score_mean, max(s) AS score_max
FROM (SELECT o_custkey, o_orderstatus, CAST({_PRIORITY_SQL} AS INTEGER) AS s FROM orders)
GROUP BY o_custkey, o_orderstatus
ORDER BY avg(s) DESC NULLS LAST, max(s) DESC NULLS LAST, o_custkey, o_orderstatus
LIMIT 20
""")
def q_exposure_ranking(spark, sf):
    out = aggregates.exposure_ranking(_scored_orders(spark, sf), ["o_custkey", "o_orderstatus"], "score", k=20)
    return out.select("o_custkey", "o_orderstatus", r6("score_mean").alias("score_mean"), "score_max")


@register("global_index", f"""
SELECT {rsql('avg(s)')} AS score_mean, {rsql('avg(s) / 3.0 * 100.0')} AS index_0_100
FROM (SELECT CAST({_PRIORITY_SQL} AS INTEGER) AS s FROM orders)
""")
def q_global_index(spark, sf):
    out = aggregates.global_index(_scored_orders(spark, sf), "score", 3.0)
    return out.select(r6("score_mean").alias("score_mean"), r6("index_0_100").alias("index_0_100"))


@register("key_scores", f"""
SELECT o_custkey AS station, {rsql('avg(s)')} AS score
FROM (SELECT o_custkey, CAST({_PRIORITY_SQL} AS INTEGER) AS s FROM orders)
GROUP BY o_custkey HAVING avg(s) IS NOT NULL
""")
def q_key_scores(spark, sf):
    out = aggregates.key_scores(_scored_orders(spark, sf), "o_custkey", "score", out_key="station")
    return out.select("station", r6("score").alias("score"))


# --------------------------------------------------------------------------- J2 / A4 / P9
_GZ_SQL = """(SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, g.m, g.s,
        (o.o_totalprice - g.m) / nullif(g.s, 0) AS z
   FROM orders o JOIN (SELECT o_custkey, avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS s
                       FROM orders GROUP BY o_custkey) g ON o.o_custkey = g.o_custkey)"""


@register("group_zscore", f"""
SELECT o_orderkey, o_custkey, o_totalprice, {rsql('m')} AS group_mean, {rsql('s')} AS group_std,
       {rsql('z')} AS z_score
FROM {_GZ_SQL}
""")
def q_group_zscore(spark, sf):
    o = load_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    out = anomalies.group_zscore(o, "o_custkey", "o_totalprice")
    return out.select("o_orderkey", "o_custkey", "o_totalprice", r6("group_mean").alias("group_mean"),
                      r6("group_std").alias("group_std"), r6("z_score").alias("z_score"))


@register("group_outliers", f"""
SELECT o_orderkey, o_custkey, o_totalprice, {rsql('z')} AS z_score FROM {_GZ_SQL} WHERE z > 1.5
""")
def q_group_outliers(spark, sf):
    o = load_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    out = anomalies.group_outliers(o, "o_custkey", "o_totalprice", threshold=1.5)
    return out.select("o_orderkey", "o_custkey", "o_totalprice", r6("z_score").alias("z_score"))


# --------------------------------------------------------------------------- J1
def _hourly(ev, kind, name):
    return (ev.where(F.col("event_type") == kind)
              .groupBy(F.date_trunc("hour", "ts").alias("hour"), "user_id")
              .agg(F.avg("value").alias(name)))


@register("full_outer_measures", f"""
WITH v AS (SELECT date_trunc('hour', ts) AS hour, user_id, avg(value) AS view_value
           FROM events WHERE event_type = 'view' GROUP BY 1, 2),
     c AS (SELECT date_trunc('hour', ts) AS hour, user_id, avg(value) AS click_value
           FROM events WHERE event_type = 'click' GROUP BY 1, 2)
SELECT hour, user_id, {rsql('view_value')} AS view_value, {rsql('click_value')} AS click_value
FROM v FULL OUTER JOIN c USING (hour, user_id)
""")
def q_full_outer_measures(spark, sf):
    ev = _events(spark, sf)
    out = joins.full_outer_measures(_hourly(ev, "view", "view_value"), _hourly(ev, "click", "click_value"),
                                    ["hour", "user_id"])
    return out.select(F.col("hour").cast("timestamp_ntz").alias("hour"), "user_id",
                      r6("view_value").alias("view_value"), r6("click_value").alias("click_value"))


# --------------------------------------------------------------------------- sliding windows
WIN_DURATION, WIN_SLIDE = "6 hours", "2 hours"


def _sensor_frame(spark, sf):
    """events as a two-measure sensor series: ``value`` and the ``k`` number of props."""
    ev = load_table(spark, sf, "events")
    return ev.select("ts", "event_type", "value",
                     F.get_json_object("props", "$.k").try_cast("double").alias("k"))


def _win_stats_sql(where: str = "") -> str:
    return f"""
WITH ev AS (SELECT ts, event_type, value, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events),
     w AS (SELECT time_bucket(INTERVAL 2 HOUR, ts) - INTERVAL 2 HOUR * o AS window_start, event_type, value, k
           FROM ev, (SELECT unnest([0, 1, 2]) AS o) offs),
     g AS (SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, event_type,
                  avg(value) AS vm, stddev_pop(value) AS vs, max(value) AS vx,
                  avg(k) AS km, stddev_pop(k) AS ks, max(k) AS kx
           FROM w GROUP BY window_start, event_type),
     z AS (SELECT *, CASE WHEN vs > 0 THEN (vx - vm) / vs ELSE 0.0 END AS vz,
                     CASE WHEN ks > 0 THEN (kx - km) / ks ELSE 0.0 END AS kz FROM g)
SELECT window_start, window_end, event_type,
       {rsql('vm')} AS value_mean, {rsql('vs')} AS value_std, vx AS value_max, {rsql('vz')} AS value_zscore,
       {rsql('km')} AS k_mean, {rsql('ks')} AS k_std, kx AS k_max, {rsql('kz')} AS k_zscore
FROM z {where}"""


def _round_window_stats(out):
    return out.select("window_start", "window_end", "event_type",
                      r6("value_mean").alias("value_mean"), r6("value_std").alias("value_std"), "value_max",
                      r6("value_zscore").alias("value_zscore"), r6("k_mean").alias("k_mean"),
                      r6("k_std").alias("k_std"), "k_max", r6("k_zscore").alias("k_zscore"))


@register("window_stats", _win_stats_sql())
def q_window_stats(spark, sf):
    out = windows.window_stats(_sensor_frame(spark, sf), "ts", ["event_type"], ["value", "k"],
                               duration=WIN_DURATION, slide=WIN_SLIDE)
    return _round_window_stats(out)


@register("window_anomalies", _win_stats_sql("WHERE vz >= 1.75 OR kz >= 1.75"))
def q_window_anomalies(spark, sf):
    st = windows.window_stats(_sensor_frame(spark, sf), "ts", ["event_type"], ["value", "k"],
                              duration=WIN_DURATION, slide=WIN_SLIDE)
    return _round_window_stats(windows.window_anomalies(st, ["value", "k"], 1.75))


_RR_SQL = """
WITH keys AS (SELECT c_name, CAST(row_number() OVER (ORDER BY c_name) - 1 AS INTEGER) AS idx
              FROM (SELECT DISTINCT c_name FROM customer WHERE c_name IS NOT NULL) ORDER BY c_name LIMIT 20),
     n AS (SELECT count(*) AS n FROM keys)
SELECT e.event_id, k.c_name AS station
FROM events e, n JOIN keys k ON k.idx = CAST(e.event_id % n.n AS INTEGER)
"""


@register("round_robin_assign", _RR_SQL)
def q_round_robin_assign(spark, sf):
    keys = profile.bounded_keys(load_table(spark, sf, "customer"), "c_name", 20)
    ev = load_table(spark, sf, "events").select("event_id")
    return windows.round_robin_assign(ev, "event_id", keys, "station")


# --------------------------------------------------------------------------- graph (S5, W4, W5, G1-G7)

ALPHA, STEPS = 0.10, 5


@register("explode_sequence", """
SELECT doc_id AS line, CAST(generate_subscripts(stops, 1) - 1 AS INTEGER) AS stop_seq, unnest(stops) AS station
FROM (SELECT doc_id, string_split(text, ' ') AS stops FROM documents)
""")
def q_explode_sequence(spark, sf):
    # each document is a "line" whose ordered "stops" are its space-separated words
    d = load_table(spark, sf, "documents").select(F.col("doc_id").alias("line"),
                                                  F.split("text", " ").alias("stops"))
    return reshape.lines_to_stops(d, "line", "stops")


def _stops(spark, sf):
    return load_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")


def _edges(spark, sf):
    return sequence.sequence_edges(_stops(spark, sf), "l_orderkey", ["l_linenumber", "l_partkey"],
                                   "l_partkey")


_EDGES_SQL = """(SELECT src, dst, line FROM (
    SELECT lag(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS src,
           l_partkey AS dst, l_orderkey AS line FROM lineitem) WHERE src IS NOT NULL)"""
_VERTS_SQL = "(SELECT DISTINCT l_partkey AS name FROM lineitem WHERE l_partkey IS NOT NULL)"
# Levels of the graph's stations: brands 1 to 20; any other brand has no score.
STATION_LEVELS = {f"Brand#{i}": i for i in range(1, 21)}
_SCORES_SQL = """(SELECT p_partkey AS station, CAST(avg(level) AS DOUBLE) AS score
    FROM (SELECT p_partkey, CAST(substr(p_brand, 7) AS INTEGER) AS level FROM part) WHERE level <= 20 GROUP BY p_partkey)"""
_SEED_SQL = f"""(SELECT v.name, coalesce(s.score, 0.0) AS value, s.score IS NOT NULL AS observed
    FROM {_VERTS_SQL} v LEFT JOIN {_SCORES_SQL} s ON v.name = s.station)"""


@register("sequence_edges", f"SELECT * FROM {_EDGES_SQL}")
def q_sequence_edges(spark, sf):
    return _edges(spark, sf)


@register("graph_vertices", f"SELECT * FROM {_VERTS_SQL}")
def q_graph_vertices(spark, sf):
    return graph.stops_vertices(_stops(spark, sf), "l_partkey")


@register("dense_ids", f"SELECT CAST(dense_rank() OVER (ORDER BY name) - 1 AS BIGINT) AS vertex_id, name FROM {_VERTS_SQL}")
def q_dense_ids(spark, sf):
    return graph.dense_ids(graph.stops_vertices(_stops(spark, sf), "l_partkey"))


def _scores(spark, sf):
    p = reshape.ordinal_encode(load_table(spark, sf, "part"), "p_brand", STATION_LEVELS, "level")
    return aggregates.key_scores(p, "p_partkey", "level", out_key="station")


def _seeded(spark, sf):
    return graph.seed_vertices(graph.stops_vertices(_stops(spark, sf), "l_partkey"), _scores(spark, sf))


@register("seed_vertices", f"SELECT * FROM {_SEED_SQL}")
def q_seed_vertices(spark, sf):
    return _seeded(spark, sf)


@register("mapped_counts", f"""
SELECT count(*) AS scored, count(v.name) AS mapped FROM {_SCORES_SQL} s LEFT JOIN {_VERTS_SQL} v ON s.station = v.name
""")
def q_mapped_counts(spark, sf):
    return graph.mapped_counts(graph.stops_vertices(_stops(spark, sf), "l_partkey"), _scores(spark, sf))


def _diffusion_ctes(steps: int = STEPS, alpha: float = ALPHA) -> str:
    ctes = [f"sym AS (SELECT src, dst FROM {_EDGES_SQL} UNION ALL SELECT dst, src FROM {_EDGES_SQL})",
            f"s0 AS (SELECT name, value FROM {_SEED_SQL})"]
    for k in range(steps):
        ctes.append(f"""s{k + 1} AS (SELECT s.name, s.value + {alpha} * coalesce(m.msg, 0.0) AS value
    FROM s{k} s LEFT JOIN (SELECT sym.dst, sum(p.value) AS msg FROM sym JOIN s{k} p ON sym.src = p.name
                           GROUP BY sym.dst) m ON s.name = m.dst)""")
    snaps = " UNION ALL ".join(f"SELECT name, value, {k} AS iter FROM s{k}" for k in range(steps + 1))
    ctes.append(f"snaps AS ({snaps})")
    return "WITH " + ",\n".join(ctes)


def _snapshots(spark, sf):
    return graph.diffuse(_seeded(spark, sf).select("name", "value"), _edges(spark, sf),
                         alpha=ALPHA, steps=STEPS, snapshots=True)


@register("diffuse_1", _diffusion_ctes(1) + f"\nSELECT name, {rsql('value')} AS value FROM s1")
def q_diffuse_1(spark, sf):
    out = graph.diffuse(_seeded(spark, sf).select("name", "value"), _edges(spark, sf), alpha=ALPHA, steps=1)
    return out.select("name", r6("value").alias("value"))


@register("diffuse_k", _diffusion_ctes() + f"\nSELECT name, {rsql('value')} AS value FROM s{STEPS}")
def q_diffuse_k(spark, sf):
    out = graph.diffuse(_seeded(spark, sf).select("name", "value"), _edges(spark, sf), alpha=ALPHA, steps=STEPS)
    return out.select("name", r6("value").alias("value"))


@register("diffuse_snapshots", _diffusion_ctes() + f"\nSELECT name, iter, {rsql('value')} AS value FROM snaps")
def q_diffuse_snapshots(spark, sf):
    return _snapshots(spark, sf).select("name", F.col("iter").cast("int").alias("iter"), r6("value").alias("value"))


_BOUNDS_SQL = """(SELECT iter, min(value) FILTER (WHERE value > 0) AS min_pos,
                         max(value) FILTER (WHERE value > 0) AS max_pos FROM snaps GROUP BY iter)"""


@register("snapshot_bounds", _diffusion_ctes() + f"""
SELECT CAST(iter AS INTEGER) AS iter, {rsql('min_pos')} AS min_pos, {rsql('max_pos')} AS max_pos FROM {_BOUNDS_SQL}
""")
def q_snapshot_bounds(spark, sf):
    out = graph.snapshot_bounds(_snapshots(spark, sf))
    return out.select(F.col("iter").cast("int").alias("iter"), r6("min_pos").alias("min_pos"),
                      r6("max_pos").alias("max_pos"))


_SCALED_SQL = f"""(SELECT s.name, s.iter, s.value,
    coalesce(greatest(0.0, least(1.0, CASE WHEN b.max_pos = b.min_pos THEN 0.0
                                           ELSE (s.value - b.min_pos) / (b.max_pos - b.min_pos) END)), 0.0) AS r
    FROM snaps s LEFT JOIN {_BOUNDS_SQL} b ON s.iter = b.iter)"""


@register("minmax_scale", _diffusion_ctes() + f"""
SELECT name, CAST(iter AS INTEGER) AS iter, {rsql('r')} AS scaled FROM {_SCALED_SQL}
""")
def q_minmax_scale(spark, sf):
    out = style.minmax_scale(_snapshots(spark, sf))
    return out.select("name", F.col("iter").cast("int").alias("iter"), r6("scaled").alias("scaled"))


_COLOR_SQL = """CASE WHEN value <= 0 THEN '#DDDDDD'
     ELSE printf('#%02x%02x00', CAST(trunc(255.0 * r) AS INTEGER), CAST(trunc(255.0 * (1.0 - r)) AS INTEGER)) END"""


@register("node_colors", _diffusion_ctes() + f"""
SELECT name, CAST(iter AS INTEGER) AS iter, {_COLOR_SQL} AS color FROM {_SCALED_SQL}
""")
def q_node_colors(spark, sf):
    out = style.node_colors(_snapshots(spark, sf))
    return out.select("name", F.col("iter").cast("int").alias("iter"), "color")


_PALETTE_SQL = "[" + ", ".join(f"'{c}'" for c in EDGE_PALETTE) + "]"
_LINE_COLOR_SQL = f"""CASE WHEN TRY_CAST(split_part(CAST(line AS VARCHAR), '_', 1) AS INTEGER) >= 1
     THEN list_element({_PALETTE_SQL}, CAST((TRY_CAST(split_part(CAST(line AS VARCHAR), '_', 1) AS INTEGER) - 1) % 20 + 1 AS INTEGER))
     ELSE '#000000' END"""


@register("edge_colors", f"SELECT src, dst, line, {_LINE_COLOR_SQL} AS color FROM {_EDGES_SQL}")
def q_edge_colors(spark, sf):
    return style.edge_colors(_edges(spark, sf))


_IDS_SQL = f"(SELECT CAST(dense_rank() OVER (ORDER BY name) - 1 AS BIGINT) AS vertex_id, name FROM {_VERTS_SQL})"


_NODE_LINES_SQL = f"""(SELECT c.iter, i.vertex_id, '  ' || CAST(i.vertex_id AS VARCHAR) || ' [label="'
        || replace(CAST(c.name AS VARCHAR), '"', '\'\'') || '", fillcolor="' || c.color || '"];' AS line
    FROM (SELECT name, iter, {_COLOR_SQL} AS color FROM {_SCALED_SQL}) c JOIN {_IDS_SQL} i ON i.name = c.name)"""


def _node_lines(spark, sf):
    nodes = style.node_colors(_snapshots(spark, sf)).join(graph.dense_ids(graph.stops_vertices(_stops(spark, sf), "l_partkey")), "name")
    return style.dot_node_lines(nodes, id_col="vertex_id", label="name")


@register("dot_node_lines", _diffusion_ctes() + f"\nSELECT CAST(iter AS INTEGER) AS iter, vertex_id, line FROM {_NODE_LINES_SQL}")
def q_dot_node_lines(spark, sf):
    return _node_lines(spark, sf).select(F.col("iter").cast("int").alias("iter"), "vertex_id", "line")


@register("dot_edge_lines", f"""
SELECT '  ' || CAST(a.vertex_id AS VARCHAR) || ' -- ' || CAST(b.vertex_id AS VARCHAR) || ' [color="'
       || {_LINE_COLOR_SQL} || '", label="' || CAST(e.line AS VARCHAR) || '"];' AS line_text
FROM {_EDGES_SQL} e JOIN {_IDS_SQL} a ON a.name = e.src JOIN {_IDS_SQL} b ON b.name = e.dst
""")
def q_dot_edge_lines(spark, sf):
    return _edge_lines(spark, sf).select("line_text")


def _edge_lines(spark, sf, written: bool = False):
    ids = graph.dense_ids(graph.stops_vertices(_stops(spark, sf), "l_partkey"))
    e = (_edges(spark, sf).join(ids.select(F.col("name").alias("src"), F.col("vertex_id").alias("src_id")), "src")
         .join(ids.select(F.col("name").alias("dst"), F.col("vertex_id").alias("dst_id")), "dst"))
    if written:
        e = materialize(e.select("src_id", "dst_id", "line"), "edges")
    e = style.edge_colors(e)  # after the joins, which need not move it
    return style.dot_edge_lines(e, src="src_id", dst="dst_id").select(F.col("src_id").alias("src"), F.col("dst_id").alias("dst"), "line", "line_text")


_DOT_TITLE = "Diffusion - iteration %s"
_DOT_FRAME_SQL = " UNION ALL ".join(
    f"SELECT {0 if i < len(style.DOT_HEADER) else 3} AS section, {i} AS k1, "
    + ("replace('" + h.replace("'", "''") + "', '%s', replace('" + _DOT_TITLE + "', '%s', CAST(iter AS VARCHAR)))") + " AS value, iter FROM its"
    for i, h in enumerate([*style.DOT_HEADER, style.DOT_FOOTER]))


@register("dot_document", _diffusion_ctes() + f""",
its AS (SELECT unnest(range({STEPS + 1})) AS iter),
e AS (SELECT a.vertex_id AS k1, b.vertex_id AS k2, CAST(e.line AS VARCHAR) AS k3,
             '  ' || CAST(a.vertex_id AS VARCHAR) || ' -- ' || CAST(b.vertex_id AS VARCHAR) || ' [color="'
             || {_LINE_COLOR_SQL} || '", label="' || CAST(e.line AS VARCHAR) || '"];' AS value
      FROM {_EDGES_SQL} e JOIN {_IDS_SQL} a ON a.name = e.src JOIN {_IDS_SQL} b ON b.name = e.dst),
doc AS (SELECT iter, section, k1, 0 AS k2, '' AS k3, value FROM ({_DOT_FRAME_SQL})
        UNION ALL SELECT iter, 1, vertex_id, 0, '', line FROM {_NODE_LINES_SQL}
        UNION ALL SELECT its.iter, 2, k1, k2, k3, value FROM e, its)
SELECT CAST(iter AS INTEGER) AS iter, row_number() OVER (PARTITION BY iter ORDER BY section, k1, k2, k3) - 1 AS line_no, value FROM doc
""")
def q_dot_document(spark, sf):
    """One ordered document per iteration.  The edges are written first: a sort by range reads its rows twice."""
    docs = style.dot_documents(_node_lines(spark, sf), _edge_lines(spark, sf, written=True), list(range(STEPS + 1)), _DOT_TITLE)
    return docs.select(F.col("iter").cast("int").alias("iter"), F.col("line_no").cast("long").alias("line_no"), "value")


# --------------------------------------------------------------------------- streaming (S7, S8, ST1-ST8)


def _sensor_stream(spark, sf):
    ev = streaming.event_stream(spark, sf, "events.parquet")
    return ev.select("ts", "event_type", "value",
                     F.get_json_object("props", "$.k").try_cast("double").alias("k"))


@register("stream_window_stats", _win_stats_sql())
def q_stream_window_stats(spark, sf):
    out = streaming.stream_window_stats(spark, _sensor_stream(spark, sf), "ts", ["event_type"], ["value", "k"],
                                        duration=WIN_DURATION, slide=WIN_SLIDE)
    return _round_window_stats(out)


@register("stream_anomalies", _win_stats_sql("WHERE vz >= 1.75 OR kz >= 1.75"))
def q_stream_anomalies(spark, sf):
    out = streaming.stream_anomalies(spark, _sensor_stream(spark, sf), "ts", ["event_type"], ["value", "k"],
                                     duration=WIN_DURATION, slide=WIN_SLIDE, threshold=1.75)
    return _round_window_stats(out)


@register("stream_round_robin", _RR_SQL)
def q_stream_round_robin(spark, sf):
    keys = profile.bounded_keys(load_table(spark, sf, "customer"), "c_name", 20)
    ev = streaming.event_stream(spark, sf, "events.parquet").select("event_id")
    return streaming.stream_round_robin(spark, ev, "event_id", keys, "station")


@register("stream_watermarked_counts", """
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS rows
FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start FROM events)
GROUP BY window_start
""")
def q_stream_watermarked_counts(spark, sf):
    """Every window, the open ones included."""
    ev = streaming.event_stream(spark, sf, "events.parquet").select("ts")
    out = streaming.stream_watermarked_counts(spark, ev, "ts", duration="1 hour", watermark="10 minutes")
    return out.select("window_start", "window_end", "rows")


@register("stream_window_stats_bounded", _win_stats_sql())
def q_stream_window_stats_bounded(spark, sf):
    """The same statistics with a watermark, so that the state stays bounded."""
    out = streaming.stream_window_stats(spark, _sensor_stream(spark, sf), "ts", ["event_type"], ["value", "k"],
                                        duration=WIN_DURATION, slide=WIN_SLIDE, watermark="10 minutes")
    return _round_window_stats(out)


# --------------------------------------------------------------------------- ML (P14, ML1-ML14)


def _feature_frame(spark, sf):
    """events as the sensor feature frame: station = event_type, label = value."""
    ev = _events(spark, sf).select("event_id", F.col("ts").alias("datetime"),
                                   F.col("event_type").alias("station"), "value")
    return reshape.temporal_parts(ev, "datetime", label_from="value").drop("value")


_SPLIT_SQL = "CASE WHEN CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 70 THEN 'train' ELSE 'test' END"
_INDEX_SQL = """(SELECT event_type, CAST(row_number() OVER (ORDER BY n DESC, event_type) - 1 AS DOUBLE) AS idx
   FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type))"""


def _r6_array(col):
    return F.transform(F.col(col), lambda x: F.round(x + F.lit(1e-9), 6))


@register("hash_split", f"SELECT event_id, {_SPLIT_SQL} AS split FROM events")
def q_hash_split(spark, sf):
    return ml.hash_split(_events(spark, sf).select("event_id"), "event_id", 70)


@register("ml_string_index", f"""
SELECT e.event_id, e.event_type AS station, r.idx AS "stationIndex" FROM events e JOIN {_INDEX_SQL} r USING (event_type)
""")
def q_ml_string_index(spark, sf):
    f = _feature_frame(spark, sf)
    out = StringIndexer(inputCol="station", outputCol="stationIndex").fit(f).transform(f)
    return out.select("event_id", "station", "stationIndex")


@register("ml_one_hot", f"""
SELECT e.event_id, e.event_type AS station,
       list_transform(range((SELECT count(DISTINCT event_type) FROM events) - 1),
                      lambda i: CAST(CASE WHEN i = r.idx THEN 1.0 ELSE 0.0 END AS DOUBLE)) AS "stationVec"
FROM events e JOIN {_INDEX_SQL} r USING (event_type)
""")
def q_ml_one_hot(spark, sf):
    f = _feature_frame(spark, sf)
    stages = ml.feature_stages("station", [], handle_invalid="error")[:2]
    out = Pipeline(stages=stages).fit(f).transform(f)
    return out.select("event_id", "station", ml.vector_to_array("stationVec").alias("stationVec"))


@register("ml_scaled", f"""
SELECT event_id, {rsql('hour(ts) / (SELECT stddev_samp(hour(ts)) FROM events)')} AS "hourScaled" FROM events
""")
def q_ml_scaled(spark, sf):
    f = _feature_frame(spark, sf)
    stages = ml.feature_stages("station", ["hour"])[2:4]
    out = Pipeline(stages=stages).fit(f).transform(f)
    return out.select("event_id", r6(ml.vector_to_array("hourScaled")[0]).alias("hourScaled"))


_FEATURES_SQL = f"""
WITH sd AS (SELECT stddev_samp(hour(ts)) AS h, stddev_samp(dayofweek(ts) + 1) AS d, stddev_samp(month(ts)) AS m FROM events),
     n AS (SELECT count(DISTINCT event_type) AS k FROM events)
SELECT e.event_id,
       list_transform(list_concat(
           [CASE WHEN sd.h > 0 THEN hour(e.ts) / sd.h ELSE 0.0 END,
            CASE WHEN sd.d > 0 THEN (dayofweek(e.ts) + 1) / sd.d ELSE 0.0 END,
            CASE WHEN sd.m > 0 THEN month(e.ts) / sd.m ELSE 0.0 END],
           list_transform(range(n.k), lambda i: CASE WHEN i = r.idx THEN 1.0 ELSE 0.0 END)),
         lambda x: round(x + 1e-9, 6)) AS features_dense
FROM events e JOIN {_INDEX_SQL} r USING (event_type), sd, n
"""


@register("ml_features", _FEATURES_SQL)
def q_ml_features(spark, sf):
    f = _feature_frame(spark, sf)
    out = ml.features_as_array(ml.fit_features(f).transform(f))
    return out.select("event_id", _r6_array("features_dense").alias("features_dense"))


@register("ml_lr_ols", f"""
SELECT {rsql('regr_slope(value, hour(ts))')} AS slope, {rsql('regr_intercept(value, hour(ts))')} AS intercept,
       {rsql('regr_r2(value, hour(ts))')} AS r2
FROM events
""")
def q_ml_lr_ols(spark, sf):
    f = VectorAssembler(inputCols=["hour"], outputCol="features").transform(_feature_frame(spark, sf))
    m = ml.linear_regression(max_iter=100, reg=0.0, elastic_net=0.0, solver="normal").fit(f)
    s = ml.lr_summary(spark, m)
    return s.select(r6(F.col("coefficients")[0]).alias("slope"), r6("intercept").alias("intercept"),
                    r6("r2").alias("r2"))


def _fitted_split(spark, sf):
    f = _feature_frame(spark, sf)
    train, test = ml.train_test(f, "event_id", 70)
    fm = ml.fit_features(train)
    return fm.transform(train), fm.transform(test)


@register("ml_lr_elastic")
def q_ml_lr_elastic(spark, sf):
    train, test = _fitted_split(spark, sf)
    m = ml.linear_regression(10, 0.3, 0.8).fit(train)
    return m.transform(test).select("event_id", "station", "datetime", "label", "prediction")


@register("ml_lr_summary_full")
def q_ml_lr_summary_full(spark, sf):
    train, _ = _fitted_split(spark, sf)
    return ml.lr_summary(spark, ml.linear_regression(10, 0.3, 0.8).fit(train))


def _elastic_sql(reg: float, alpha: float) -> str:
    return f"""(SELECT *, my - coefficient * mx AS intercept,
        sy * sy - 2 * coefficient * cov + coefficient * coefficient * sx * sx AS mse FROM (
    SELECT *, sign(corr) * greatest(abs(corr) - {reg} * {alpha} / sy, 0) / (1 + {reg} * (1 - {alpha}) / sy) * sy / sx AS coefficient FROM (
        SELECT avg(hour(ts)) AS mx, avg(value) AS my, stddev_pop(hour(ts)) AS sx, stddev_pop(value) AS sy,
               covar_pop(value, hour(ts)) AS cov, corr(value, hour(ts)) AS corr, count(*) AS rows FROM events)))"""


def _hour_model(spark, sf, reg: float, alpha: float):
    f = VectorAssembler(inputCols=["hour"], outputCol="features").transform(_feature_frame(spark, sf))
    return f, ml.linear_regression(200, reg, alpha, tol=1e-13).fit(f)


@register("ml_lr_elastic_one", f"""
SELECT 'closed' AS form, {rsql('coefficient', 5)} AS coefficient, {rsql('intercept', 4)} AS intercept FROM {_elastic_sql(0.3, 0.8)}
UNION ALL SELECT 'fitted', {rsql('coefficient', 5)}, {rsql('intercept', 4)} FROM {_elastic_sql(0.3, 0.8)}
""")
def q_ml_lr_elastic_one(spark, sf):
    """The elastic net of one feature: in closed form, and as MLlib fits it."""
    closed = ml.elastic_net_one(_feature_frame(spark, sf), "hour", "label", 0.3, 0.8).select("coefficient", "intercept")
    _, model = _hour_model(spark, sf, 0.3, 0.8)
    fitted = ml.lr_summary(spark, model).select(F.col("coefficients")[0].alias("coefficient"), "intercept")
    both = closed.withColumn("form", F.lit("closed")).unionByName(fitted.withColumn("form", F.lit("fitted")))
    return both.select("form", r6("coefficient", 5).alias("coefficient"), r6("intercept", 4).alias("intercept"))


@register("ml_lr_summary", f"""
SELECT {rsql('coefficient', 5)} AS coefficient, {rsql('intercept', 4)} AS intercept, {rsql('sqrt(mse)', 5)} AS rmse,
       {rsql('1 - mse / (sy * sy)', 5)} AS r2 FROM {_elastic_sql(0.3, 0.8)}
""")
def q_ml_lr_summary(spark, sf):
    _, model = _hour_model(spark, sf, 0.3, 0.8)
    s = ml.lr_summary(spark, model)
    return s.select(r6(F.col("coefficients")[0], 5).alias("coefficient"), r6("intercept", 4).alias("intercept"),
                    r6("rmse", 5).alias("rmse"), r6("r2", 5).alias("r2"))


@register("ml_lr_residuals", f"""
SELECT event_id, label, {rsql('b + a * h', 5)} AS prediction, {rsql('label - (b + a * h)', 5)} AS residual
FROM (SELECT event_id, value AS label, hour(ts) AS h FROM events),
     (SELECT regr_slope(value, hour(ts)) AS a, regr_intercept(value, hour(ts)) AS b FROM events)
""")
def q_ml_lr_residuals(spark, sf):
    f, model = _hour_model(spark, sf, 0.0, 0.0)
    out = ml.lr_residuals(model, f)
    return out.select("event_id", "label", r6("prediction", 5).alias("prediction"), r6("residual", 5).alias("residual"))


# the best split of one feature: the threshold with the largest fall of the squared error, the least of equals
_STUMP_SQL = f"""
WITH tr AS (SELECT hour(ts) AS h, value AS y FROM events WHERE {_SPLIT_SQL} = 'train'),
     g AS (SELECT h, count(*) AS n, sum(y) AS s FROM tr GROUP BY h),
     c AS (SELECT h, sum(n) OVER w AS nl, sum(s) OVER w AS sl FROM g WINDOW w AS (ORDER BY h)),
     t AS (SELECT count(*) AS n, sum(y) AS s FROM tr),
     b AS (SELECT h, sl / nl AS left_mean, (t.s - sl) / (t.n - nl) AS right_mean FROM c, t WHERE t.n > nl
           ORDER BY sl * sl / nl + (t.s - sl) * (t.s - sl) / (t.n - nl) DESC, h LIMIT 1)
SELECT e.event_id, e.value AS label, {rsql('CASE WHEN hour(e.ts) <= b.h THEN left_mean ELSE right_mean END')} AS prediction
FROM events e, b WHERE {_SPLIT_SQL} = 'test'
"""


def _hour_split(spark, sf):
    train, test = ml.train_test(_feature_frame(spark, sf), "event_id", 70)
    hour = VectorAssembler(inputCols=["hour"], outputCol="features")
    return hour.transform(train), hour.transform(test)


@register("ml_tree_one_split", _STUMP_SQL)
def q_ml_tree_one_split(spark, sf):
    train, test = _hour_split(spark, sf)
    out = ml.decision_tree(max_depth=1).fit(train).transform(test)
    return out.select("event_id", "label", r6("prediction").alias("prediction"))


@register("ml_forest_one_tree", _STUMP_SQL)
def q_ml_forest_one_tree(spark, sf):
    """A forest of one tree without bagging is the tree."""
    train, test = _hour_split(spark, sf)
    out = ml.random_forest(1, bootstrap=False, max_depth=1).fit(train).transform(test)
    return out.select("event_id", "label", r6("prediction").alias("prediction"))


@register("category_index", """
SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS part, idx AS "partIndex"
FROM lineitem JOIN (SELECT l_partkey, CAST(row_number() OVER (ORDER BY n DESC, CAST(l_partkey AS VARCHAR)) - 1 AS DOUBLE) AS idx
                    FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey)) USING (l_partkey)
""")
def q_category_index(spark, sf):
    """Categories indexed by frequency as a table, joined back; no label list on the driver."""
    li = load_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"))
    return ml.index_categories(li, ml.category_index(li, "part"), "part").select("l_orderkey", "l_linenumber", "part", "partIndex")


@register("ml_tree")
def q_ml_tree(spark, sf):
    train, test = _fitted_split(spark, sf)
    m = ml.decision_tree().fit(train)
    return m.transform(test).select("event_id", "station", "datetime", "label", "prediction")


@register("ml_forest")
def q_ml_forest(spark, sf):
    train, test = _fitted_split(spark, sf)
    m = ml.random_forest(50).fit(train)
    return m.transform(test).select("event_id", "station", "datetime", "label", "prediction")


@register("ml_lr_worst_predictions")
def q_ml_lr_worst_predictions(spark, sf):
    train, test = _fitted_split(spark, sf)
    pred = ml.linear_regression(10, 0.3, 0.8).fit(train).transform(test)
    return ml.worst_predictions(pred.select("event_id", "station", "datetime", "label", "prediction"),
                                10, tie=["event_id"])


_GM_PRED_SQL = f"""(SELECT t.event_id, t.station, t.label, coalesce(g.m, a.m) AS prediction
   FROM (SELECT event_id, event_type AS station, value AS label FROM events WHERE {_SPLIT_SQL} = 'test') t
   LEFT JOIN (SELECT event_type AS station, avg(value) AS m FROM events WHERE {_SPLIT_SQL} = 'train'
              GROUP BY event_type) g USING (station),
   (SELECT avg(value) AS m FROM events WHERE {_SPLIT_SQL} = 'train') a)"""


def _gm_predictions(spark, sf):
    f = _feature_frame(spark, sf).select("event_id", "station", "label")
    train, test = ml.train_test(f, "event_id", 70)
    return ml.group_mean_predictor(train, test, "station")


@register("regression_metrics", f"""
SELECT {rsql('sqrt(avg((prediction - label) * (prediction - label)))')} AS rmse,
       {rsql('1 - sum((prediction - label) * (prediction - label)) / (sum(label * label) - sum(label) * sum(label) / count(*))')} AS r2,
       {rsql('avg(abs(prediction - label))')} AS mae, count(*) AS rows
FROM {_GM_PRED_SQL}
""")
def q_regression_metrics(spark, sf):
    m = ml.regression_metrics(_gm_predictions(spark, sf))
    return m.select(r6("rmse").alias("rmse"), r6("r2").alias("r2"), r6("mae").alias("mae"), "rows")


@register("best_predictions", f"""
SELECT event_id, station, label, {rsql('prediction')} AS prediction, {rsql('abs(prediction - label)')} AS error
FROM {_GM_PRED_SQL} ORDER BY abs(prediction - label), event_id LIMIT 10
""")
def q_best_predictions(spark, sf):
    out = ml.best_predictions(_gm_predictions(spark, sf), 10, tie=["event_id"])
    return out.select("event_id", "station", "label", r6("prediction").alias("prediction"), r6("error").alias("error"))


@register("worst_predictions", f"""
SELECT event_id, station, label, {rsql('prediction')} AS prediction, {rsql('abs(prediction - label)')} AS error
FROM {_GM_PRED_SQL} ORDER BY abs(prediction - label) DESC, event_id LIMIT 10
""")
def q_worst_predictions(spark, sf):
    out = ml.worst_predictions(_gm_predictions(spark, sf), 10, tie=["event_id"])
    return out.select("event_id", "station", "label", r6("prediction").alias("prediction"), r6("error").alias("error"))


# --------------------------------------------------------------------------- hot keys (skew paths)
# Keys derived so that one key holds a large share of all rows; small blocks make the
# blocked path run at the test scale.  Results must equal the plain window.
HOT_BLOCK_ROWS = 1000


def _hot_key_events(spark, sf):
    ev = _events(spark, sf)
    key = F.when(F.col("event_type").isin("view", "click"), F.lit(-1)).otherwise(F.col("user_id"))
    return ev.select(key.alias("sensor"), "event_id", "ts", "value")


@register("rolling_stats_hot_key", f"""
SELECT sensor, event_id, ts, value,
       {rsql('avg(value) OVER w')} AS value_mean, {rsql('stddev_pop(value) OVER w')} AS value_std
FROM (SELECT CASE WHEN event_type IN ('view', 'click') THEN -1 ELSE user_id END AS sensor, event_id, ts, value
      FROM events)
WINDOW w AS (PARTITION BY sensor ORDER BY ts, event_id ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)
""")
def q_rolling_stats_hot_key(spark, sf):
    out = anomalies.rolling_stats(_hot_key_events(spark, sf), "sensor", EV_ORDER, "value", 24,
                                  block_rows=HOT_BLOCK_ROWS)
    return out.select("sensor", "event_id", "ts", "value",
                      r6("value_mean").alias("value_mean"), r6("value_std").alias("value_std"))


_NULL_TIMES = "CASE WHEN event_id % 50 = 0 THEN NULL ELSE ts END"


@register("rolling_stats_hot_null_time", f"""
SELECT sensor, event_id, {rsql('avg(value) OVER w')} AS value_mean, {rsql('stddev_pop(value) OVER w')} AS value_std
FROM (SELECT CASE WHEN event_type IN ('view', 'click') THEN -1 ELSE user_id END AS sensor, event_id,
             {_NULL_TIMES} AS t, value FROM events)
WINDOW w AS (PARTITION BY sensor ORDER BY t NULLS FIRST, event_id ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)
""")
def q_rolling_stats_hot_null_time(spark, sf):
    ev = _hot_key_events(spark, sf).withColumn("t", F.when(F.col("event_id") % 50 != 0, F.col("ts")))
    out = anomalies.rolling_stats(ev, "sensor", ["t", "event_id"], "value", 24, block_rows=HOT_BLOCK_ROWS)
    return out.select("sensor", "event_id", r6("value_mean").alias("value_mean"), r6("value_std").alias("value_std"))


@register("rolling_stats_struct_key", f"""
SELECT event_id, {rsql('avg(value) OVER w')} AS value_mean, {rsql('stddev_pop(value) OVER w')} AS value_std
FROM events
WINDOW w AS (PARTITION BY event_type, event_id % 2 ORDER BY ts, event_id ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)
""")
def q_rolling_stats_struct_key(spark, sf):
    """The key is a struct whose values differ by one microsecond."""
    at = F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("event_id") % 2)
    ev = _events(spark, sf).withColumn("sensor", F.struct(F.col("event_type").alias("e"), at.alias("at")))
    out = anomalies.rolling_stats(ev, "sensor", EV_ORDER, "value", 24, block_rows=HOT_BLOCK_ROWS)
    return out.select("event_id", r6("value_mean").alias("value_mean"), r6("value_std").alias("value_std"))


@register("sequence_edges_hot_line", """
SELECT src, dst, line FROM (
    SELECT lag(l_partkey) OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey) AS src,
           l_partkey AS dst, l_returnflag AS line FROM lineitem) WHERE src IS NOT NULL
""")
def q_sequence_edges_hot_line(spark, sf):
    li = load_table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey")
    return sequence.sequence_edges(li, "l_returnflag", ["l_orderkey", "l_linenumber", "l_partkey"], "l_partkey",
                                   block_rows=HOT_BLOCK_ROWS)


@register("sequence_edges_long_line", """
SELECT src, dst, line FROM (
    SELECT lag(l_partkey) OVER (PARTITION BY line ORDER BY l_orderkey, l_linenumber, l_partkey) AS src, l_partkey AS dst, line
    FROM (SELECT CASE WHEN l_returnflag IN ('A', 'N') THEN 'long' ELSE l_returnflag END AS line, * FROM lineitem)) WHERE src IS NOT NULL
""")
def q_sequence_edges_long_line(spark, sf):
    """One line holds two thirds of all stops."""
    line = F.when(F.col("l_returnflag").isin("A", "N"), F.lit("long")).otherwise(F.col("l_returnflag"))
    li = load_table(spark, sf, "lineitem").select(line.alias("line"), "l_orderkey", "l_linenumber", "l_partkey")
    return sequence.sequence_edges(li, "line", ["l_orderkey", "l_linenumber", "l_partkey"], "l_partkey", block_rows=HOT_BLOCK_ROWS)


@register("rolling_stats_hot_hour", f"""
SELECT sensor, event_id, t, {rsql('avg(value) OVER w')} AS value_mean, {rsql('stddev_pop(value) OVER w')} AS value_std
FROM (SELECT CASE WHEN event_type IN ('view', 'click') THEN -1 ELSE user_id END AS sensor, event_id, value,
             CASE WHEN event_type IN ('view', 'click') THEN TIMESTAMP '2024-01-10 05:00:00' + INTERVAL 1 SECOND * (event_id % 1000)
                  ELSE ts END AS t FROM events)
WINDOW w AS (PARTITION BY sensor ORDER BY t, event_id ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)
""")
def q_rolling_stats_hot_hour(spark, sf):
    """The rows of the hot key all lie in one hour, many at the same second."""
    at = F.expr("timestampadd(SECOND, cast(event_id % 1000 as int), timestamp_ntz'2024-01-10 05:00:00')")
    ev = _hot_key_events(spark, sf).withColumn("t", F.when(F.col("sensor") == -1, at).otherwise(F.col("ts")))
    out = anomalies.rolling_stats(ev, "sensor", ["t", "event_id"], "value", 24, block_rows=HOT_BLOCK_ROWS)
    return out.select("sensor", "event_id", "t", r6("value_mean").alias("value_mean"), r6("value_std").alias("value_std"))


_HOT_GROUP_SQL = """(SELECT o_orderkey, k, o_totalprice, avg(o_totalprice) OVER g AS m, stddev_samp(o_totalprice) OVER g AS s
   FROM (SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN -1 ELSE o_custkey END AS k FROM orders)
   WINDOW g AS (PARTITION BY k))"""


def _hot_groups(spark, sf):
    key = F.when(F.col("o_orderkey") % 2 == 0, F.lit(-1)).otherwise(F.col("o_custkey"))
    return load_table(spark, sf, "orders").select("o_orderkey", key.alias("k"), "o_totalprice")


@register("group_zscore_hot_group", f"""
SELECT o_orderkey, k, {rsql('m')} AS group_mean, {rsql('s')} AS group_std, {rsql('(o_totalprice - m) / nullif(s, 0)')} AS z_score
FROM {_HOT_GROUP_SQL}
""")
def q_group_zscore_hot_group(spark, sf):
    """One group holds half of all rows."""
    out = anomalies.group_zscore(_hot_groups(spark, sf), "k", "o_totalprice", hot_rows=HOT_BLOCK_ROWS)
    return out.select("o_orderkey", "k", r6("group_mean").alias("group_mean"), r6("group_std").alias("group_std"),
                      r6("z_score").alias("z_score"))


@register("group_outliers_top50", f"""
SELECT o_orderkey, k, {rsql('(o_totalprice - m) / s')} AS z_score FROM {_HOT_GROUP_SQL}
WHERE s > 0 AND (o_totalprice - m) / s > 1.5 ORDER BY round((o_totalprice - m) / s, 9) DESC, o_orderkey LIMIT 50
""")
def q_group_outliers_top50(spark, sf):
    out = anomalies.group_outliers(_hot_groups(spark, sf), "k", "o_totalprice", threshold=1.5, limit=50, tie=["o_orderkey"],
                                   hot_rows=HOT_BLOCK_ROWS)
    return out.select("o_orderkey", "k", r6("z_score").alias("z_score"))


@register("rolling_stats_range", f"""
SELECT user_id, event_id, ts, value, {rsql('avg(value) OVER w')} AS value_mean,
       {rsql('stddev_pop(value) OVER w')} AS value_std, count(value) OVER w AS value_count
FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW)
""")
def q_rolling_stats_range(spark, sf):
    ev = _events(spark, sf).select("user_id", "event_id", "ts", "value")
    out = anomalies.rolling_stats_range(ev, EV_KEY, "ts", "value", 24 * 3600)
    return out.select("user_id", "event_id", "ts", "value", r6("value_mean").alias("value_mean"),
                      r6("value_std").alias("value_std"), "value_count")


@register("rolling_stats_range_dense", f"""
SELECT event_id, {rsql('avg(value) OVER w')} AS value_mean, {rsql('stddev_pop(value) OVER w')} AS value_std, count(value) OVER w AS value_count
FROM (SELECT event_id, event_type, value, TIMESTAMP '2024-01-10 00:00:00' + INTERVAL 1 SECOND * (event_id * 17 % 172800) AS t FROM events)
WINDOW w AS (PARTITION BY event_type ORDER BY t RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW)
""")
def q_rolling_stats_range_dense(spark, sf):
    """All rows of few keys within two days: a frame holds thousands of rows."""
    at = F.expr("timestampadd(SECOND, cast(event_id * 17 % 172800 as int), timestamp_ntz'2024-01-10 00:00:00')")
    ev = _events(spark, sf).select("event_id", "event_type", "value", at.alias("t"))
    out = anomalies.rolling_stats_range(ev, "event_type", "t", "value", 24 * 3600, bucket_rows=HOT_BLOCK_ROWS, dense_rows=0)
    return out.select("event_id", r6("value_mean").alias("value_mean"), r6("value_std").alias("value_std"), "value_count")


_STATION_STREAM_SQL = f"""
WITH keys AS (SELECT c_name, CAST(row_number() OVER (ORDER BY c_name) - 1 AS INTEGER) AS idx
              FROM (SELECT DISTINCT c_name FROM customer WHERE c_name IS NOT NULL) ORDER BY c_name LIMIT 20),
     n AS (SELECT count(*) AS n FROM keys),
     ev AS (SELECT e.ts, k.c_name AS station, e.value, CAST(json_extract(e.props, '$.k') AS DOUBLE) AS k
            FROM events e, n JOIN keys k ON k.idx = CAST(e.event_id % n.n AS INTEGER)),
     w AS (SELECT time_bucket(INTERVAL 2 HOUR, ts) - INTERVAL 2 HOUR * o AS window_start, station, value, k
           FROM ev, (SELECT unnest([0, 1, 2]) AS o) offs),
     g AS (SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, station,
                  avg(value) AS vm, stddev_pop(value) AS vs, max(value) AS vx,
                  avg(k) AS km, stddev_pop(k) AS ks, max(k) AS kx
           FROM w GROUP BY window_start, station),
     z AS (SELECT *, CASE WHEN vs > 0 THEN (vx - vm) / vs ELSE 0.0 END AS vz,
                     CASE WHEN ks > 0 THEN (kx - km) / ks ELSE 0.0 END AS kz FROM g)
SELECT window_start, window_end, station, {rsql('vm')} AS value_mean, {rsql('vs')} AS value_std, vx AS value_max,
       {rsql('vz')} AS value_zscore, {rsql('km')} AS k_mean, {rsql('ks')} AS k_std, kx AS k_max, {rsql('kz')} AS k_zscore
FROM z WHERE vz >= 1.75 OR kz >= 1.75
"""


@register("stream_station_anomalies", _STATION_STREAM_SQL)
def q_stream_station_anomalies(spark, sf):
    # the live path end to end: round-robin station per event (20 stations), sliding
    # 6 h / 2 h windows per station, alerts on the latest state of each window
    keys = profile.bounded_keys(load_table(spark, sf, "customer"), "c_name", 20)
    ev = streaming.event_stream(spark, sf, "events.parquet")
    ev = windows.round_robin_assign(ev, "event_id", keys, "station").select(
        "ts", "station", "value", F.get_json_object("props", "$.k").try_cast("double").alias("k"))
    out = streaming.stream_anomalies(spark, ev, "ts", ["station"], ["value", "k"],
                                     duration=WIN_DURATION, slide=WIN_SLIDE, threshold=1.75)
    return out.select("window_start", "window_end", "station",
                      r6("value_mean").alias("value_mean"), r6("value_std").alias("value_std"), "value_max",
                      r6("value_zscore").alias("value_zscore"), r6("k_mean").alias("k_mean"),
                      r6("k_std").alias("k_std"), "k_max", r6("k_zscore").alias("k_zscore"))
