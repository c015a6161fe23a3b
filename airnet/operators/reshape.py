"""Cleaning and reshaping: NULL/duplicate removal, header promotion of raw wide files,
timestamp parsing, wide -> long, ordinal encoding, list -> ordered rows."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airnet.functions.columns import POLLUTION_LEVELS, ordinal_expr
from airnet.functions.names import unique_names
from airnet.operators._util import as_list, quoted

DATE_PREFIX = r"^\d{4}-\d{2}-\d{2}"


def drop_nulls(df: DataFrame, subset=None) -> DataFrame:
    """Drop rows holding a NULL in any column (or in any column of ``subset``)."""
    return df.na.drop(how="any", subset=as_list(subset) or None)


def drop_dups(df: DataFrame, keys=None, order=None) -> DataFrame:
    """Drop duplicate rows, or of the rows that share ``keys`` all but the first by ``order`` (default: by all
    other columns), so the kept row never depends on partitions.  Hash aggregate with map-side
    combine, so a key repeated on a third of the rows is collapsed before the shuffle."""
    ks = as_list(keys)
    rest = [c for c in df.columns if c not in ks]
    if not ks or not rest:
        return df.dropDuplicates(ks) if ks else df.dropDuplicates()

    def packed(names):
        return F.struct(*[quoted(c) for c in names])
    first = F.min_by(packed(rest), packed([*as_list(order), *[c for c in rest if c not in as_list(order)]]))
    out = df.groupBy(*[quoted(c) for c in ks]).agg(first.alias("__first"))
    return out.select(*[quoted(c) if c in ks else F.col("__first").getField(c).alias(c) for c in df.columns])


def keep_matching(df: DataFrame, col: str, regex: str = DATE_PREFIX) -> DataFrame:
    """Keep rows whose ``col`` matches ``regex`` (NULL never matches)."""
    return df.where(F.col(col).rlike(regex))


def parse_utc(df: DataFrame, col: str, fmt: str = "yyyy-MM-dd HH:mm:ss", *,
              strip: str = "Z$", out: str | None = None, ntz: bool = True) -> DataFrame:
    """Strip a trailing ``Z`` and parse ``col`` with ``fmt``; unparsable -> NULL.

    With ``ntz`` the result is a wall-clock ``timestamp_ntz`` (the text is UTC); else a
    session-time-zone ``timestamp``.
    """
    out = out or col
    cleaned = F.regexp_replace(F.col(col), strip, "") if strip else F.col(col)
    ts = F.try_to_timestamp(cleaned, F.lit(fmt))
    if ntz:
        ts = ts.cast("timestamp_ntz")
    return df.withColumn(out, ts)


def promote_header(raw: DataFrame, row_index: int = 2, *, first: str | None = "datetime",
                   clean: bool = True, data_regex: str = DATE_PREFIX) -> DataFrame:
    """Use data row ``row_index`` of a header-less file as column names and keep only the
    rows whose first column matches ``data_regex``.

    Only ``row_index + 1`` rows reach the driver (metadata); the data stays distributed.
    """
    head = raw.take(row_index + 1)
    if len(head) <= row_index:
        raise ValueError(f"file has {len(head)} rows; header row {row_index} is missing")
    names = unique_names(list(head[row_index]), first=first, clean=clean)
    first_col = raw.columns[0]
    return raw.where(F.col(first_col).rlike(data_regex)).toDF(*names)


def wide_to_long(df: DataFrame, ids, var_name: str = "station", value_name: str = "pm", *,
                 value_type: str = "double", drop_null: bool = True, values=None) -> DataFrame:
    """Unpivot every non-id column into ``(var_name, value_name)`` rows.

    Values are converted with ``try_cast`` (``'n/d'`` -> NULL) and NULL values dropped.
    ``DataFrame.unpivot`` is used rather than a ``stack`` SQL string, so names with quotes
    or spaces need no escaping.
    """
    ids = as_list(ids)
    vals = as_list(values) or [c for c in df.columns if c not in ids]

    typed = df.select(*[quoted(c) for c in ids], *[quoted(c).try_cast(value_type).alias(c) for c in vals])
    out = typed.unpivot([quoted(c) for c in ids], [quoted(c) for c in vals], var_name, value_name)
    return out.where(F.col(value_name).isNotNull()) if drop_null else out


def wide_sensor_to_long(raw: DataFrame, measure: str = "pm", *, row_index: int = 2,
                        time_col: str = "datetime", fmt: str = "yyyy-MM-dd HH:mm:ss",
                        var_name: str = "station", clean: bool = True) -> DataFrame:
    """Raw wide sensor file -> ``(datetime, station, measure)`` rows: header promotion,
    date-row filter, ``Z`` strip + parse, unpivot, numeric cast, NULL drop."""
    named = promote_header(raw, row_index, first=time_col, clean=clean)
    parsed = parse_utc(named, time_col, fmt)
    return wide_to_long(parsed, [time_col], var_name, measure)


def ordinal_encode(df: DataFrame, col: str, mapping: Mapping[str, int] = POLLUTION_LEVELS,
                   out: str = "score_pollution") -> DataFrame:
    """Ordinal integer score of a category; unknown or NULL -> NULL."""
    return df.withColumn(out, ordinal_expr(col, mapping))


def lines_to_stops(df: DataFrame, line_col: str, stops_col: str, *, seq_col: str = "stop_seq",
                   station_col: str = "station") -> DataFrame:
    """``(line, array<station>)`` -> ``(line, stop_seq, station)``, stop_seq from 0."""
    return df.select(F.col(line_col), F.posexplode(F.col(stops_col)).alias(seq_col, station_col))


def temporal_parts(df: DataFrame, ts: str, *, label_from: str | None = None,
                   label: str = "label") -> DataFrame:
    """Add ``hour`` (0-23), ``dayOfWeek`` (1 = Sunday .. 7), ``month`` (1-12) and, when
    ``label_from`` is given, ``label`` = that column as double (bad text -> NULL)."""
    t = F.col(ts)
    out = (df.withColumn("hour", F.hour(t)).withColumn("dayOfWeek", F.dayofweek(t))
             .withColumn("month", F.month(t)))
    if label_from is not None:
        out = out.withColumn(label, F.col(label_from).try_cast("double"))
    return out
