"""Raw wide CSV files, each with its own header row.

A folder may hold files whose columns differ in number and order, each with title lines
before the header.  The header of every file is read first, into a table keyed by the file's path;
each row is then split into an array of its own cells and meets its own file's header, so a short
title line cannot narrow the table and a column always keeps the name its own file gives it.
No plan holds a column per cell, so its size does not grow with the width of the files.

The headers cost two scans of the lines as text (no cell is parsed); the rows are parsed once.
"""
from __future__ import annotations

import csv

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airnet.functions import names as _names
from airnet.operators._util import quoted
from airnet.operators.reshape import DATE_PREFIX, parse_utc
from airnet.session import materialize

BROADCAST_BYTES = 8 << 20   # header text that is broadcast; more is joined by file
MAX_COLUMNS = 20_000        # of a wide result; a long result has no such bound


def _lines(spark: SparkSession, path) -> DataFrame:
    """Lines that are not blank: ``file, block, value, at`` (``at`` counts up by one inside a split)."""
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"),
                                        F.col("_metadata.file_block_start").alias("block"), "value")
    return text.where(F.trim("value") != "").withColumn("at", F.monotonically_increasing_id())


def header_table(spark: SparkSession, path, *, row_index: int = 2, sep: str = ",", first: str | None = "datetime",
                 clean: bool = True) -> DataFrame:
    """``file, line, names``: the header line of every file and the unique names made of its cells
    (see :func:`airnet.functions.names.unique_names`), by ``row_index`` among the lines that are not blank.

    The header must lie in a file's first split.  A file without that line raises.
    """
    lines = _lines(spark, path)
    starts = materialize(lines.where("block = 0").groupBy("file").agg(F.min("at").alias("start")), "csv-starts")
    at = F.col("start") + F.lit(row_index)
    found = (lines.where("block = 0").join(starts, "file").where(F.col("at") == at)
             .select("file", F.regexp_replace("value", "^﻿", "").alias("line")))
    cloudpickle.register_pickle_by_value(_names)  # workers need not have the library installed
    unique_names = _names.unique_names
    named = F.udf(lambda line: unique_names(next(csv.reader([line], delimiter=sep)), first=first, clean=clean),
                  "array<string>")
    headers = materialize(found.withColumn("names", named("line")), "csv-headers")
    missing = starts.join(headers, "file", "left_anti").select("file").limit(3).collect()
    if missing:
        raise ValueError(f"header row {row_index} is missing in " + ", ".join(r["file"] for r in missing))
    return headers


def _regex(text: str) -> str:
    return "".join(f"\\x{{{ord(c):x}}}" for c in text)


def split_cells(line: Column, sep: str = ",") -> Column:
    """The cells of a line as an array, as ``from_csv`` reads them: an empty cell is NULL; a quoted one may hold the
    separator, and text behind its closing quote belongs to it."""
    mark = _regex(sep)
    plain = F.split(line, mark, -1)
    quoted_cell = r'"[^"\\]*+(?:\\.[^"\\]*+)*+(?:"(?:\\.)*+|\\?\z)'   # possessive: no stack grows with the cell
    cell = rf"(?s){mark}((?:{quoted_cell})?.*?)(?={mark}|\z)"
    # each match starts with a separator, so that none is empty
    parted = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(cell), 1)
    read = F.transform(parted, lambda c: F.when(c.startswith('"'), F.from_csv(c, "c string", {"sep": sep})["c"]).when(c != "", c))
    return F.when(F.contains(line, F.lit('"')), read).otherwise(F.transform(plain, lambda c: F.when(c != "", c)))


def _rows(spark: SparkSession, path, headers: DataFrame, sep: str, data_regex: str) -> DataFrame:
    """``names, cells`` of every line whose first cell matches ``data_regex``."""
    size = headers.agg(F.sum(F.octet_length("line"))).first()[0]
    held = headers.select("file", "names")
    if (size or 0) <= BROADCAST_BYTES:
        held = F.broadcast(held)
    cells = _lines(spark, path).select("file", split_cells(F.col("value"), sep).alias("cells"))
    return cells.where(F.get("cells", F.lit(0)).rlike(data_regex)).join(held, "file").select("names", "cells")


def wide_csv_to_long(spark: SparkSession, path, measure: str = "pm", *, row_index: int = 2, sep: str = ",",
                     time_col: str = "datetime", fmt: str = "yyyy-MM-dd HH:mm:ss", var_name: str = "station",
                     value_type: str = "double", clean: bool = True, data_regex: str = DATE_PREFIX) -> DataFrame:
    """Raw wide files -> ``(time_col, var_name, measure)``: each cell with the name of its own file's
    column, times parsed (a final ``Z`` goes), values cast (bad ones are NULL and dropped).

    Cells behind a file's last name are dropped; short rows lack the last columns.
    """
    headers = header_table(spark, path, row_index=row_index, sep=sep, first=time_col, clean=clean)
    rows = _rows(spark, path, headers, sep, data_regex)
    pairs = F.arrays_zip(F.slice("names", 2, 1 << 30).alias("name"), F.slice("cells", 2, 1 << 30).alias("cell"))
    long = rows.select(F.col("cells")[0].alias(time_col), F.explode(pairs).alias("pair"))
    long = parse_utc(long, time_col, fmt)
    value = F.col("pair.cell").try_cast(value_type)
    return (long.select(quoted(time_col), F.col("pair.name").alias(var_name), value.alias(measure))
            .where(quoted(var_name).isNotNull() & quoted(measure).isNotNull()))


def read_wide_csv(spark: SparkSession, path, *, row_index: int = 2, sep: str = ",", first: str = "datetime",
                  clean: bool = True, data_regex: str = DATE_PREFIX) -> DataFrame:
    """Raw wide files as one frame of strings: the columns of all headers, aligned by name, in the order
    of their first places (then by name); a file without a column has NULL there."""
    headers = header_table(spark, path, row_index=row_index, sep=sep, first=first, clean=clean)
    places = headers.select(F.posexplode("names").alias("place", "name")).groupBy("name").agg(F.min("place").alias("place"))
    columns = [r["name"] for r in places.orderBy("place", "name").limit(MAX_COLUMNS + 1).collect()]
    if len(columns) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} columns; use wide_csv_to_long")
    rows = _rows(spark, path, headers, sep, data_regex)
    placed = rows.select("cells", F.map_from_arrays("names", F.sequence(F.lit(0), F.size("names") - 1)).alias("place"))
    return placed.select(*[F.get("cells", F.try_element_at("place", F.lit(c))).alias(c) for c in columns])
