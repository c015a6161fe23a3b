"""Scalar column expressions shared by the operators.

Every helper returns a :class:`pyspark.sql.Column` built from Spark built-ins, so it stays
inside whole-stage codegen.  ANSI mode is assumed on: where the analysis means "no value"
(division by a zero spread, a bad cast) the ``try_*`` forms return NULL instead of failing.
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must stay equal to the analysed application) -----------------------
# Edge colours by line number: line n (n >= 1) takes entry (n - 1) mod 20.
EDGE_PALETTE = [
    "#1f77b4", "#ff7f0e", "#2ca02c", "#d62728", "#9467bd",
    "#8c564b", "#e377c2", "#7f7f7f", "#bcbd22", "#17becf",
    "#aec7e8", "#ffbb78", "#98df8a", "#ff9896", "#c5b0d5",
    "#c49c94", "#f7b6d2", "#c7c7c7", "#dbdb8d", "#9edae5",
]
# Colour of a line whose prefix is not an integer.
UNKNOWN_LINE_COLOR = "#000000"
# Colour of a vertex whose value is not positive (no measurement).
NO_SCORE_COLOR = "#DDDDDD"
# Ordinal pollution levels.
POLLUTION_LEVELS = {"FAIBLE": 1, "MOYENNE": 2, "ELEVE": 3, "station aérienne": 0}
# ----------------------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def zscore(x, mean, sd) -> Column:
    """(x - mean) / sd; NULL when sd is 0 or NULL."""
    return F.try_divide(_c(x) - _c(mean), _c(sd))


def guarded_zscore(x, mean, sd) -> Column:
    """(x - mean) / sd when sd > 0, else 0.0 (window anomaly form)."""
    return F.when(_c(sd) > 0, F.try_divide(_c(x) - _c(mean), _c(sd))).otherwise(F.lit(0.0))


def ordinal_expr(col, mapping: Mapping[str, int]) -> Column:
    """Chained CASE WHEN: mapped values, anything else (NULL included) -> NULL int."""
    c = _c(col)
    out = None
    for k, v in mapping.items():
        out = (F.when(c == F.lit(k), F.lit(int(v))) if out is None
               else out.when(c == F.lit(k), F.lit(int(v))))
    if out is None:
        return F.lit(None).cast("int")
    return out.otherwise(F.lit(None).cast("int"))


def euclidean(x, y, x0, y0) -> Column:
    """Plane distance sqrt((x-x0)^2 + (y-y0)^2) in the units of the inputs."""
    dx = _c(x) - _c(x0)
    dy = _c(y) - _c(y0)
    return F.sqrt(dx * dx + dy * dy)


def minmax_clamped(x, lo, hi) -> Column:
    """(x - lo) / (hi - lo) clamped to [0, 1]; 0 when lo == hi (or bounds NULL)."""
    r = F.when(_c(hi) == _c(lo), F.lit(0.0)).otherwise(
        F.try_divide(_c(x) - _c(lo), _c(hi) - _c(lo)))
    return F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), r)), F.lit(0.0))


def hex_gradient(x, lo, hi) -> Column:
    """Green-to-red colour ``#rrgg00`` of a value scaled between lo and hi.

    Non-positive values get NO_SCORE_COLOR; channels are truncated towards zero.
    """
    r = minmax_clamped(x, lo, hi)
    red = (F.lit(255.0) * r).cast("int")
    green = (F.lit(255.0) * (F.lit(1.0) - r)).cast("int")
    return F.when(_c(x) <= 0.0, F.lit(NO_SCORE_COLOR)).otherwise(
        F.format_string("#%02x%02x00", red, green))


def line_color(line) -> Column:
    """Palette colour of a line label: integer prefix ``n`` before ``_`` -> entry
    ``(n - 1) mod 20``; a prefix that is not an integer >= 1 -> UNKNOWN_LINE_COLOR."""
    base = F.substring_index(_c(line), "_", 1)
    n = base.try_cast("int")
    palette = F.array(*[F.lit(c) for c in EDGE_PALETTE])
    idx = F.pmod(n - F.lit(1), F.lit(len(EDGE_PALETTE))) + F.lit(1)
    return F.when(n >= 1, F.element_at(palette, idx)).otherwise(F.lit(UNKNOWN_LINE_COLOR))


def wall_clock_micros(ts) -> Column:
    """Microseconds since the epoch of a wall-clock ``timestamp_ntz`` read as UTC
    (independent of the session time zone); instants (``timestamp``) as they are."""
    c = _c(ts)
    return F.unix_micros(F.convert_timezone(F.lit("UTC"), F.current_timezone(), c).cast("timestamp"))


def calendar_parts(ts) -> dict[str, Column]:
    """hour 0-23, dayOfWeek 1-7 (1 = Sunday), month 1-12."""
    t = _c(ts)
    return {"hour": F.hour(t), "dayOfWeek": F.dayofweek(t), "month": F.month(t)}


def hash_bucket(key, buckets: int = 100) -> Column:
    """Stable bucket 0..buckets-1 of a key from its MD5 (first 32 bits).

    Unlike ``randomSplit`` this does not depend on partitioning or ordering, so a
    recomputed task (lost executor) assigns every row to the same side.
    """
    h = F.conv(F.substring(F.md5(_c(key).cast("string")), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(buckets))
