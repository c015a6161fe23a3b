"""Range filters and nearest points to a reference row."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airnet.functions.columns import euclidean
from airnet.operators._util import as_list


def filter_range(df: DataFrame, col: str, lower=None, upper=None, *, inclusive: bool = False) -> DataFrame:
    """Rows with ``lower < col < upper`` (``<=`` with ``inclusive``); pushed into the scan."""
    c = F.col(col)
    cond = F.lit(True)
    if lower is not None:
        cond = cond & ((c >= lower) if inclusive else (c > lower))
    if upper is not None:
        cond = cond & ((c <= upper) if inclusive else (c < upper))
    return df.where(cond)


def reference_point(df: DataFrame, match: Column, x: str, y: str, tie=None) -> tuple | None:
    """``(x0, y0)`` of the first row matching ``match`` (smallest ``tie``), or None.

    One row reaches the driver (a bounded lookup: filter pushed into the scan, top-1 per
    task); the coordinates are then plain literals in the main query.
    """
    ref = df.where(match).where(F.col(x).isNotNull() & F.col(y).isNotNull())
    if tie:
        ref = ref.orderBy(*as_list(tie))
    row = ref.select(F.col(x).alias("x0"), F.col(y).alias("y0")).first()
    return None if row is None else (row["x0"], row["y0"])


def nearest_points(df: DataFrame, match: Column, x: str, y: str, *, k: int | None = 20,
                   tie=None, dist_col: str = "distance") -> DataFrame:
    """Rows ranked by Euclidean distance to the reference row chosen by ``match``.

    Rows without coordinates are dropped.  ``k`` makes it a top-k report
    (``TakeOrderedAndProject``: each task keeps only k candidates); ``k=None`` returns the
    full ordering.  An unknown reference gives an empty result.
    """
    tie = as_list(tie)
    pts = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    ref = pts.where(match)
    ref = (ref.orderBy(*tie) if tie else ref).limit(1).select(F.struct(F.col(x).alias("x0"), F.col(y).alias("y0"))).scalar()
    out = pts.withColumn(dist_col, euclidean(x, y, ref["x0"], ref["y0"])).where(F.col(dist_col).isNotNull())
    out = out.orderBy(F.col(dist_col), *[F.col(c) for c in tie])
    return out.limit(k) if k is not None else out
