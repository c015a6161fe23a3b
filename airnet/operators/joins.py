"""Joins of measurement tables."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airnet.operators._util import as_list
from airnet.session import materialize


def full_outer_measures(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Full outer equi-join USING ``keys`` (keys coalesced): every key present in either
    table once, each side's measures NULL where that side has no row.

    Both sides should be unique per key (e.g. aggregated); the join is a sort-merge join
    on the keys, and a later ``isNotNull`` filter on one side lets Catalyst turn it into a
    left/right join.
    """
    return left.join(right, as_list(keys), "full_outer")


def hot_group_join(rows: DataFrame, stats: DataFrame, keys, *, count_col: str, how: str = "inner",
                   hot_rows: int = 1 << 20, max_hot: int = 10_000, salts: int = 64) -> DataFrame:
    """``rows`` joined with ``stats`` (one row per group of ``keys``), hot groups spread over tasks.

    ``stats`` is written once, so no aggregate stands before the join; ``count_col`` says how many rows
    each group has.  A group with more than ``hot_rows`` rows gets one salt per ``hot_rows``: its statistics
    are copied to every salt, its rows are dealt to the salts by a hash of all their columns.  The hot
    groups (at most total / ``hot_rows``) are broadcast up to ``max_hot``; with more of them every group
    is dealt over ``salts``.  Rows whose key is NULL match nothing: ``how='inner'`` drops them, ``'left'``
    keeps them, dealt like a hot group.  Without hot groups the join is the plain one.
    """
    ks = as_list(keys)
    stats = materialize(stats, "group-stats")
    need = F.ceil(F.col(count_col) / F.lit(hot_rows)).cast("int")
    hot = stats.where(F.col(count_col) > hot_rows).select(*ks, need.alias("__salts"))
    n_hot = hot.count()
    missing = F.lit(False)
    for k in ks:
        missing = missing | F.col(f"`{k}`").isNull()
    whole = rows.where(~missing) if how == "inner" else rows
    if not n_hot and how == "inner":
        return whole.join(stats.drop(count_col), ks, how)
    of_row = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    if n_hot > max_hot:
        dealt, copied = whole.withColumn("__salts", F.lit(salts)), stats.withColumn("__salts", F.lit(salts))
    else:
        dealt = whole.join(F.broadcast(hot), ks, "left")
        copied = stats.withColumn("__salts", need)
    spread = F.when(missing, F.lit(salts)).otherwise(F.greatest(F.coalesce("__salts", F.lit(1)), F.lit(1)))
    dealt = dealt.withColumn("__salt", F.pmod(of_row, spread).cast("int")).drop("__salts")
    copied = copied.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.greatest("__salts", F.lit(1)) - 1)))
    return dealt.join(copied.drop("__salts", count_col), [*ks, "__salt"], how).drop("__salt")
