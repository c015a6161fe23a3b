"""Ordered frames inside a key that stay parallel when one key is huge.

``frame_apply`` first finds the hot keys (more than ``hot_rows`` rows) with one count job;
without any, the plan is the plain window.  For a hot key it gives every row its exact
0-based position inside the key
and cuts the key into blocks of ``block_rows`` positions; the last ``rows - 1`` rows of a
block are copied into the next block (marked ``__shift = 1``) so that a frame of ``rows``
trailing rows computed per block equals the frame computed over the whole key.

Positions are a distributed prefix sum: rows are range-partitioned and sorted by (key, order), whatever
their distribution (one hour, or one line, may hold most rows), and written once with their place
in the partition; the rows of a key in earlier partitions come from a table with one row per
key and partition.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from airnet.operators._util import as_list
from airnet.session import materialize

HELPERS = ["__pid", "__pos", "__off", "__idx", "__shift", "__blk"]
_PLACE_BITS = 33   # of monotonically_increasing_id: the place in the partition
OFFSET_ROWS = 1_000_000   # of the offsets table that is broadcast


def key_copies(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """Copies of the keys under names of our own; joins on them are null-safe, so a key of any
    type and a NULL key are ordinary groups."""
    names = [f"__kv{i}" for i in range(len(keys))]
    return df.withColumns({n: F.col(k) for n, k in zip(names, keys)}), names


def null_safe_join(left: DataFrame, right: DataFrame, cols: list[str], how: str) -> DataFrame:
    right = right.withColumnsRenamed({c: f"__r{c}" for c in cols})
    on = [F.col(c).eqNullSafe(F.col(f"__r{c}")) for c in cols]
    return left.join(right, on, how).drop(*[f"__r{c}" for c in cols])


def sorted_places(df: DataFrame, keys: list[str], order: list[str], partitions: int | None = None, *,
                  keep_order: bool = True) -> DataFrame:
    """``df`` range-partitioned and sorted by keys and order, written once with ``__pid`` (partition) and
    ``__pos`` (place in it), so that later plans never see other bounds.  Without ``keep_order`` the order columns
    are not written."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
                .withColumn("__mid", F.monotonically_increasing_id()))
    tagged = materialize(tagged if keep_order else tagged.drop(*order), "places")
    return (tagged.withColumn("__pid", F.shiftright(F.col("__mid"), _PLACE_BITS))
                  .withColumn("__pos", F.col("__mid").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))).drop("__mid"))


def position_in_key(df: DataFrame, keys, order, *, copy_keys: bool = True, partitions: int | None = None,
                    n_keys: int | None = None, keep_order: bool = True) -> tuple[DataFrame, list[str]]:
    """Add ``__idx``: exact 0-based position of the row inside its key along ``order`` (NULLs first).
    Returns the frame, without the order columns unless ``keep_order``, and the key columns to partition by.

    The offsets have at most one row per partition and one more per key; with ``n_keys``, a bound that the
    caller knows, they need not be counted before they are broadcast."""
    keys, order = as_list(keys), as_list(order)
    base, sk = key_copies(df, keys) if copy_keys else (df, keys)
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = sorted_places(base, sk, order, partitions, keep_order=keep_order)
    sizes = placed.groupBy(*sk, "__pid").agg(F.count(F.lit(1)).alias("__n"), F.min("__pos").alias("__start"))
    before = Window.partitionBy(*sk).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*sk, "__pid", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__start")).alias("__off"))
    if n_keys is None:
        offsets = materialize(offsets, "offsets")
        small = offsets.count() <= OFFSET_ROWS
    else:
        small = n_keys + partitions <= OFFSET_ROWS
    if small:
        offsets = F.broadcast(offsets)
    out = null_safe_join(placed, offsets, [*sk, "__pid"], "inner")
    return out.withColumn("__idx", F.col("__off") + F.col("__pos")), sk


def _blocked_hot(base: DataFrame, sk: list[str], order: list[str], rows: int,
                 block_rows: int, n_keys: int | None = None) -> tuple[DataFrame, WindowSpec]:
    numbered, _ = position_in_key(base, sk, order, copy_keys=False, n_keys=n_keys)
    idx = F.col("__idx")
    halo = (F.pmod(idx, F.lit(block_rows)) >= F.lit(block_rows - (rows - 1))) & F.lit(rows > 1)
    shifts = F.when(halo, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    blocked = (numbered.withColumn("__shift", F.explode(shifts))
                       .withColumn("__blk", F.floor(idx / F.lit(block_rows)) + F.col("__shift")))
    return blocked, Window.partitionBy(*sk, "__blk").orderBy("__idx")


def hot_keys(base: DataFrame, sk: list[str], hot_rows: int, max_keys: int) -> tuple[DataFrame | None, int]:
    """Keys with more than ``hot_rows`` rows, found by a partial-aggregate count and written.

    Returns them with their number: None when there is none, a broadcast when there are at most ``max_keys``; a
    longer list is joined as a plain table, so that AQE can split a hot key's partition.
    """
    agg = (base.groupBy(*sk).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > F.lit(hot_rows))
               .select(*sk))
    found = materialize(agg, "hot-keys")
    n = found.count()
    if not n:
        return None, 0
    return (F.broadcast(found) if n <= max_keys else found), n


def frame_apply(df: DataFrame, keys, order, rows: int, fn, *, split: bool = True,
                block_rows: int = 1 << 20, hot_rows: int | None = None,
                max_hot_keys: int = 10000) -> DataFrame:
    """Evaluate ``fn(frame, window)`` -- window functions looking at most ``rows - 1``
    rows back -- over ``partitionBy(keys).orderBy(order)``, splitting hot keys.

    Keys with more than ``hot_rows`` (default ``block_rows``) rows are *hot*: they are
    numbered and cut into blocks with a halo (see module doc), so no task holds more
    than ``block_rows + rows - 1`` of their rows.  All other keys use the plain window.
    Hot keys are found first (one cheap count job); with none, the plan is exactly the
    plain window.  At most ``total_rows / hot_rows`` keys can be hot; up to
    ``max_hot_keys`` of them are broadcast, more are joined as a written table.  With ``split`` false every
    key uses the plain window.
    """
    keys, order = as_list(keys), as_list(order)
    plain = Window.partitionBy(*keys).orderBy(*order)
    if not split:
        return finish(fn(df.withColumn("__shift", F.lit(0)), plain))
    if block_rows < rows:
        raise ValueError("block_rows must be >= rows")
    hot_rows = hot_rows or block_rows
    base, sk = key_copies(df, keys)
    hot, n_hot = hot_keys(base, sk, hot_rows, max_hot_keys)
    if hot is None:
        return finish(fn(df.withColumn("__shift", F.lit(0)), plain))
    flagged = null_safe_join(base, hot.withColumn("__hot", F.lit(True)), sk, "left")
    cold = flagged.where(F.col("__hot").isNull()).withColumn("__shift", F.lit(0))
    cold_out = finish(fn(cold, Window.partitionBy(*sk).orderBy(*order)))
    hot_frame, w = _blocked_hot(flagged.where(F.col("__hot")), sk, order, rows, block_rows, n_hot)
    hot_out = finish(fn(hot_frame, w))
    return cold_out.unionByName(hot_out)


def finish(df: DataFrame) -> DataFrame:
    """Drop halo copies and helper columns."""
    helpers = [c for c in df.columns if c in HELPERS or c.startswith("__kv")
               or c == "__hot"]
    return df.where(F.col("__shift") == 0).drop(*helpers)


def sequence_edges(stops: DataFrame, line: str, order, station: str, *, src: str = "src",
                   dst: str = "dst", line_out: str = "line", block_rows: int = 1 << 20) -> DataFrame:
    """Consecutive stops of each line as edges ``(src, dst, line)``.

    Parallel edges (the same pair on two lines, or twice on one) are kept: the result is
    a multigraph.  Lines of more than ``block_rows`` stops are cut into blocks.
    """
    def lag_prev(frame, w):
        return frame.withColumn("__prev", F.lag(F.col(station), 1).over(w))

    out = frame_apply(stops, [line], order, 2, lag_prev, block_rows=block_rows)
    out = out.where(F.col("__prev").isNotNull() & F.col(station).isNotNull())
    return out.select(F.col("__prev").alias(src), F.col(station).alias(dst), F.col(line).alias(line_out))
