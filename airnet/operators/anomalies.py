"""Rolling and per-group anomaly detection.

Rolling statistics over the last ``rows`` rows of each key use the blocked frame of
:mod:`airnet.operators.sequence`, so a hot key (say a third of all rows) is never
sorted and scanned by a single task: rows get their exact position inside the key,
are cut into blocks of ``block_rows`` positions with a ``rows - 1`` halo, and the frame
runs per ``(key, block)``; keys below ``hot_rows`` rows keep the plain window.  The
result is identical to
``Window.partitionBy(key).orderBy(order).rowsBetween(-(rows-1), 0)``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airnet.functions.columns import wall_clock_micros, zscore
from airnet.operators._util import as_list, col_type, quoted
from airnet.operators.joins import hot_group_join
from airnet.operators.sequence import frame_apply, key_copies, null_safe_join


def rolling_stats(df: DataFrame, key, order, value: str, rows: int = 24, *,
                  mean_col: str | None = None, std_col: str | None = None,
                  block_rows: int = 1 << 20, hot_rows: int | None = None,
                  skew_safe: bool = True) -> DataFrame:
    """Trailing mean and *population* sd of ``value`` over the current row and the
    ``rows - 1`` previous rows of the same key, ordered by ``order``.

    ``order`` should end with a unique column so the frame is deterministic; its columns may be of any
    type that sorts.
    """
    keys, order = as_list(key), as_list(order)
    mean_col = mean_col or f"{value}_mean"
    std_col = std_col or f"{value}_std"
    if rows < 1:
        raise ValueError("rows must be >= 1")

    def stats(frame, w):
        w = w.rowsBetween(-(rows - 1), 0)
        return (frame.withColumn(mean_col, F.avg(value).over(w))
                     .withColumn(std_col, F.stddev_pop(value).over(w)))

    return frame_apply(df, keys, order, rows, stats, split=skew_safe, block_rows=block_rows, hot_rows=hot_rows)


def _merged(parts: list[tuple[Column, Column, Column]]) -> tuple[Column, Column, Column]:
    """(count, mean, sum of squared deviations) of the union of parts given as such; an empty part has count 0."""
    parts = [(F.coalesce(n, F.lit(0)), F.coalesce(m, F.lit(0.0)), F.coalesce(q, F.lit(0.0))) for n, m, q in parts]
    n = sum((p[0] for p in parts[1:]), parts[0][0])
    mean = F.try_divide(sum((p[0] * p[1] for p in parts[1:]), parts[0][0] * parts[0][1]), n)
    spread = [p[2] + p[0] * (p[1] - mean) * (p[1] - mean) for p in parts]
    return n, mean, sum(spread[1:], spread[0])


def _full_buckets(rows: DataFrame, sk: list[str], value: str, parts: int) -> DataFrame:
    """Per key and bucket ``__b``: count, mean and squared deviations of the ``parts - 1`` buckets before it."""
    v = F.col(value)
    sums = (rows.groupBy(*sk, "__b").agg(F.count(v).alias("__n"), F.avg(v).alias("__m"), F.var_pop(v).alias("__q"))
                .withColumn("__q", F.col("__q") * F.col("__n")))
    coarse = F.floor(F.col("__b") / F.lit(4 * parts))
    halo = F.pmod(F.col("__b"), F.lit(4 * parts)) > F.lit(3 * parts)
    dealt = (sums.withColumn("__copy", F.explode(F.when(halo, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
                 .withColumn("__c", coarse + F.col("__copy")))
    stretch = Window.partitionBy(*sk, "__c")
    before = stretch.orderBy("__b").rangeBetween(-(parts - 1), -1)
    off = F.col("__m") - F.col("__ref")    # from a value in the middle, so that the sums stay small
    out = (dealt.withColumn("__ref", F.avg("__m").over(stretch))
                .withColumn("__fn", F.sum("__n").over(before)).withColumn("__fs", F.sum(F.col("__n") * off).over(before))
                .withColumn("__fq", F.sum(F.col("__q") + F.col("__n") * off * off).over(before)))
    mean = F.try_divide(F.col("__fs"), F.col("__fn"))
    return out.where("__copy = 0").select(*sk, "__b", "__fn", (F.col("__ref") + mean).alias("__fm"),
                                          F.greatest(F.col("__fq") - F.col("__fs") * mean, F.lit(0.0)).alias("__fq"))


def _sliding_range(base: DataFrame, sk: list[str], value: str, width: int, mean_col: str, std_col: str, count_col: str) -> DataFrame:
    """The statistics by windows over four frames of a key and the copied end of the four before."""
    stretch = F.floor(F.col("__t") / F.lit(4 * width))
    halo = F.col("__t") >= (stretch + F.lit(1)) * F.lit(4 * width) - F.lit(width)
    d = (base.withColumn("__shift", F.explode(F.when(halo, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
             .withColumn("__b", stretch + F.col("__shift")))
    w = Window.partitionBy(*sk, "__b").orderBy("__t").rangeBetween(-width, 0)
    return (d.withColumn(mean_col, F.avg(value).over(w)).withColumn(std_col, F.stddev_pop(value).over(w))
             .withColumn(count_col, F.count(value).over(w)).where("__shift = 0"))


def rolling_stats_range(df: DataFrame, key, ts: str, value: str, seconds: int = 24 * 3600, *,
                        parts: int = 32, bucket_rows: int = 1 << 20, dense_rows: int = 10_000, mean_col: str | None = None,
                        std_col: str | None = None, count_col: str | None = None) -> DataFrame:
    """Trailing mean, population sd and row count of ``value`` over the rows of the same
    key whose time lies in ``[t - seconds, t]`` (a time frame, unlike the row frame of
    :func:`rolling_stats`; rows at equal times are peers and all included).

    While no key has more than ``dense_rows`` rows in four frames, each (key, four frames) is one window that
    slides over its rows, those within a frame of the next one copied there: one shuffle.  Beyond that,
    time is cut into buckets of ``seconds / parts``.  The buckets that lie wholly in a frame enter as
    partial sums, from a window over the bucket table; rows meet rows only in the bucket of ``t`` and in that of
    ``t - seconds``, as running sums from one end.  So no task holds more than one key's rows of two buckets,
    and the work grows with the rows, not with the rows per frame.  Where a bucket has more than
    ``bucket_rows`` rows the buckets are cut eight times finer, as long as that parts it (rows at one time are
    never parted).  ``parts`` must divide ``seconds`` in microseconds.  Rows with a NULL time have the NULL
    times of their key as their frame.
    """
    keys = as_list(key)
    mean_col = mean_col or f"{value}_mean"
    std_col = std_col or f"{value}_std"
    count_col = count_col or f"{value}_count"
    width = int(seconds) * 1_000_000
    if parts < 2 or width % parts:
        raise ValueError("parts must be at least 2 and divide the frame in microseconds")
    base, sk = key_copies(df, keys)
    base = base.withColumn("__t", wall_clock_micros(ts) if col_type(df, ts) == "timestamp_ntz" else F.unix_micros(F.col(ts)))

    def bucket(n: int) -> Column:
        return F.floor(F.col("__t") / F.lit(width // n))

    def fullest(n: int) -> int:
        counts = base.where("__t is not null").groupBy(*sk, bucket(n).alias("__b")).agg(F.count(F.lit(1)).alias("n"))
        return counts.agg(F.max("n")).first()[0] or 0

    whole = F.floor(F.col("__t") / F.lit(4 * width))
    crowd = base.groupBy(*sk, whole.alias("__b")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if crowd <= dense_rows:
        return _sliding_range(base, sk, value, width, mean_col, std_col, count_col).select(
            *[quoted(c) for c in df.columns], mean_col, std_col, count_col)
    most = fullest(parts)
    while most > bucket_rows and width % (8 * parts) == 0:
        finer = fullest(8 * parts)
        if finer == most:
            break
        parts, most = 8 * parts, finer

    timed = base.where("__t is not null").withColumn("__b", bucket(parts))
    v = F.col(value)
    own = timed.withColumn("__edge", F.lit(False))
    # each row also stands one frame later, where it is at the far edge of the rows there
    late = timed.select(*sk, (F.col("__t") + F.lit(width)).alias("__t"), (F.col("__b") + F.lit(parts)).alias("__b"), v.alias(value),
                        F.lit(True).alias("__edge"))
    both = own.unionByName(late, allowMissingColumns=True)
    here = Window.partitionBy(*sk, "__b")
    until, since = here.orderBy("__t"), here.orderBy(F.col("__t").desc())
    until, since = (w.rangeBetween(Window.unboundedPreceding, Window.currentRow) for w in (until, since))
    near, far = F.when(~F.col("__edge"), v), F.when(F.col("__edge"), v)
    for name, x, w in (("a", near, until), ("z", far, since)):
        both = (both.withColumn(f"__{name}n", F.count(x).over(w)).withColumn(f"__{name}m", F.avg(x).over(w))
                    .withColumn(f"__{name}q", F.var_pop(x).over(w) * F.col(f"__{name}n")))
    joined = null_safe_join(both.where("not __edge"), _full_buckets(timed, sk, value, parts), [*sk, "__b"], "left")
    n, mean, spread = _merged([(F.col(f"__{p}n"), F.col(f"__{p}m"), F.col(f"__{p}q")) for p in "afz"])

    out = joined.select(*[quoted(c) for c in df.columns], mean.alias(mean_col),
                        F.sqrt(F.try_divide(spread, n)).alias(std_col), n.cast("long").alias(count_col))
    none = base.where("__t is null")
    sums = none.groupBy(*sk).agg(F.avg(v).alias(mean_col), F.stddev_pop(v).alias(std_col), F.count(v).alias(count_col))
    return out.unionByName(null_safe_join(none, sums, sk, "inner").select(*out.columns))


def rolling_zscore(df: DataFrame, key, order, value: str, rows: int = 24, *,
                   z_col: str | None = None, **kw) -> DataFrame:
    """``rolling_stats`` plus ``(value - mean) / sd`` (NULL when sd is 0)."""
    mean_col = kw.pop("mean_col", None) or f"{value}_mean"
    std_col = kw.pop("std_col", None) or f"{value}_std"
    z_col = z_col or f"{value}_zscore"
    out = rolling_stats(df, key, order, value, rows, mean_col=mean_col, std_col=std_col, **kw)
    return out.withColumn(z_col, zscore(value, mean_col, std_col))


def rolling_peaks(df: DataFrame, key, order, value: str, rows: int = 24, *,
                  threshold: float = 2.5, sided: str = "up", limit: int | None = None,
                  tie: list[str] | None = None, **kw) -> DataFrame:
    """Rows whose rolling z-score reaches ``threshold`` (with a non-zero spread).

    ``sided='up'``: ``z >= threshold``, ordered by z descending.  ``sided='both'``:
    ``|z| >= threshold``, ordered by |z| descending.  ``limit`` turns the ordered result
    into a top-k report; ``tie`` columns make that report deterministic.
    """
    z_col = kw.pop("z_col", None) or f"{value}_zscore"
    std_col = kw.get("std_col") or f"{value}_std"
    out = rolling_zscore(df, key, order, value, rows, z_col=z_col, **kw)
    z = F.col(z_col)
    if sided == "up":
        score = z
    elif sided == "both":
        score = F.abs(z)
    else:
        raise ValueError("sided must be 'up' or 'both'")
    out = out.where((F.col(std_col) > 0) & (score >= F.lit(threshold)))
    # nine digits, so that equal scores tie whatever the order of their sums
    top = F.round(score, 9) if limit is not None else score
    ordering = [top.desc()] + [F.col(c) for c in (tie or as_list(key) + as_list(order))]
    out = out.orderBy(*ordering)
    return out.limit(limit) if limit is not None else out


def group_stats(df: DataFrame, group, value: str, *, mean_col: str = "group_mean",
                std_col: str = "group_std") -> DataFrame:
    """Per-group mean and *sample* sd (partial aggregation: skew-safe)."""
    keys = as_list(group)
    return df.groupBy(*keys).agg(F.avg(value).alias(mean_col), F.stddev_samp(value).alias(std_col))


def group_zscore(df: DataFrame, group, value: str, *, mean_col: str = "group_mean",
                 std_col: str = "group_std", z_col: str = "z_score", hot_rows: int = 1 << 20) -> DataFrame:
    """Each row with the mean, sample sd and z-score of its group.

    Rows with a NULL group are dropped (inner-join semantics).  The statistics are a
    partial aggregate (one row per group); rows of groups beyond ``hot_rows`` meet them on several
    tasks (:func:`airnet.operators.joins.hot_group_join`).
    """
    keys = as_list(group)
    stats = df.groupBy(*keys).agg(F.avg(value).alias(mean_col), F.stddev_samp(value).alias(std_col),
                                  F.count(F.lit(1)).alias("__rows"))
    out = hot_group_join(df, stats, keys, count_col="__rows", hot_rows=hot_rows)
    return out.withColumn(z_col, zscore(value, mean_col, std_col))


def group_outliers(df: DataFrame, group, value: str, *, threshold: float = 1.75,
                   z_col: str = "z_score", limit: int | None = None, tie: list[str] | None = None, **kw) -> DataFrame:
    """Rows whose group z-score is strictly above ``threshold``, highest first.

    ``limit`` makes it a top-k report; equal scores (to nine digits) go by ``tie``, else by group and value.
    """
    out = group_zscore(df, group, value, z_col=z_col, **kw)
    out = out.where(F.col(z_col) > F.lit(threshold))
    ties = [F.col(c) for c in (tie or [*as_list(group), value])]
    if limit is None:
        return out.orderBy(F.col(z_col).desc(), *ties)
    return out.orderBy(F.round(z_col, 9).desc(), *ties).limit(limit)
