"""Labelled station graph and value diffusion, as iterative DataFrame joins.

Vertices are keyed by station name (no driver-side id map).  One diffusion step sends
``alpha * value`` along every edge in both directions, sums what each vertex receives
and adds it:  ``p[k+1] = p[k] + alpha * A p[k]`` with ``A`` the symmetric adjacency
counted with multiplicity (a parallel edge sends twice, a self-loop sends to itself
twice).  The edge list is reduced once to ``(src, dst, weight)`` and written; each
step joins it with the current state, the weights hash-partitioned by ``(src, salt)`` (hubs salted) and sorted
once so that only the state moves, and sums by destination (partial + final aggregate).  All states
lie in one store, partitioned by iteration.
"""
from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airnet.session import materialize, scratch_path, write_once


def graph_vertices(edges: DataFrame, src: str = "src", dst: str = "dst", *, name: str = "name",
                   normalize: bool = False) -> DataFrame:
    """Distinct vertex names appearing in the edge list."""
    v = edges.select(F.col(src).alias(name)).union(edges.select(F.col(dst).alias(name)))
    if normalize:
        v = v.select(normalize_name(name).alias(name))
    return v.where(F.col(name).isNotNull()).distinct()


def normalize_name(col: str):
    """Fold the en dash into a hyphen (the same station written two ways)."""
    return F.translate(F.col(col).cast("string"), "–", "-")


def stops_vertices(stops: DataFrame, station: str, *, name: str = "name") -> DataFrame:
    """Distinct stations of the stop list (vertices including isolated one-stop lines)."""
    return stops.select(F.col(station).alias(name)).where(F.col(name).isNotNull()).distinct()


def dense_ids(vertices: DataFrame, name: str = "name", *, id_col: str = "vertex_id",
              partitions: int | None = None) -> DataFrame:
    """Dense ids ``0..n-1`` in ``name`` order without a single-partition window.

    Distinct names are range-partitioned (sampled bounds: even splits whatever the name
    distribution) and sorted inside each partition; ``monotonically_increasing_id`` then
    encodes (partition, position).  That numbering is written once to the shared folder,
    so the per-partition sizes (one row per partition, broadcast) and the ids are derived
    from the same rows even if a task is retried.
    """
    names = vertices.select(name).where(F.col(name).isNotNull()).distinct()
    n = partitions or int(vertices.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tagged = (names.repartitionByRange(n, name).sortWithinPartitions(name)
                   .withColumn("__mid", F.monotonically_increasing_id()))
    tagged = materialize(tagged, "dense-ids")
    pid = F.shiftright(F.col("__mid"), 33)
    pos = F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))
    local = tagged.select(F.col(name), pid.alias("__pid"), pos.alias("__pos"))
    sizes = local.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select("__pid", F.coalesce(F.sum("__n").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"))
    out = local.join(F.broadcast(offsets), "__pid")  # one row per partition: bounded
    return out.select((F.col("__off") + F.col("__pos")).cast("long").alias(id_col), F.col(name))


def seed_vertices(vertices: DataFrame, scores: DataFrame, *, name: str = "name",
                  score_key: str = "station", score: str = "score", value: str = "value") -> DataFrame:
    """Every vertex with its initial value: the score of the same-named station, 0.0 when
    it has none, plus ``observed`` (false where 0.0 only means "no measurement").
    Scores of stations that are not vertices are ignored."""
    s = scores.select(F.col(score_key).alias("__k"), F.col(score).cast("double").alias("__s"))
    j = vertices.join(s, vertices[name] == s["__k"], "left")
    return j.select(F.col(name), F.coalesce(F.col("__s"), F.lit(0.0)).alias(value),
                    F.col("__s").isNotNull().alias("observed"))


def mapped_counts(vertices: DataFrame, scores: DataFrame, *, name: str = "name",
                  score_key: str = "station") -> DataFrame:
    """One row: ``scored`` stations and how many of them are graph vertices (``mapped``)."""
    s = scores.select(F.col(score_key).alias("__k")).distinct()
    v = vertices.select(F.col(name).alias("__v")).distinct()
    j = s.join(v, s["__k"] == v["__v"], "left")
    return j.agg(F.count(F.lit(1)).alias("scored"), F.count("__v").alias("mapped"))


def symmetric_weights(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(src, dst, weight)``: each undirected edge in both directions, parallel edges
    summed into the weight (a self-loop appears with weight 2 per copy)."""
    there = F.struct(F.col(src).alias("src"), F.col(dst).alias("dst"))
    back = F.struct(F.col(dst).alias("src"), F.col(src).alias("dst"))
    both = edges.select(F.explode(F.array(there, back)).alias("e")).select("e.*")  # the edges are computed once
    return both.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))


def partitioned_weights(weights: DataFrame, *, partitions: int, hot_degree: int, salts: int,
                        max_hot: int = 10000) -> tuple[DataFrame, DataFrame | None]:
    """Edge weights hash-partitioned by ``(src, salt)`` and sorted, for repeated merge joins on ``src``.

    A source with more than ``hot_degree`` edges (a hub) has its edges spread over
    ``salts`` salts by destination; its state row is replicated once per salt at each
    step, so no task holds all of a hub's edges.  Hub detection is a partial-aggregate
    count; at most ``max_hot`` hubs are listed (broadcast), more fall back to a lazy join.
    Returns ``(weights, hubs)``: with hubs the weights carry ``salt`` and are partitioned by
    ``(src, salt)``; without, they are partitioned by ``src`` and ``hubs`` is None.
    """
    deg = (weights.groupBy("src").agg(F.count(F.lit(1)).alias("__deg"))
                  .where(F.col("__deg") > F.lit(hot_degree)).select("src"))
    found = deg.limit(max_hot + 1).collect()
    hubs = None
    if found:
        hubs = (F.broadcast(weights.sparkSession.createDataFrame(found, deg.schema))
                if len(found) <= max_hot else deg).withColumn("__hub", F.lit(True))
        salt = F.when(F.col("__hub"), F.pmod(F.xxhash64("dst"), F.lit(salts))).otherwise(F.lit(0))
        weights = weights.join(hubs, "src", "left").withColumn("salt", salt.cast("int")).drop("__hub")
        return weights.repartition(partitions, "src", "salt").sortWithinPartitions("src", "salt"), hubs
    # no hub: a constant salt would be folded out of the join keys, so partition by src only
    return weights.repartition(partitions, "src").sortWithinPartitions("src"), None


def diffuse_step(state: DataFrame, weights: DataFrame, alpha: float, *, name: str = "name",
                 value: str = "value", hubs: DataFrame | None = None, salts: int = 1) -> DataFrame:
    """One step ``p + alpha * A p``; vertices that receive nothing keep their value.

    With ``hubs`` (see :func:`partitioned_weights`) ``weights`` carries a ``salt`` column and each
    hub's state is copied to its salts.  Whether the state is broadcast is Spark's choice by its size.
    """
    p = state.select(F.col(name).alias("src"), F.col(value).alias("__p"))
    keys = ["src"]
    if hubs is not None:
        keys.append("salt")
        fan = F.when(F.col("__hub"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        p = p.join(hubs, "src", "left").withColumn("salt", F.explode(fan)).drop("__hub")
    msgs = (weights.join(p, keys)
                   .groupBy("dst").agg(F.sum(F.col("weight") * F.col("__p")).alias("__m")))
    nxt = state.join(msgs, state[name] == msgs["dst"], "left")
    return nxt.select(*[F.col(c) for c in state.columns if c != value],
                      (F.col(value) + F.lit(float(alpha)) * F.coalesce(F.col("__m"), F.lit(0.0))).alias(value)
                      ).select(*state.columns)


def diffuse(state: DataFrame, edges: DataFrame, alpha: float = 0.10, steps: int = 5, *,
            name: str = "name", value: str = "value", src: str = "src", dst: str = "dst",
            snapshots: bool = False, checkpoint_every: int = 2, partitions: int | None = None,
            hot_degree: int = 1 << 20, salts: int = 64) -> DataFrame:
    """Run ``steps`` diffusion steps.

    Returns the final state, or with ``snapshots`` every state ``0..steps`` tagged with
    ``iter``.  The symmetric edge weights are written once, then hash-partitioned by ``(src, salt)`` and
    persisted, so each step shuffles only the state, and a hub (more than ``hot_degree`` edges) is
    split over ``salts`` tasks; the path is the same at every size.
    States are cut from their lineage in one store below the shared
    checkpoint folder (``spark.checkpoint.dir``), a folder per iteration: every ``checkpoint_every``
    steps and the final one, and every state when snapshots are kept, which are then read as
    one table partitioned by ``iter``.  A lost executor recomputes at most ``checkpoint_every`` steps.
    """
    if steps < 0:
        raise ValueError("steps must be >= 0")
    spark = state.sparkSession
    store = scratch_path(spark, "diffusion")

    def stored(frame: DataFrame, k: int) -> DataFrame:
        return write_once(frame, f"{store}/iter={k}")

    cur = stored(state.select(name, value, *[c for c in state.columns if c not in (name, value)]), 0)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = materialize(symmetric_weights(edges, src, dst), "weights")
    weights, hubs = partitioned_weights(base, partitions=n, hot_degree=hot_degree, salts=salts)
    weights = weights.persist(StorageLevel.MEMORY_AND_DISK)
    weights.count()  # fill the partitioned cache
    for k in range(1, steps + 1):
        cur = diffuse_step(cur, weights, alpha, name=name, value=value, hubs=hubs, salts=salts)
        if snapshots or k == steps or (checkpoint_every and k % checkpoint_every == 0):
            cur = stored(cur, k)
    weights.unpersist()
    return spark.read.parquet(store) if snapshots else cur


def snapshot_bounds(snaps: DataFrame, *, value: str = "value", iter_col: str = "iter") -> DataFrame:
    """Per iteration: min and max of the *positive* values (NULL when there are none)."""
    pos = F.when(F.col(value) > 0, F.col(value))
    return snaps.groupBy(iter_col).agg(F.min(pos).alias("min_pos"), F.max(pos).alias("max_pos"))


def with_bounds(snaps: DataFrame, *, value: str = "value", iter_col: str = "iter") -> DataFrame:
    """Attach the per-iteration bounds (one row per iteration: broadcast)."""
    return snaps.join(F.broadcast(snapshot_bounds(snaps, value=value, iter_col=iter_col)), iter_col, "left")
