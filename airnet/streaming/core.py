from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from airnet.operators._util import as_list
from airnet.session import scratch_path  # noqa: F401


def event_stream(spark: SparkSession, directory: str, glob: str = "*.parquet", *, schema=None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream of the parquet files in ``directory`` matching ``glob``.

    The schema is taken from a batch read of the same files when not given (footer
    metadata only).  A file stream needs a directory, hence directory + glob.
    """
    if schema is None:
        schema = spark.read.option("pathGlobFilter", glob).parquet(directory).schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(directory)


def to_event_time(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Watermarks need ``timestamp``: a wall-clock ``timestamp_ntz`` column is read as UTC
    (the same instant whatever the session time zone)."""
    t = df.schema[col].dataType.simpleString()
    c = F.col(col)
    if t == "timestamp_ntz":
        c = F.convert_timezone(F.lit("UTC"), F.current_timezone(), c).cast("timestamp")
    return df.withColumn(out or col, c)


def to_wall_clock(c) -> "F.Column":
    """Inverse of :func:`to_event_time`: an instant as its UTC wall clock (``timestamp_ntz``)."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast("timestamp_ntz"))


_VERSION = re.compile(r"(b|base)-(\d+)-(\d+)$")
RUN, BATCH = "__run", "__batch"


def _folder(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and a function that makes paths below it."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, lambda name="": jvm.org.apache.hadoop.fs.Path(root, name) if name else root


def _versions(spark: SparkSession, path: str) -> list[tuple[tuple[int, int], str, str]]:
    """((run, batch), kind, folder name) of every complete folder of an upsert sink, oldest first."""
    fs, at = _folder(spark, path)
    if not fs.exists(at()):
        return []
    found = []
    for status in fs.listStatus(at()):
        name = status.getPath().getName()
        m = _VERSION.fullmatch(name)
        if m and fs.exists(at(f"{name}/_SUCCESS")):
            found.append(((int(m[2]), int(m[3])), m[1], name))
    return sorted(found)


def live_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders that make up the sink's state: the newest base and the batches behind it."""
    found = _versions(spark, path)
    base = max((x for x in found if x[1] == "base"), default=None)
    live = [x for x in found if x[1] == "b" and (base is None or x[0] > base[0])]
    return [f"{path}/{x[2]}" for x in ([base] if base else []) + live]


def compact_sink(spark: SparkSession, path: str, keys) -> None:
    """Fold all batches of an upsert sink into one base folder that holds the last version of each key.

    The base is written under a hidden name and renamed to the version it covers; from then on
    readers leave out what it covers, and only then are the covered folders deleted.  A crash at
    any point leaves a readable sink.  Run it where no other writer compacts the same sink.
    """
    covered = _versions(spark, path)
    if not covered:
        return
    (run, batch), kind, _ = max(covered)
    fs, at = _folder(spark, path)
    if kind != "base":
        hidden = f"_base-{uuid.uuid4().hex[:12]}"
        _latest(spark.read.parquet(*live_folders(spark, path)), as_list(keys), [RUN, BATCH]).write.parquet(f"{path}/{hidden}")
        if not fs.rename(at(hidden), at(f"base-{run}-{batch}")):
            raise OSError(f"{path}: the compacted folder could not be renamed")
    for version, kind_, name in covered:
        if not (kind_ == "base" and version == (run, batch)):
            fs.delete(at(name), True)


def upsert_sink(df: DataFrame, path: str, checkpoint: str, *, trigger_available_now: bool = True,
                query_name: str | None = None, keys=None, compact_every: int = 50) -> StreamingQuery:
    """Update-mode sink: each micro-batch's changed rows become one folder below ``path``, named by
    run and batch.  Runs count up with each start of the sink, so the rows of a restart count as newer also
    when a new checkpoint begins at batch 0 again.  A replayed batch overwrites its own folder;
    :func:`latest_state` (last version per key) is then exactly-once on read.

    With ``keys`` the folders are folded into one every ``compact_every`` batches (see
    :func:`compact_sink`), so the sink holds at most that many folders beside one row per key.
    """
    spark = df.sparkSession
    run = max((v[0] for v, _, _ in _versions(spark, path)), default=0) + 1

    def version(frame: DataFrame, batch_id: int) -> DataFrame:
        return frame.withColumns({RUN: F.lit(run).cast("long"), BATCH: F.lit(batch_id).cast("long")})

    def write(batch: DataFrame, batch_id: int) -> None:
        version(batch, batch_id).write.mode("overwrite").parquet(f"{path}/b-{run}-{batch_id}")
        if keys and (batch_id + 1) % compact_every == 0:
            compact_sink(batch.sparkSession, path, keys)

    if run == 1:  # an (empty) table first: readers then work even before the first batch
        version(spark.createDataFrame([], df.schema), 0).write.mode("overwrite").parquet(f"{path}/b-0-0")

    w = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if trigger_available_now else w
    return w.start()


def append_sink(df: DataFrame, path: str, checkpoint: str, *, trigger_available_now: bool = True) -> StreamingQuery:
    """Append-mode parquet file sink (exactly-once through its commit log)."""
    w = (df.writeStream.outputMode("append").format("parquet").option("path", path)
           .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if trigger_available_now else w
    return w.start()


def run_until_done(q: StreamingQuery, timeout_s: float = 600.0) -> None:
    """Block until an ``availableNow`` query has drained its input (or raise)."""
    done = q.awaitTermination(timeout_s)
    if not done:
        q.stop()
        raise TimeoutError(f"streaming query {q.name or q.id} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _latest(table: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """The row of the highest version of each key (a distributed ``max_by``)."""
    vals = [c for c in table.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(c) for c in vals]), F.struct(*[F.col(c) for c in version]))
    return table.groupBy(*keys).agg(best.alias("__v")).select(*keys, *[F.col(f"__v.{c}").alias(c) for c in vals])


def latest_state(spark: SparkSession, path: str, keys, *, schema=None) -> DataFrame:
    """Last written version of every key of an upsert-sink table.  A plain parquet folder with a
    ``batch_id`` column is read the same way."""
    r = spark.read if schema is None else spark.read.schema(schema)
    folders = live_folders(spark, path)
    table = r.parquet(*(folders or [path]))
    version = [c for c in (RUN, BATCH) if c in table.columns] or ["batch_id"]
    return _latest(table, as_list(keys), version).drop(*version)


def open_state(spark: SparkSession, checkpoint: str, *, operator: int = 0) -> DataFrame:
    """What a stateful query still holds, read from its checkpoint by Spark's state-store reader:
    ``key`` and ``value`` structs of the last committed batch."""
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint).select("key", "value")
