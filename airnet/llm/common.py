"""Small helpers shared by the operators of this package."""
from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from airnet.sources.tables import load_table

DOC_SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "documents")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this library wherever they run (once per application)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import airnet
    root = os.path.dirname(os.path.abspath(airnet.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="airnet-"), "airnet.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


@contextmanager
def batches(spark: SparkSession, rows: int, size: int) -> Iterator[None]:
    """Jobs inside send at most so many rows (fewer, if the session says so) and about so many bytes to Python at once."""
    prefix = "spark.sql.execution.arrow."
    before = {k: spark.conf.get(prefix + k) for k in ("maxRecordsPerBatch", "maxBytesPerBatch")}
    held = int(before["maxRecordsPerBatch"])
    spark.conf.set(prefix + "maxRecordsPerBatch", rows if held <= 0 else min(rows, held))
    spark.conf.set(prefix + "maxBytesPerBatch", size)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(prefix + k, v)


def give_back() -> None:
    """Memory that Python and Arrow have freed goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def lean(run: Callable) -> Callable:
    """``run``, a function for ``mapInArrow``, that gives memory back when its task ends: Spark keeps
    idle workers for later stages, whose memory they would take."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def id_text(docs: DataFrame, *extra: str) -> DataFrame:
    """Only the columns an operator needs, so that extra columns can never clash."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"), *[F.col(c) for c in extra])


def rows(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*[batch.column(n).to_pylist() for n in names])


def arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)
