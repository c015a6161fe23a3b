"""The stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns a frame.

1. ``quality_rules``     documents that fail the base rule or are robust outliers go;
2. ``line_dedup_stage``  lines that match an earlier line go, and documents of which nothing is left;
3. ``near_copies_stage`` of each class of near copies the document of the smallest id stays (NULL ids last), of
   rows that share id and text the least by their other columns (maps do not count);
4. ``decontamination``   documents that hold an item of the benchmark go;
5. ``packing``           the rest is tokenised and packed: one row per piece.

Stages 1 to 4 return the columns of their input, whatever their names.  Rows with the same id and
text share one verdict.  NULL ids and NULL texts are allowed throughout (a NULL text fails the
base rule); an empty table passes through all stages.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from airnet.llm.common import batches
from airnet.llm.decontamination import contaminated
from airnet.llm.line_dedup import line_dedup
from airnet.llm.ngram_join import near_copies
from airnet.llm.packing import pack_documents
from airnet.llm.quality_rules import quality_verdicts
from airnet.operators._util import quoted
from airnet.session import materialize
from airnet.sources.tables import load_table

BROADCAST_ROWS = 1_000_000   # of one 64-bit number each
#: Texts that go to Python at once; a task holds them several times over, outside of the JVM's heap.
BATCH_ROWS, BATCH_BYTES = 500, 4 << 20


def _row_hash() -> Column:
    """One number for a row's id and text."""
    return F.xxhash64(F.col("doc_id").isNull(), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
                      F.col("text").isNull(), F.coalesce(F.col("text").cast("string"), F.lit("")))


def _hashed(docs: DataFrame, *columns: str) -> DataFrame:
    """id (the row hash, as ``doc_id``) and text, for operators that return verdicts by id."""
    return docs.select(_row_hash().alias("doc_id"), F.col("text"), *columns)


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose hash is not in ``gone`` (one column ``h``); columns as they are."""
    gone = materialize(gone.distinct(), "gone")
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    held = docs.select(_row_hash().alias("h"), F.struct(*[quoted(c) for c in docs.columns]).alias("row"))
    return held.join(gone, "h", "left_anti").select("row.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    verdicts = quality_verdicts(_hashed(docs, "lang", "source"))
    return _without(docs, verdicts.where(~F.col("kept")).select(F.col("doc_id").alias("h")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup(docs)
    out = out.where((F.size("removed_lines") == 0) | F.col("text").rlike(r"\S"))
    changed = {"text": F.col("text"), "n_chars": F.when(F.size("removed_lines") == 0, F.col("row.n_chars"))
               .otherwise(F.length("text")) if "n_chars" in docs.columns else None}
    return out.select(*[(F.col("row").getField(c) if changed.get(c) is None else changed[c].cast(docs.schema[c].dataType)).alias(c)
                        for c in docs.columns])


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = materialize(near_copies(docs).select("doc_id", "a", "b", "label"), "near")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "a", "b")
    heads = materialize(found.groupBy("label").agg(F.min(place).alias("head")), "heads")
    gone = found.join(heads, "label", "inner").where(~place.eqNullSafe(F.col("head"))).select("doc_id", "a", "b").distinct()
    gone = materialize(gone, "gone")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.struct(F.col("doc_id").cast("long").isNull().alias("n"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("i"),
                   F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), F.col("text").cast("string")).alias("b"))
    listed = gone.select(F.struct(F.col("doc_id").isNull().alias("n"), F.coalesce("doc_id", F.lit(0)).alias("i"), "a", "b").alias("key"))
    held = docs.select(key.alias("key"), F.struct(*[quoted(c) for c in docs.columns]).alias("row"))
    kept = held.join(F.broadcast(listed) if listed.count() <= BROADCAST_ROWS // 4 else listed, "key", "left_anti")
    repeated = found.groupBy("doc_id", "a", "b").count().where("count > 1").limit(1).count()
    if repeated:  # rows of one id and text: the least by their other columns stays
        order = F.struct(*[F.col("row").getField(f.name) for f in docs.schema.fields if not isinstance(f.dataType, MapType)])
        kept = kept.groupBy("key").agg(F.min_by("row", order).alias("row"))
    return kept.select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with batches(spark, BATCH_ROWS, BATCH_BYTES):
        hits = contaminated(_hashed(docs), load_table(spark, sf_dir, "benchmark"))
        return _without(docs, hits.select(F.col("doc_id").alias("h")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    with batches(spark, BATCH_ROWS, BATCH_BYTES):
        return materialize(pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")), "pieces")
