"""Divergence of the sources of each language by a three-dimensional cube of tasks.

1. **Counts.**  Each task adds up its terms by (lang, source) in a bounded table, so a hot source
   crosses the shuffle as one row per term and task.  One exchange by (lang, term) then serves the
   counts of sources, the counts of languages and the number of documents that hold a term.
2. **Slices.**  The sources of a language are dealt into blocks by hash, its kept terms likewise.  A
   slice is what one source block has of one term block.
3. **Cells.**  A task owns (source block, source block, term block): the slices are copied to the
   cells of their block's row and column, and each cell adds up the differences of all its pairs over its
   terms.  Its size is bounded by the block sizes, whatever the number of sources and terms.
4. **Reduction.**  The partial sums are added along the term axis.  Terms that neither block holds are not in
   the cell; all of them differ by the same amount, which is added once from the number of terms.

All arithmetic is exact: probabilities by decimal division, sums in 64 bits (one pair's sum is at
most about 2e9, as the scaled probabilities of a source add up to about 1e9).
"""
from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from airnet.llm.common import arrow, ship
from airnet.session import materialize

MIN_DOCS = 30            # documents of the language that must hold a kept term
TERM_RANKS = 50
SCALE = 1_000_000_000
SMOOTH = 5
SOURCE_BLOCK = 32        # sources of a block, on average
TERM_BLOCK = 4096        # terms of a block, on average
TABLE_SIZE = 400_000     # (lang, source, term) entries that a task holds before it hands them over

# everything that is no letter of ASCII and no other character beyond it becomes a space; A-Z are lowered
_MAP = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))

COUNT_SCHEMA = StructType([StructField("lang", StringType(), False), StructField("source", StringType(), False),
                           StructField("term", StringType()), StructField("cnt", LongType(), False),
                           StructField("docs", LongType(), False)])
PART_SCHEMA = StructType([StructField("lang", StringType(), False), StructField("source", StringType(), False),
                          StructField("item", StringType(), False), StructField("part_sum", LongType(), False),
                          StructField("n_terms", LongType(), False), StructField("gap", LongType(), False)])


def terms(raw: bytes) -> list[bytes]:
    """The terms of a UTF-8 text: longest runs of letters A-Z (lowered) and of characters beyond ASCII."""
    return raw.translate(_MAP).split()


def _count(batches):
    """Rows of COUNT_SCHEMA; a row with a NULL term says that the group occurs."""
    schema = arrow(COUNT_SCHEMA)
    tables: dict[tuple[str, str], dict[bytes, list[int]]] = {}
    held = 0

    def handed_over():
        for (lang, source), table in tables.items():
            n = len(table)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * (n + 1), pa.string()), pa.array([source] * (n + 1), pa.string()),
                pa.array([None, *[t.decode("utf-8", "replace") for t in table]], pa.string()),
                pa.array([0, *[x[0] for x in table.values()]], pa.int64()),
                pa.array([0, *[x[1] for x in table.values()]], pa.int64())], schema=schema)

    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for lang, source, raw in zip(langs, sources, batch.column("raw")):
            table = tables.setdefault((lang, source), {})
            before = len(table)
            own: dict[bytes, int] = {}
            for t in terms(raw.as_py()):
                own[t] = own.get(t, 0) + 1
            for t, n in own.items():
                if (x := table.get(t)) is None:
                    table[t] = [n, 1]
                else:
                    x[0] += n
                    x[1] += 1
            held += len(table) - before
            if held >= TABLE_SIZE:
                yield from handed_over()
                tables, held = {}, 0
    yield from handed_over()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, cnt, lang_cnt, lang_docs`` with one row per group and term, and one with a
    NULL term per group; NULL lang, source and text read as ''.  Only these three columns are read."""
    ship(docs.sparkSession)
    base = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
                       F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("raw"))
    found = (base.mapInArrow(_count, COUNT_SCHEMA).repartition("lang", "term")
             .groupBy("lang", "source", "term").agg(F.sum("cnt").alias("cnt"), F.sum("docs").alias("docs")))
    whole = Window.partitionBy("lang", "term")
    return found.select("lang", "source", "term", "cnt", F.sum("cnt").over(whole).alias("lang_cnt"),
                        F.sum("docs").over(whole).alias("lang_docs"))


def scaled(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * kept)), exactly; kept is above 0."""
    big = (count.cast("decimal(19,0)") + F.lit(SMOOTH)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = total.cast("decimal(19,0)") + (kept.cast("decimal(18,0)") * F.lit(SMOOTH).cast("decimal(1,0)"))
    return F.call_function("div", big, below) + F.lit(1).cast("long")


def _cell(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sums of the absolute differences of all rows of ``left`` with all of ``right``."""
    out = np.zeros((len(left), len(right)), np.int64)
    for i, row in enumerate(left):
        out[i] = np.abs(right - row).sum(axis=1)
    return out


def _pairs(table: pa.Table) -> pa.Table:
    """Partial sums of the pairs of one cell: rows of (lang, side, bi, bj, source, p0, term, p)."""
    schema = arrow(PART_SCHEMA)
    source = table.column("source").combine_chunks().dictionary_encode()
    names, at = source.dictionary.to_pylist(), source.indices.to_numpy()
    term = table.column("term").combine_chunks().dictionary_encode()
    known = term.indices.is_valid().to_numpy(zero_copy_only=False)
    place = term.indices.fill_null(0).to_numpy()
    p0, p = table.column("p0").to_numpy(), table.column("p").to_numpy()
    n_terms = len(term.dictionary)
    base = np.zeros(len(names), np.int64)
    base[at] = p0
    dense = np.repeat(base[:, None], n_terms, axis=1)
    dense[at[known], place[known]] = p[known]
    block = np.zeros(len(names), np.int64)
    block[at] = table.column("block").to_numpy()
    bi, bj = table.column("bi")[0].as_py(), table.column("bj")[0].as_py()
    a, b = np.flatnonzero(block == bi), np.flatnonzero(block == bj)
    sums, gaps = _cell(dense[a], dense[b]), np.abs(base[a][:, None] - base[b][None, :])
    x, y = np.meshgrid(a, b, indexing="ij")
    keep = x != y
    x, y, sums, gaps = x[keep], y[keep], sums[keep], gaps[keep]
    if bi != bj:  # both directions
        x, y, sums, gaps = np.concatenate([x, y]), np.concatenate([y, x]), np.tile(sums, 2), np.tile(gaps, 2)
    lang = table.column("lang")[0].as_py()
    return pa.Table.from_arrays([
        pa.array([lang] * len(x), pa.string()), pa.array([names[i] for i in x], pa.string()),
        pa.array([names[i] for i in y], pa.string()), pa.array(sums, pa.int64()),
        pa.array(np.full(len(x), n_terms), pa.int64()), pa.array(gaps, pa.int64())], schema=schema)


def _cells(groups: DataFrame, held: DataFrame) -> DataFrame:
    """PART_SCHEMA rows of all cells.  ``groups``: lang, source, p0, v, n_sources; ``held``: lang, source, term, p."""
    n_blocks = F.ceil(F.col("n_sources") / SOURCE_BLOCK).cast("int")
    n_tiles = F.greatest(F.lit(1), F.ceil(F.col("v") / TERM_BLOCK)).cast("int")
    block = F.pmod(F.xxhash64("source"), n_blocks).cast("int")
    placed = groups.select("lang", "source", "p0", n_blocks.alias("n_blocks"), n_tiles.alias("n_tiles"), block.alias("block"))
    slices = held.join(placed, ["lang", "source"]).select(
        "lang", "source", "p0", "block", "n_blocks", "term", "p",
        F.pmod(F.xxhash64("term"), F.col("n_tiles")).cast("int").alias("tile"))
    marks = placed.select("lang", "source", "p0", "block", "n_blocks", F.lit(None).cast("string").alias("term"),
                          F.col("p0").alias("p"), F.explode(F.sequence(F.lit(0), F.col("n_tiles") - 1)).alias("tile"))
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("other")
    dealt = slices.unionByName(marks).select("*", other).select(
        "lang", "source", "p0", "block", "term", "p", "tile", F.least("block", "other").alias("bi"),
        F.greatest("block", "other").alias("bj"))
    return dealt.groupBy("lang", "bi", "bj", "tile").applyInArrow(_pairs, PART_SCHEMA)


def source_divergence(docs: DataFrame, *, min_docs: int = MIN_DOCS, term_ranks: int = TERM_RANKS) -> DataFrame:
    """``lang, source, part, item, value, rank``: for each group its distance to every other source of
    its language (part ``pair``), and the terms it uses more than its language does (part ``term``).

    A row with NULL lang, source or text reads as ''; repeated rows and repeated ids count as often
    as they stand; groups without terms take part; in a language without kept terms all distances
    are 0 and no term is listed.  Texts of any length are read whole.  Ties rank by the item's UTF-8
    bytes.  An empty table gives an empty result.  Other columns may have any name.
    """
    counts = materialize(term_counts(docs), "term-counts")
    kept = counts.where(F.col("term").isNotNull() & (F.col("lang_docs") >= min_docs))
    own = kept.groupBy("lang", "source").agg(F.sum("cnt").alias("n"))
    # one row per (lang, term): the least source's
    first = kept.groupBy("lang", "term").agg(F.first("lang_cnt").alias("lang_cnt"))
    langs = first.groupBy("lang").agg(F.sum("lang_cnt").alias("lang_n"), F.count("*").alias("v"))
    occurring = counts.where("term is null").select("lang", "source")
    sizes = occurring.groupBy("lang").agg(F.count("*").alias("n_sources"))
    zero = F.lit(0).cast("long")
    groups = (occurring.join(own, ["lang", "source"], "left").join(sizes, "lang").join(langs, "lang", "left")
              .select("lang", "source", F.coalesce("n", zero).alias("n"), F.coalesce("v", zero).alias("v"),
                      F.coalesce("lang_n", zero).alias("lang_n"), "n_sources"))
    some = F.col("v") > 0
    p0 = F.when(some, scaled(zero, F.col("n"), F.greatest(F.col("v"), F.lit(1)))).otherwise(zero)
    groups = materialize(groups.withColumn("p0", p0), "groups")
    rated = (kept.join(groups.select("lang", "source", "n", "v", "lang_n"), ["lang", "source"])
             .select("lang", "source", "term", scaled(F.col("cnt"), F.col("n"), F.col("v")).alias("p"),
                     scaled(F.col("lang_cnt"), F.col("lang_n"), F.col("v")).alias("q")))

    parts = _cells(groups, rated.select("lang", "source", "term", "p"))
    vocabulary = groups.groupBy("lang").agg(F.max("v").alias("v"))
    pairs = (parts.groupBy("lang", "source", "item")
             .agg(F.sum("part_sum").alias("s"), F.sum("n_terms").alias("t"), F.max("gap").alias("gap"))
             .join(vocabulary, "lang")
             .select("lang", "source", F.lit("pair").alias("part"), "item",
                     (F.col("s") + (F.col("v") - F.col("t")) * F.col("gap")).alias("value")))
    listed = rated.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                         (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    top = listed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= term_ranks)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(top)
