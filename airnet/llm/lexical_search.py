"""Ranked lexical search by bag deduplication.

1. **Bags.**  Each document becomes its bag: the items' terms it holds with their counts, as packed
   bytes, and its length in terms.  Nothing else of its text matters to any score.
2. **Statistics.**  N, L and the document frequencies are sums over all bags.
3. **Classes.**  Documents with the same bag and the same length factor m have the same score for every
   item.  They meet by a hash and are grouped by the bag and m themselves, so a hash collision
   joins nothing.  Of a class the ``k`` least ids are kept, cut to ``k`` per task before the
   shuffle: no other member can be among the ``k`` best of any item.
4. **Scores.**  Each class is scored once.  A task keeps the ``k`` best documents of each item,
   expanding classes by ascending id; a last step merges the tasks' lists.

Items are taken in blocks of bounded text (``ITEM_BYTES``), each against all documents, so the
broadcast vocabulary is bounded whatever the number of items.
"""
from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from airnet.llm.common import arrow, rows, ship
from airnet.session import materialize

TOP = 10
ITEM_BYTES = 2 << 20     # text of the items of one block
CELL_NUMBERS = 2 << 20   # 64-bit numbers of the tables that one task scores at once
NO_ID = (1 << 63) - 1    # place of a NULL id: behind all others

# digits, letters of ASCII (A-Z lowered) and all characters beyond it belong to terms
_MAP = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))

BAG_SCHEMA = StructType([StructField("doc_id", LongType()), StructField("n", LongType(), False),
                         StructField("bag", BinaryType(), False)])
DF_SCHEMA = StructType([StructField("term", IntegerType(), False), StructField("df", LongType(), False)])
FOUND_SCHEMA = StructType([StructField("item", IntegerType(), False), StructField("score", LongType(), False),
                           StructField("doc_id", LongType())])


def terms(raw: bytes) -> list[bytes]:
    """The terms of a UTF-8 text: longest runs of digits, letters A-Z (lowered) and characters beyond ASCII."""
    return raw.translate(_MAP).split()


def pack(counts: dict[int, int]) -> bytes:
    """Term numbers, ascending, then their counts, as little-endian 32-bit numbers."""
    found = sorted(counts)
    return np.array(found + [counts[t] for t in found], "<u4").tobytes()


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Items:
    """A block of items: their vocabulary, and per item its terms with repeats."""

    def __init__(self, ids: list, texts: list[bytes]):
        self.ids = ids
        self.vocabulary: dict[bytes, int] = {}
        self.terms = [np.array([self.vocabulary.setdefault(t, len(self.vocabulary)) for t in terms(x)], np.int64)
                      for x in texts]


def _item_blocks(items: DataFrame):
    """Blocks of items of at most ITEM_BYTES each (or one larger item), read one after the other."""
    ids, texts, held = [], [], 0
    for item_id, raw in items.toLocalIterator():
        if ids and held + len(raw) > ITEM_BYTES:
            yield Items(ids, texts)
            ids, texts, held = [], [], 0
        ids.append(item_id)
        texts.append(bytes(raw))
        held += len(raw)
    if ids:
        yield Items(ids, texts)


def bags(docs: DataFrame, vocabulary) -> DataFrame:
    """BAG_SCHEMA row of every document; ``vocabulary`` is a broadcast of term -> number."""
    ship(docs.sparkSession)
    schema = arrow(BAG_SCHEMA)

    def run(batches):
        number = vocabulary.value.get
        for batch in batches:
            out = []
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("raw")):
                found = terms(raw.as_py())
                counts = Counter(map(number, found))
                counts.pop(None, None)
                out.append((doc_id, len(found), pack(counts)))
            cols = list(zip(*out)) or [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("raw")).mapInArrow(run, BAG_SCHEMA)


def _frequencies(batches):
    """Documents per term, one row per term and task."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        found = np.concatenate([np.zeros(0, np.int64), *[
            np.frombuffer(b, "<u4")[:len(b) // 8].astype(np.int64) for (b,) in rows(batch, "bag")]])
        n = np.bincount(found, minlength=len(total))
        n[:len(total)] += total
        total = n
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held], pa.int64())], schema=arrow(DF_SCHEMA))


def classes(found: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """``bag, m, members`` with the ``k`` least ids of each class (NULL ids last), ascending."""
    m = F.expr(f"25L + (75L * n * {n_docs}L) div {max(n_terms, 1)}L")
    keyed = found.where(F.octet_length("bag") > 0).select("bag", m.alias("m"), "doc_id")
    keyed = keyed.select(F.xxhash64("bag", "m").alias("h"), "bag", "m", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"))
    same = Window.partitionBy("h", "m", "bag").orderBy("id")
    least = keyed.withColumn("place", F.row_number().over(same)).where(F.col("place") <= k)
    return (least.groupBy("h", "m", "bag").agg(F.sort_array(F.collect_list("id")).alias("members"))
            .select("bag", "m", "members"))


def _best(scores: np.ndarray, floor: int, k: int) -> np.ndarray:
    """Rows that can be among the k best: at least ``floor``, above 0, ties of the k-th included."""
    at = np.flatnonzero(scores >= max(floor, 1))
    if len(at) > k:
        least = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= least]
    return at


def _scorer(held, k: int):
    """Per task: the k best documents of each item, from rows of (bag, m, members)."""
    schema = arrow(FOUND_SCHEMA)

    def run(batches):
        items, weights = held.value
        flat = np.concatenate([np.zeros(0, np.int64), *items])
        asked = [i for i, t in enumerate(items) if len(t)]
        starts = np.cumsum([0, *[len(items[i]) for i in asked]])[:-1]
        best: list[list[tuple[int, int]]] = [[] for _ in items]   # (-score, id), ascending
        step = max(1, CELL_NUMBERS // (len(weights) + len(flat) + 1))

        def score(bag_rows, ms, members):
            impact = np.zeros((len(bag_rows), len(weights)), np.int64)
            for i, raw in enumerate(bag_rows):
                pair = np.frombuffer(raw, "<u4").astype(np.int64)
                t, tf = pair[:len(pair) // 2], pair[len(pair) // 2:]
                impact[i, t] = weights[t] * ((1_000_000_000 * tf) // (1000 * tf + 8 * ms[i]))
            total = np.add.reduceat(impact[:, flat], starts, axis=1)
            for c, i in enumerate(asked):
                mine = best[i]
                rows_ = _best(total[:, c], -mine[k - 1][0] if len(mine) >= k else 1, k)
                if len(rows_):
                    mine += [(-int(total[r, c]), d) for r in rows_ for d in members[r]]
                    mine.sort()
                    del mine[k:]

        for batch in batches:
            for at in range(0, batch.num_rows if asked else 0, step):
                part = batch.slice(at, step)
                score(part.column("bag").to_pylist(), part.column("m").to_numpy(), part.column("members").to_pylist())
        out = [(i, -s, None if d == NO_ID else d) for i, mine in enumerate(best) for s, d in mine]
        cols = list(zip(*out)) or [[] for _ in schema]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return run


def search(docs: DataFrame, items: DataFrame, *, k: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item with a score above 0.

    ``docs`` has doc_id and text, ``items`` item_id and text; each row of ``docs`` is a document, also
    when ids or texts repeat.  NULL text has no terms; a NULL doc_id ranks behind the others of its
    score.  Equal rows of ``items`` are one item; different texts under one id, NULL included,
    are one item with the terms of all.  Documents without terms do not count.  Empty tables give
    an empty result.  Texts are read whole; other columns may have any name.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    wanted = (items.select(F.col("item_id"), text.alias("text")).distinct()
              .groupBy("item_id").agg(F.array_join(F.sort_array(F.collect_list("text")), " ").cast("binary").alias("raw")))
    wanted = materialize(wanted, "items").orderBy("item_id")
    out = None
    for block in _item_blocks(wanted):
        found = _search_block(docs, block, k)
        names = spark.createDataFrame(list(enumerate(block.ids)), StructType([
            StructField("item", IntegerType()), StructField("item_id", items.schema["item_id"].dataType)]))
        part = found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], StructType([
            StructField("item_id", items.schema["item_id"].dataType), StructField("rank", IntegerType()),
            StructField("doc_id", LongType()), StructField("score", LongType())]))
    return out


def _search_block(docs: DataFrame, block: Items, k: int) -> DataFrame:
    context = docs.sparkSession.sparkContext
    found = materialize(bags(docs, context.broadcast(block.vocabulary)), "bags")
    n_docs, n_terms = found.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = dict(found.mapInArrow(_frequencies, DF_SCHEMA).groupBy("term").agg(F.sum("df").alias("df"))
              .collect())  # at most one row per term of the block
    weights = np.array([weight(df.get(t, 0), n_docs) for t in range(len(block.vocabulary))], np.int64)
    held = context.broadcast((block.terms, weights))
    scored = classes(found, n_docs, n_terms, k).mapInArrow(_scorer(held, k), FOUND_SCHEMA)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
