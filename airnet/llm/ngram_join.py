"""Near-copy search: n-gram Jaccard join by MinHash banding.

1. **Signatures.**  Each text becomes its set of 5-word shingles (64-bit hashes) and, from it, band
   hashes of a MinHash signature.  Texts with the same set are one class (a 128-bit digest of
   the set), so copies cost one row from here on.
2. **Buckets.**  Classes meet in the buckets (band number, band hash).  Bands and rows are chosen
   for a target recall at the threshold.  Buckets of one class are dropped; of the buckets
   that hold exactly the same classes, one is kept.
3. **Blocks.**  A bucket is cut into blocks of bounded rows and shingles, and every pair of its
   blocks is one group of rows, so a bucket of any size is spread over tasks.
4. **Verification.**  Inside a group all pairs are compared on their full shingle sets.  Pairs are
   never written: a group gives, for each class with a link, its number of links and the
   smallest class of its local component.  A pair that meets in several buckets counts in the
   first of them only.
5. **Components.**  The local components are merged by label propagation with pointer jumping;
   labels are written to the shared folder after each round.
"""
from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, IntegerType, LongType, StructField, StructType)

from airnet.llm.common import arrow, batches as small_batches, lean, rows, ship
from airnet.session import materialize

N = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 128
BLOCK_ROWS = 512
#: Texts that go to Python at once; a task holds them several times over, outside of the JVM's heap.
BATCH_ROWS, BATCH_BYTES = 500, 4 << 20
BLOCK_SHINGLES = 1 << 20
BROADCAST_ROWS = 250_000      # of 16 bytes each
WORD_CACHE = 400_000
_WORD = re.compile(r"\w+")

SIGNATURE_SCHEMA = StructType([
    StructField("doc_id", LongType()), StructField("a", LongType(), False), StructField("b", LongType(), False),
    StructField("key", BinaryType(), False), StructField("n", IntegerType(), False),
    StructField("bands", ArrayType(LongType(), False), False)])
SET_SCHEMA = StructType([StructField("key", BinaryType(), False), StructField("shingles", BinaryType(), False)])
LINK_SCHEMA = StructType([StructField("key", BinaryType(), False), StructField("root", BinaryType(), False),
                          StructField("links", LongType(), False)])


def choose_bands(threshold: float, recall: float, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows) with the most rows per band whose recall at the threshold is reached
    with at most ``most`` hashes: more rows mean fewer chance pairs."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1)
    for r in range(1, most + 1):
        b = math.ceil(math.log(1 - recall) / math.log1p(-threshold ** r))
        if b * r <= most:
            best = (b, r)
    return best


class Shingler:
    """Shingle sets and band hashes of texts; words are hashed once per task (bounded cache)."""

    def __init__(self, n: int, bands: int, rows_: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.n, self.bands, self.rows = n, bands, rows_
        self.mult = (rng.integers(0, 1 << 63, bands * rows_, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
        self.add = rng.integers(0, 1 << 63, bands * rows_, dtype=np.uint64)
        self.fold = (rng.integers(0, 1 << 63, rows_, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
        self.words: dict[str, int] = {}

    def _word(self, w: str) -> int:
        if len(self.words) >= WORD_CACHE:
            self.words.clear()
        h = self.words[w] = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
        return h

    def shingles(self, text: str) -> np.ndarray:
        """Sorted distinct shingle hashes; a text of fewer than n words is one shingle."""
        found = _WORD.findall(text.lower())
        if not found:
            return np.empty(0, np.uint64)
        known, word = self.words, self._word
        ids = np.array([known.get(w) or word(w) for w in found], dtype=np.uint64)
        size = min(self.n, len(ids))
        h = np.zeros(len(ids) - size + 1, np.uint64)
        for i in range(size):
            h = h * np.uint64(0x9E3779B97F4A7C15) + ids[i:len(ids) - size + 1 + i]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        return np.unique(h)

    def band_hashes(self, shingles: np.ndarray) -> list[int]:
        low = np.full(len(self.mult), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(shingles), 2048):
            part = shingles[at:at + 2048]
            np.minimum(low, (self.mult[:, None] * part[None, :] + self.add[:, None]).min(axis=1), out=low)
        out = np.zeros(self.bands, np.uint64)
        for i, column in enumerate(low.reshape(self.bands, self.rows).T):
            out = (out ^ (column >> np.uint64(17)) ^ column) * self.fold[i]
        out += np.arange(self.bands, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return out.view(np.int64).tolist()


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a 128-bit content hash (a, b), in which NULL differs from the empty text."""
    ship(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), F.col("text").cast("string")).alias("b"))


def signatures(docs: DataFrame, n: int, bands: int, rows_: int) -> DataFrame:
    schema = arrow(SIGNATURE_SCHEMA)

    def run(batches):
        s = Shingler(n, bands, rows_)
        for batch in batches:
            out = []
            for doc_id, text, a, b in rows(batch, "doc_id", "text", "a", "b"):
                x = s.shingles(text)
                out.append((doc_id, a, b, set_key(x), len(x), s.band_hashes(x) if len(x) else []))
            cols = list(zip(*out)) or [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return keyed(docs).mapInArrow(lean(run), SIGNATURE_SCHEMA)


def _small(side: DataFrame) -> DataFrame:
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side


def _sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """Full shingle sets of the wanted texts (a, b); one row per set."""
    schema = arrow(SET_SCHEMA)

    def run(batches):
        s = Shingler(n, 1, 1)
        for batch in batches:
            found = [s.shingles(text) for (text,) in rows(batch, "text")]
            yield pa.RecordBatch.from_arrays([pa.array([set_key(x) for x in found], pa.binary()),
                                              pa.array([x.tobytes() for x in found], pa.binary())], schema=schema)

    first = keyed(docs).join(_small(wanted), ["a", "b"], "left_semi").select("text")
    return first.mapInArrow(lean(run), SET_SCHEMA).dropDuplicates(["key"])


def _compare(keys: list[bytes], sets: list[np.ndarray], sides: np.ndarray, kept: np.ndarray, bucket: int,
             same_block: bool, threshold: float) -> list[tuple[bytes, bytes, int]]:
    """Links among the rows of one group: (key, root of its local component, links) per linked row.

    ``sides``: block of each row; with ``same_block`` false only pairs across blocks count.
    ``kept``: per row and band the kept bucket (0: none); a pair counts in the smallest
    bucket that both share.
    """
    m = len(keys)
    sizes = np.array([len(x) for x in sets], np.float64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(m), sizes.astype(np.int64))
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times > 1                                   # a shingle of one row joins nothing
    number = np.cumsum(shared) - 1
    use = shared[column]
    row, col = owner[use], number[column[use]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    width = int(shared.sum())
    inter = np.zeros((m, m), np.float32)
    step = max(256, (1 << 22) // max(m, 1))              # columns of a dense slice: 16 MB
    edges = np.searchsorted(col, np.arange(0, width + step, step))
    for k in range(len(edges) - 1):
        lo, hi = edges[k], edges[k + 1]
        if hi > lo:
            dense = np.zeros((m, min(step, width - k * step)), np.float32)
            dense[row[lo:hi], col[lo:hi] - k * step] = 1
            inter += dense @ dense.T
    union = sizes[:, None] + sizes[None, :] - inter
    linked = inter >= threshold * union - 1e-6
    np.fill_diagonal(linked, False)
    if not same_block:
        linked &= sides[:, None] != sides[None, :]
    # count a pair where it first meets
    x, y = np.nonzero(np.triu(linked))
    if not len(x):
        return []
    out_links = np.zeros(m, np.int64)
    parent = list(range(m))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for at in range(0, len(x), 1 << 16):
        px, py = x[at:at + (1 << 16)], y[at:at + (1 << 16)]
        both = kept[px]
        first = np.where((both == kept[py]) & (both != 0), both, np.iinfo(np.int64).max).min(axis=1)
        mine = first == bucket
        np.add.at(out_links, px[mine], 1)
        np.add.at(out_links, py[mine], 1)
        for i, j in zip(px[mine].tolist(), py[mine].tolist()):
            ri, rj = find(i), find(j)
            if ri != rj:
                low, high = (ri, rj) if keys[ri] <= keys[rj] else (rj, ri)
                parent[high] = low
    return [(keys[i], keys[find(i)], int(out_links[i])) for i in range(m) if out_links[i]]


def _verify(members: DataFrame, threshold: float) -> DataFrame:
    """``members``: bucket, p, q (block pair), block, key, kept, shingles."""
    schema = arrow(LINK_SCHEMA)
    cols = ["bucket", "p", "q", "block", "key", "kept", "shingles"]

    def run(batches):
        now, group = None, []

        def close():
            if len(group) < 2:
                return []
            keys = [g[1] for g in group]
            sets = [np.frombuffer(g[3], np.uint64) for g in group]
            return _compare(keys, sets, np.array([g[0] for g in group]), np.array([g[2] for g in group], np.int64),
                            now[0], now[1] == now[2], threshold)

        def batch_of(out):
            cols_ = list(zip(*out)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols_, schema)], schema=schema)

        for batch in batches:
            out = []
            for bucket, p, q, block, key, kept, shingles in rows(batch, *cols):
                if (bucket, p, q) != now:
                    out += close() if now else []
                    now, group = (bucket, p, q), []
                group.append((block, key, kept, shingles))
            yield batch_of(out)
        if now:
            yield batch_of(close())

    keys = ["bucket", "p", "q"]
    return members.repartition(*keys).sortWithinPartitions(*keys).select(*cols).mapInArrow(lean(run), LINK_SCHEMA)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``key, label`` of every key on an edge (x, y): the smallest key of its component."""
    both = materialize(edges.select(F.col("x").alias("u"), F.col("y").alias("v"))
                       .unionByName(edges.select(F.col("y").alias("u"), F.col("x").alias("v"))).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("u").alias("key")).agg(F.least(F.col("key"), F.min("v")).alias("label")),
                         "labels")
    for _ in range(max_rounds):
        near = (both.join(labels.select(F.col("key").alias("v"), "label"), "v", "inner")
                .groupBy(F.col("u").alias("key")).agg(F.min("label").alias("near")))
        stepped = labels.join(near, "key", "inner").select("key", F.col("label").alias("old"),
                                                           F.least("label", "near").alias("label"))
        stepped = materialize(stepped, "labels")
        jump = stepped.select(F.col("key").alias("label"), F.col("label").alias("next"))
        jumped = materialize(stepped.join(jump, "label", "inner")
                             .select("key", F.col("next").alias("label"), (F.col("next") != F.col("old")).alias("moved")),
                             "labels")
        moved = jumped.where("moved").limit(1).count()
        labels = jumped.drop("moved")
        if not moved:
            return labels
    raise RuntimeError("components did not settle")


def near_copies(docs: DataFrame, *, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Per row of ``docs``: ``doc_id, a, b, label, class_id, n_links, n_copies, n_shingles``.

    ``class_id`` is the smallest doc_id of the row's component of texts linked by a Jaccard
    similarity of at least ``threshold`` on n-word shingles; ``label`` names the component by what
    its texts hold, so it tells components apart whose ids repeat or are NULL (a row without
    shingles has one of its id and text); ``n_links`` the number of different
    shingle sets its own is linked to; ``n_copies`` the rows with the same set; (a, b) a hash of
    the text.  Words are ``\\w+`` of the lower-cased text.  NULL or wordless texts have no
    shingles: they link to nothing and are their own class.  Repeated rows are copies.  NULL
    ids never name a class.  Other columns are not read.
    """
    bands, rows_ = choose_bands(threshold, recall)
    with small_batches(docs.sparkSession, BATCH_ROWS, BATCH_BYTES):
        signed = materialize(signatures(docs, n, bands, rows_), "signatures")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "a", "b"))
    classes = materialize(
        signed.where("n > 0").groupBy("key")
        .agg(first.alias("f"), F.count(F.lit(1)).alias("n_copies"), F.first("n").alias("n"), F.first("bands").alias("bands"))
        .select("key", "f.doc_id", "f.a", "f.b", "n_copies", "n", "bands"), "classes")

    meeting = classes.select("key", "n", F.posexplode("bands").alias("band", "h"))
    bucket = F.xxhash64("band", "h")
    counted = (meeting.groupBy(bucket.alias("bucket"))
               .agg(F.count(F.lit(1)).alias("c"), F.sum(F.col("n").cast("long")).alias("s"),
                    F.bit_xor(F.xxhash64("key")).alias("f1"), F.sum(F.pmod(F.xxhash64(F.lit(3), "key"), F.lit(1 << 40))).alias("f2"))
               .where("c > 1"))
    counted = materialize(counted, "buckets")
    kept = counted.groupBy("c", "s", "f1", "f2").agg(F.min("bucket").alias("keep"))
    named = materialize(counted.join(kept, ["c", "s", "f1", "f2"], "inner").select("bucket", "keep", "c", "s"), "kept")

    met = materialize(meeting.withColumn("bucket", bucket).join(named, "bucket", "inner")
                      .select("key", "band", "keep", "c", "s"), "met")
    # per class: the kept bucket of every band (0: none)
    by_band = [F.sum(F.when(F.col("band") == i, F.col("keep")).otherwise(F.lit(0))).alias(f"k{i}") for i in range(bands)]
    meets = met.groupBy("key").agg(*by_band)
    meets = materialize(meets.select("key", F.array(*[f"k{i}" for i in range(bands)]).alias("kept")), "meets")

    wanted = materialize(classes.join(meets.select("key"), "key", "left_semi").select("a", "b"), "wanted")
    with small_batches(docs.sparkSession, BATCH_ROWS, BATCH_BYTES):
        sets = materialize(_sets(docs, wanted, n).join(meets, "key", "inner"), "sets")

    blocks = F.greatest(F.ceil(F.col("c") / F.lit(BLOCK_ROWS)), F.ceil(F.col("s") / F.lit(BLOCK_SHINGLES))).cast("int")
    placed = (met.select("key", F.col("keep").alias("bucket"), blocks.alias("blocks")).distinct()
              .withColumn("block", F.pmod(F.xxhash64(F.lit(5), "key"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("key", "bucket", "block", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q")))
    links = materialize(_verify(placed.join(sets, "key", "inner"), threshold), "links")

    labels = components(links.where(F.col("key") != F.col("root")).select(F.col("key").alias("x"), F.col("root").alias("y")))
    linked = materialize(links.groupBy("key").agg(F.sum("links").alias("n_links")), "degrees")
    named = classes.select("key", "doc_id", "n_copies").join(labels, "key", "left").join(linked, "key", "left")
    named = materialize(named.select("key", "doc_id", "n_copies", F.coalesce("label", "key").alias("label"),
                                     F.coalesce("n_links", F.lit(0)).alias("n_links")), "named")
    heads = materialize(named.groupBy("label").agg(F.min("doc_id").alias("class_id")), "heads")
    info = materialize(named.join(heads, "label", "inner").select("key", "label", "class_id", "n_links", "n_copies"), "info")
    out = signed.join(info, "key", "left")
    alone = F.concat(F.lit("row-"), F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "a", "b")))
    return out.select("doc_id", "a", "b", F.when(F.col("n") > 0, F.hex("label")).otherwise(alone).alias("label"), F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
                      F.col("n").alias("n_shingles"))
