"""Benchmark decontamination by latent semantic retrieval.

The benchmark is a stated query set, taken in blocks of bounded size; every block is searched
against all documents.

1. **IDF.**  One pass counts, over all documents, how many hold each word of the block.
2. **Latent space.**  The block's TF-IDF passages (rows of a sparse matrix, spread over tasks) go
   through a randomised SVD: a random range sketch with one power step, then the exact SVD of
   the projected matrix from its Gram sum.  Tasks give partial sums of fixed size, added per
   block of features.  The space is fitted on the benchmark's passages because a corpus's
   own leading directions are its function words, in which single items can't be told apart.
3. **Candidates.**  Each document is cut into passages of ``2 * s`` words, one every ``s``, for the
   strides ``s`` that the block's items ask for: ``STRIDE``, and finer ones for items of fewer than 16
   words, which a long passage would drown.  Items beyond ``2 * STRIDE`` words are searched by
   overlapping segments of that length.  All passages are projected and compared with all queries
   of their stride: a candidate has cosine ``COSINE`` or more and holds at least the share ``COVER``
   of the query's latent length (an item may fill only part of a passage).
4. **Checks.**  Around a candidate the longest common subsequence of words with the item is
   found (bit-parallel); a hit needs ``LCS`` of the item's words in order and ``ANSWER`` of
   the rarest words of its last sentence, the answer, so shared phrasing alone is no hit.  Items
   of fewer than 16 words need ``SHORT`` of them at least (all, if they have no more), within one
   and a half times their length.

Nothing is shuffled but the counts and partial sums; what is broadcast is bounded by
``BLOCK_CHARS`` of benchmark text and ``RANK`` numbers per word of it.
"""
from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, DoubleType, FloatType, IntegerType, LongType, StructField,
                               StructType)

from airnet.llm.common import arrow, id_text, lean, rows

STRIDE = 32
RANK = 192
OVERSAMPLE = 16
COSINE = 0.45
COVER = 0.55
LCS = 0.6
ANSWER = 0.5
BLOCK_CHARS = 2_000_000    # benchmark text of one block
MIN_WORDS = 3              # items of fewer words prove nothing and are not searched
SHORT = 6                  # words of a short item that must be there
SCALES = ((8, 4), (16, 8))  # items below so many words are searched at this stride
DOCS = 256                 # documents handled at once in a task
PIECE = 16_384             # units projected at once (a multiple of STRIDE): bounds the memory of a text of any length
FEATURE_BLOCK = 256

HIT_SCHEMA = StructType([
    StructField("doc_id", LongType()), StructField("item_id", LongType()), StructField("cosine", DoubleType(), False),
    StructField("lcs", DoubleType(), False), StructField("answer", DoubleType(), False),
    StructField("first_word", LongType(), False)])
_DF = StructType([StructField("f", IntegerType(), False), StructField("n", LongType(), False)])
_PART = StructType([StructField("block", IntegerType(), False), StructField("part", BinaryType(), False)])
_ROW = StructType([StructField("features", ArrayType(IntegerType(), False), False),
                   StructField("weights", ArrayType(FloatType(), False), False)])

#: ASCII letters and digits stay, other ASCII characters part words
_TABLE = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(_TABLE).split()


def answer_of(text: str) -> list[bytes]:
    """Words of the last sentence."""
    parts = [p for p in re.split(r"(?<=[.!?:])\s+", text.strip()) if words_of(p)]
    return words_of(parts[-1]) if parts else []


def lcs_length(item: dict[bytes, int], size: int, words: list[bytes]) -> int:
    """Longest common subsequence of the item (bit masks of its words' places) and ``words``."""
    full = (1 << size) - 1
    v = full
    for w in words:
        m = item.get(w)
        if m is not None:
            u = v & m
            v = (v + u) | (v - u)
    return size - (v & full).bit_count()


def stride_of(size: int) -> int:
    """Stride of the passages that an item of so many words is compared with."""
    return next((s for below, s in SCALES if size < below), STRIDE)


def segments(words: list[bytes]) -> list[list[bytes]]:
    """The item itself, or its overlapping passages of ``2 * STRIDE`` words if it is longer."""
    return [words[at:at + 2 * STRIDE] for at in range(0, max(1, len(words) - STRIDE), STRIDE)]


class Block:
    """Items of one block and, once fitted, their latent vectors; sent to the tasks."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.items = [(i, words_of(t), answer_of(t)) for i, t in items]
        self.items = [x for x in self.items if len(x[1]) >= MIN_WORDS]
        self.vocab: dict[bytes, int] = {}
        for _, words, _ in self.items:
            for w in words:
                self.vocab.setdefault(w, len(self.vocab))
        self.masks = []
        for _, words, _ in self.items:
            m: dict[bytes, int] = {}
            for k, w in enumerate(words):
                m[w] = m.get(w, 0) | (1 << k)
            self.masks.append(m)

    def fit(self, idf: np.ndarray, v: np.ndarray) -> None:
        self.idf = idf
        self.project = np.ascontiguousarray((idf[:, None] * v).astype(np.float32))   # word -> latent
        self.queries: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}  # stride -> unit vectors, lengths, items
        parts: dict[int, list[tuple[int, np.ndarray]]] = {}
        for j, (_, words, _) in enumerate(self.items):
            for part in segments(words):
                parts.setdefault(stride_of(len(words)), []).append((j, self.project[[self.vocab[w] for w in part]].sum(axis=0)))
        for stride, found in parts.items():
            q = np.stack([v for _, v in found])
            length = np.maximum(np.linalg.norm(q, axis=1), 1e-6).astype(np.float32)
            self.queries[stride] = (np.ascontiguousarray((q / length[:, None]).T.astype(np.float32)), length,
                                    np.array([j for j, _ in found]))
        self.answers = [self._rare(words, answer) for _, words, answer in self.items]

    def _rare(self, words: list[bytes], answer: list[bytes]) -> list[bytes]:
        """The rarer half of the answer's different words."""
        order = sorted(set(answer or words), key=lambda w: (-self.idf[self.vocab[w]], w))
        return order[:max(1, (len(order) + 1) // 2)]


def document_frequencies(docs: DataFrame, vocab: dict[bytes, int]) -> np.ndarray:
    """Documents that hold each word of the block, and the number of documents at the end."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    schema = arrow(_DF)

    def run(batches):
        known = shared.value
        names = frozenset(known)
        seen = np.zeros(len(known) + 1, np.int64)
        for batch in batches:
            for (text,) in rows(batch, "text"):
                seen[-1] += 1
                found = names.intersection(words_of(text))
                if found:
                    seen[[known[w] for w in found]] += 1
        at = np.nonzero(seen)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at], pa.int64())], schema=schema)

    out = np.zeros(len(vocab) + 1, np.int64)
    for f, n in id_text(docs).select("text").mapInArrow(lean(run), _DF).groupBy("f").agg(F.sum("n")).collect():
        out[f] = n
    return out


def _summed(rows_: DataFrame, make, features: int, width: int) -> np.ndarray:
    """Sum over tasks of the (features x width) matrices that ``make(batches)`` gives."""
    schema = arrow(_PART)

    def run(batches):
        m = make(batches)
        if m is not None:
            parts = range(0, features, FEATURE_BLOCK)
            yield pa.RecordBatch.from_arrays(
                [pa.array([p // FEATURE_BLOCK for p in parts], pa.int32()),
                 pa.array([m[p:p + FEATURE_BLOCK].astype("<f8").tobytes() for p in parts], pa.binary())], schema=schema)

    def add(key, pdf):
        import pandas as pd
        total = sum(np.frombuffer(x, "<f8") for x in pdf["part"])
        return pd.DataFrame({"block": [key[0]], "part": [np.asarray(total, "<f8").tobytes()]})

    found = rows_.mapInArrow(lean(run), _PART).groupBy("block").applyInPandas(add, _PART).collect()
    out = np.zeros((features, width))
    for block, part in found:
        p = np.frombuffer(part, "<f8").reshape(-1, width)
        out[block * FEATURE_BLOCK:block * FEATURE_BLOCK + len(p)] = p
    return out


def _dense(batch, features: int) -> np.ndarray:
    a = np.zeros((batch.num_rows, features))
    for i, (f, w) in enumerate(rows(batch, "features", "weights")):
        np.add.at(a[i], f, w)
    return a


def randomised_svd(rows_: DataFrame, features: int, rank: int, seed: int = 11) -> np.ndarray:
    """Leading right singular vectors (features x rank) of the sparse rows (features, weights).

    Range sketch Y = A'(A G) with Gaussian G, orthonormal Q of Y, then the eigenvectors of the
    Gram matrix of A Q.  The driver holds matrices of (features x rank) numbers.
    """
    width = min(rank + OVERSAMPLE, features)

    def sketch(batches):
        g = np.random.default_rng(seed).standard_normal((features, width))
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                a = _dense(batch.slice(at, 512), features)
                total = a.T @ (a @ g) + (0 if total is None else total)
        return total

    q = np.linalg.qr(_summed(rows_, sketch, features, width))[0]
    width = q.shape[1]

    def gram(batches):
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                b = _dense(batch.slice(at, 512), features) @ q
                total = b.T @ b + (0 if total is None else total)
        return total

    values, vectors = np.linalg.eigh(_summed(rows_, gram, width, width))
    order = np.argsort(values)[::-1][:rank]
    return q @ vectors[:, order[values[order] > 1e-9 * max(values.max(), 1e-30)]]


def _fit(docs: DataFrame, block: Block, rank: int) -> None:
    df = document_frequencies(docs, block.vocab)
    idf = np.log((1.0 + df[-1]) / (1.0 + df[:-1]))
    idf = np.where(idf < 0.5, 0.0, idf)      # words of most documents say nothing
    for _, words, _ in block.items:          # but an item that most documents hold keeps its words
        ids = [block.vocab[w] for w in words]
        if 2 * np.count_nonzero(idf[ids]) < len(ids):
            idf[ids] = np.maximum(idf[ids], 0.5)
    spark = docs.sparkSession
    passages = []
    for _, words, _ in block.items:
        for part in segments(words):
            ids = [block.vocab[w] for w in part]
            counts = np.bincount(np.unique(ids, return_inverse=True)[1])
            size = float(np.sqrt(((idf[np.unique(ids)] * counts) ** 2).sum())) or 1.0  # unit rows: short items count as much
            passages.append((ids, [float(idf[i]) / size for i in ids]))
    frame = spark.createDataFrame(passages, _ROW).repartition(max(1, min(64, len(passages) // 256)))
    block.fit(idf, randomised_svd(frame, len(block.vocab), min(rank, len(passages), len(block.vocab))))


def _units(block: Block, feature: np.ndarray, unit: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Latent sums of the units ``lo`` to ``hi`` (exclusive); word by word of all units at once, longest first."""
    z = np.zeros((hi - lo, block.project.shape[1]), np.float32)
    begin, end = np.searchsorted(unit, (lo, hi))
    there, start, count = np.unique(unit[begin:end], return_index=True, return_counts=True)
    order = np.argsort(-count, kind="stable")
    there, start, count = there[order] - lo, start[order] + begin, count[order]
    for at in range(0, len(there), 1024):          # few enough units that their sums stay in the cache
        most = count[at:at + 1024]
        first = start[at:at + 1024]
        total = block.project[feature[first]]
        for k in range(1, int(most[0])):
            m = int(np.searchsorted(-most, -k, "left"))   # units with more than k words
            total[:m] += block.project.take(feature[first[:m] + k], axis=0)
        z[there[at:at + 1024]] = total
    return z


def _candidates(block: Block, feature: np.ndarray, unit: np.ndarray, total: int, stride: int) -> dict[int, list]:
    """For each stride: (passages, items, cosines) of all candidates; units are of ``stride`` words."""
    found: dict[int, list] = {s: [] for s in block.queries}
    for lo in range(0, total, PIECE):
        hi = min(total, lo + PIECE)
        z = _units(block, feature, unit, lo, min(total, hi + STRIDE // stride))   # the next piece's first unit of every stride
        for s, (queries, length, owner) in block.queries.items():
            k = s // stride
            x = z[:len(z) // k * k].reshape(-1, k, z.shape[1]).sum(axis=1) if k > 1 else z
            x = x[:(hi - lo) // k + 1]
            x = x[:-1] + x[1:]                                 # passages of two units
            size = np.sqrt(np.einsum("ij,ij->i", x, x))
            some = np.nonzero(size >= COVER * length.min())[0]
            for a in range(0, len(some), 8192):
                at = some[a:a + 8192]
                dot = x[at] @ queries
                p, q = np.nonzero((dot >= COVER * length[None, :]) & (dot >= COSINE * size[at][:, None]))
                found[s].append((at[p] + lo // k, owner[q], dot[p, q] / size[at[p]]))
    return found


def _share(block: Block, j: int, region: list[bytes], lcs: float) -> float:
    """Share of the item's words that stand in order in the region, 0 if too few."""
    mask, n = block.masks[j], len(block.items[j][1])
    common = lcs_length(mask, n, region)
    if stride_of(n) == STRIDE:
        return common / n if common >= lcs * n else 0.0
    needed, span = max(lcs * n, min(n, SHORT)), n + n // 2
    if common < needed:
        return 0.0
    common = max(lcs_length(mask, n, region[i:i + span]) for i in range(max(1, len(region) - span + 1)))
    return common / n if common >= needed else 0.0


def _search(block: Block, ids: list, texts: list, lcs: float, answer: float) -> list[tuple]:
    """Hits of the block's items in some documents."""
    docs = [words_of(t) for t in texts]
    get = block.vocab.get
    stride = min(block.queries)
    feature, unit, starts, total = [], [], [], 0       # starts: the documents' first units of STRIDE words
    for words in docs:
        f = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
        at = np.nonzero(f >= 0)[0]
        feature.append(f[at])
        unit.append(at // stride + total * (STRIDE // stride))
        starts.append(total)
        total += -(-len(words) // STRIDE) + 1          # an empty unit parts documents
    feature, unit = np.concatenate(feature), np.concatenate(unit)
    live = block.idf[feature] > 0
    feature, unit = feature[live], unit[live]
    if not len(feature):
        return []
    found: dict[tuple[int, int], list[tuple[int, float]]] = {}
    begins = np.array(starts)
    for s, parts in _candidates(block, feature, unit, total * (STRIDE // stride), stride).items():
        for at, item, cosine in parts:
            d = np.searchsorted(begins, at * s // STRIDE, "right") - 1
            first = at * s - begins[d] * STRIDE        # the passage's first word in its document
            for key, w, c in zip(zip(d.tolist(), item.tolist()), first.tolist(), cosine.tolist()):
                found.setdefault(key, []).append((w, c))
    hits, held = [], {}
    for (d, j), passages in found.items():
        rare = block.answers[j]
        if d not in held:
            held[d] = frozenset(docs[d])
        if sum(w in held[d] for w in rare) < answer * len(rare):    # what the document lacks, no passage has
            continue
        item, words, _ = block.items[j]
        best, n, width, behind = None, len(words), 2 * stride_of(len(words)), -1
        for w, cosine in sorted(passages):
            if w < behind:                             # the region of an earlier segment holds this one
                continue
            region = docs[d][max(0, w - n):w + width + n]
            share = _share(block, j, region, lcs)
            if share and (best is None or share > best[1]):
                there = set(region)
                given = sum(x in there for x in rare) / len(rare)
                if given >= answer:
                    best = (cosine, share, given, max(0, w))
                    if n > width:
                        behind = w + n - width
        if best:
            hits.append((ids[d], item, *best))
    return hits


def contaminated(docs: DataFrame, benchmark: DataFrame, *, rank: int = RANK, lcs: float = LCS,
                 answer: float = ANSWER) -> DataFrame:
    """One row per document row and benchmark item found in it: ``doc_id, item_id, cosine, lcs,
    answer, first_word`` (where the best passage starts).

    NULL and empty texts hold nothing; items of fewer than ``MIN_WORDS`` words are not searched.
    Equal items are each found; repeated rows give repeated hits; NULL ids stay NULL.  An empty
    corpus or benchmark gives no rows.  Only the id and text columns are read.
    """
    spark = docs.sparkSession
    schema = arrow(HIT_SCHEMA)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    out = None
    for part in _blocks(items):
        block = Block(part)
        if not block.items:
            continue
        _fit(docs, block, rank)
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            for batch in batches:
                ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
                hits = []
                for at in range(0, len(ids), DOCS):
                    hits += _search(shared.value, ids[at:at + DOCS], texts[at:at + DOCS], lcs, answer)
                cols = list(zip(*hits)) or [[] for _ in schema]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        found = id_text(docs).mapInArrow(lean(run), HIT_SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], HIT_SCHEMA)


def _blocks(items: DataFrame):
    """Blocks of at most BLOCK_CHARS characters (one item may exceed it), read one after another."""
    block, size = [], 0
    for item_id, text in items.orderBy("item_id", "text").toLocalIterator():
        if block and size + len(text) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((item_id, text))
        size += len(text)
    if block:
        yield block
