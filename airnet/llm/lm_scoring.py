"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A text is its words (A-Z lower-cased, parted by ASCII white space) and one end.  Frequent words,
the end and an escape are symbols with a prefix code by training counts; a word without a
symbol is the escape and its bytes.  Every code bit is predicted from several contexts:

* its place in the code alone (order 0), exactly from the symbol counts;
* hashed (last frequent symbol, place), which tells the language and register, and (two previous
  symbols, place): bit counts in tables of ``SLOTS`` slots, gathered from all training texts, each
  resting on the shorter context's prediction as a prior worth ``STRENGTH`` bits;
* other frequent words, listed with their discounted counts, are one more choice after the escape;
* spelled bytes of the words that are left: hashed contexts of two to five bytes before, gathered from all training words
  without a symbol, each once, and mixed by their evidence.

The predictions' log odds are mixed with weights that a gate selects (how often the two hashed
contexts were seen) and that are learned online: after each word they move along the gradient
of the coding cost.  An adaptive stage then refines the mixed probability by what it predicted
before.  Weights and adaptive stage start anew every ``SEGMENT`` words, so that long texts
run side by side; the contexts run on.  The score is the log10 probability of all bits; over all
word sequences the probabilities sum to at most 1; ``bits_per_byte`` divides it by the text's bytes.

Scale: word counts are a grouped aggregate; tables are partial sums of fixed-size blocks.  Only
the most frequent words (``SYMBOLS`` and ``KNOWN``, at most ``MAX_WORD`` bytes each) and the
tables (fixed size) are broadcast.  Counts of all other words reach their documents by a join.
"""
from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, LongType, StructField,
                               StructType)

from airnet.llm.common import arrow, id_text, rows
from airnet.session import materialize

SYMBOLS = 32_768
KNOWN = 131_072            # words whose training count is broadcast
MAX_WORD = 64              # bytes of a word that may be broadcast
SLOTS = 1 << 20            # of each hashed context table
SPELL_SLOTS = 1 << 20
SPELL_ORDERS = (2, 3, 4, 5)
FREQUENT = 256             # symbols that serve as the wide context
SEGMENT = 256
STRENGTH = (3.0, 3.0)      # of the shorter context's prediction as a prior, in seen bits
START = (0.3, 0.3, 0.4)     # mixing weights at the begin of a segment
RATE = 0.02                # of the mixing weights
APM_RATE = 0.02
PRIOR = 0.4                # of each bit in a context table
BLOCK = 1 << 15            # slots in a partial sum
FLUSH = 300_000            # different words a counting task holds
BUFFER = 1_200_000         # code bits handled at once
SPELL_CACHE = 300_000
SPELL_BYTES = 100_000      # of words spelled at once

_COUNT = StructType([StructField("w", BinaryType(), False), StructField("n", LongType(), False)])
_PART = StructType([StructField("table", IntegerType(), False), StructField("block", IntegerType(), False),
                    StructField("part", BinaryType(), False)])
_RARE = StructType([StructField("w", BinaryType(), False), StructField("m", IntegerType(), False)])
SCORED = StructType([
    StructField("rid", LongType(), False), StructField("doc_id", LongType()), StructField("held_out", BooleanType(), False),
    StructField("n_bytes", LongType(), False), StructField("n_tokens", LongType(), False),
    StructField("n_known", LongType(), False), StructField("log_counts", DoubleType(), False),
    StructField("score", DoubleType(), False), StructField("rare", ArrayType(_RARE, False), False)])


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased; bytes.split and bytes.lower know ASCII only."""
    return (text or "").encode("utf-8", "replace").lower().split()


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(7)) == 2


def _batch(out: list, schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*out)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _scored_batch(heads: list[tuple], scores: list[float], rare: list[dict[bytes, int]], schema: pa.Schema) -> pa.RecordBatch:
    """Rows of ``SCORED``: what stands before the score, the scores, the words with no broadcast count."""
    cols = list(zip(*heads)) or [[] for _ in schema.names[:-2]]
    cols = [pa.array(c, f.type) for c, f in zip([*cols, scores], schema)]
    kind = schema.field("rare").type
    fields = [kind.value_type.field(i) for i in range(2)]
    words = pa.array([w for r in rare for w in r], fields[0].type), pa.array([m for r in rare for m in r.values()], fields[1].type)
    ends = pa.array(np.cumsum([0, *map(len, rare)]), pa.int32())
    cols.append(pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(words, fields=fields), type=kind))
    return pa.RecordBatch.from_arrays(cols, schema=schema)


# ---- counts ---------------------------------------------------------------------------------------

def word_counts(train: DataFrame) -> DataFrame:
    """Training count of every word (the end is the empty word), partial sums per task first."""
    schema = arrow(_COUNT)

    def run(batches):
        seen: Counter = Counter()
        for batch in batches:
            for (text,) in rows(batch, "text"):
                seen.update(words_of(text))
                seen[b""] += 1
            if len(seen) > FLUSH:
                yield _batch(list(seen.items()), schema)
                seen.clear()
        yield _batch(list(seen.items()), schema)

    return train.select("text").mapInArrow(run, _COUNT).groupBy("w").agg(F.sum("n").alias("n"))


def _least_count(counts: DataFrame, most: int) -> int:
    """Smallest count that at most ``most`` words reach."""
    total, least = 0, (1 << 62)
    for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.col("n").desc()).toLocalIterator():
        total += r["words"]
        if total > most:
            break
        least = r["n"]
    return least


# ---- the code -------------------------------------------------------------------------------------

def code_lengths(counts: list[int]) -> list[int]:
    """Huffman code lengths."""
    parent: dict[int, int] = {}
    nodes = [(c, i) for i, c in enumerate(counts)]
    heapq.heapify(nodes)
    fresh = len(counts)
    while len(nodes) > 1:
        (c1, a), (c2, b) = heapq.heappop(nodes), heapq.heappop(nodes)
        parent[a] = parent[b] = fresh
        heapq.heappush(nodes, (c1 + c2, fresh))
        fresh += 1
    depth = [0] * fresh
    for i in range(fresh - 2, -1, -1):
        depth[i] = depth[parent[i]] + 1
    return [max(1, d) for d in depth[:len(counts)]]


class Code:
    """Prefix code of the symbols: for each, its inner nodes and bits, laid end to end."""

    def __init__(self, counts: list[int]):
        lengths = np.array(code_lengths(counts))
        order = np.lexsort((np.arange(len(lengths)), lengths))
        self.at = np.zeros(len(counts) + 1, np.int64)
        self.at[1:] = np.cumsum(lengths)
        self.bits = np.zeros(self.at[-1], np.int8)
        self.nodes = np.zeros(self.at[-1], np.int32)
        number: dict[tuple[int, int], int] = {}
        code, last = 0, 0
        for s in order.tolist():
            n = int(lengths[s])
            code <<= n - last
            last = n
            for k in range(n):
                self.bits[self.at[s] + k] = (code >> (n - 1 - k)) & 1
                self.nodes[self.at[s] + k] = number.setdefault((k, code >> (n - k)), len(number))
            code += 1
        self.size = len(number)
        self.lengths = np.diff(self.at)
        owner = np.repeat(np.asarray(counts, float), self.lengths)
        ones = np.bincount(self.nodes, weights=owner * self.bits, minlength=self.size)
        total = np.bincount(self.nodes, weights=owner, minlength=self.size)
        p = (ones + 0.02) / (total + 0.04)
        self.stretch = np.log(p / (1 - p)).astype(np.float32)
        self.alone = 1 / (1 + np.exp(-self.stretch))            # order 0 alone
        self.hashes = hashed(np.arange(self.size) + (1 << 40))

    def expand(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For the symbols in a row: index into ``nodes``/``bits`` of every code bit, and its symbol's place."""
        n = self.lengths[symbols]
        place = np.repeat(np.arange(len(symbols)), n)
        ends = np.cumsum(n)
        index = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n) + np.repeat(self.at[symbols], n)
        return index, place


def slots(context: np.ndarray, node: np.ndarray, size: int) -> np.ndarray:
    """Table slots of (context, node), both hashed already: the high bits of their sum."""
    out = context + node
    out >>= np.uint64(64 - size.bit_length() + 1)
    return out.view(np.int64)


def hashed(x: np.ndarray) -> np.ndarray:
    h = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h * np.uint64(0xBF58476D1CE4E5B9)


class Model:
    """What the tasks share: symbols, code and, once fitted, the tables."""

    def __init__(self, words: list[bytes], counts: list[int], escape: int):
        # symbol 0 is the escape, 1 the end; the rest are words
        self.words = words
        self.number = {w: i + 2 for i, w in enumerate(words)}
        self.number[b""] = 1
        self.code = Code([max(escape, 1), max(counts[0], 1)] + counts[1:])
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []
        self.ready: list[np.ndarray] = []
        self.place = {w: i for i, w in enumerate(words)}   # of the symbols' words, then of the listed ones
        self.listed: dict[bytes, float] = {}   # -ln P of a word without a symbol, the escape given
        self.list_costs = np.full(len(words) + 1, np.nan)   # the same by place; none for a word without a place (-1)
        self.unlisted = 0.0                    # -ln P of any other word, before its bytes

    def list_words(self, counts: dict[bytes, int], all_tokens: int, once: int, twice: int) -> None:
        """Words without a symbol that are listed with their counts: after an escape each has its
        discounted share of the ``all_tokens`` tokens without a symbol; what is left is spelled.
        The discount is that of words seen ``once`` and ``twice`` (numbers of words)."""
        discount = once / (once + 2 * twice) if once else 0.5
        rest = all_tokens + 1.0
        for w, n in counts.items():
            if w not in self.number:
                self.listed[w] = math.log((all_tokens + 1) / (n - discount * 0.999))
                rest -= n - discount * 0.999
        self.unlisted = math.log((all_tokens + 1) / rest)
        self.place = {w: i for i, w in enumerate([*self.words, *self.listed])}
        self.list_costs = np.array([*[math.nan] * len(self.words), *self.listed.values(), math.nan])

    def prepare(self) -> None:
        """The tables as scoring reads them, once per task: (ones, all) of the contexts, and
        (weight times log odds, weight) of the spelling orders, side by side."""
        for k, (odds, seen) in enumerate(self.tables):
            odds = odds.astype(np.float32)
            if k < 2:
                every = np.exp2(seen.astype(np.float32) / 8) - 1
                ones = (every + 2 * PRIOR) / (1 + np.exp(-odds)) - PRIOR
                self.ready.append(np.stack([np.clip(ones, 0, every), every], axis=1))
            else:
                weight = seen.astype(np.float32) * np.float32(k - 1)
                self.ready.append(np.stack([weight * odds, weight], axis=1))

    def places(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.place.get, words, repeat(-1)), np.int32, len(words))

    def symbols_at(self, places: np.ndarray) -> np.ndarray:
        """As ``symbols``, of words whose places are known."""
        out = np.ones(len(places) + 1, np.int32)
        out[:-1] = np.where((places >= 0) & (places < len(self.words)), places + 2, 0)
        return out

    def symbols(self, words: list[bytes]) -> np.ndarray:
        out = np.empty(len(words) + 1, np.int32)
        out[:-1] = np.fromiter(map(self.number.get, words, repeat(0)), np.int32, len(words))
        out[-1] = 1
        return out

    def contexts(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of the texts in a row with their two hashed contexts (a text starts with end, end)."""
        flat = np.concatenate(texts)
        begin = np.cumsum([0] + [len(t) for t in texts[:-1]])
        text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        # a text starts with end, end; an escape is no context, the symbol before it is
        def last(ok: np.ndarray) -> np.ndarray:
            at = np.maximum.accumulate(np.where(ok, np.arange(len(flat)), -1))
            before = np.concatenate([[-1], at[:-1]])
            return np.where(before >= begin[text], flat[before], 1).astype(np.int64)

        wide = last((flat > 1) & (flat < FREQUENT + 2))
        c1 = last(flat > 0)
        c2 = np.concatenate([[1], c1[:-1]])
        c2[begin] = 1
        return flat, hashed(wide), hashed(c1 * 65_536 + c2 + (1 << 33))


# ---- spelled words ----------------------------------------------------------------------------------

_BYTE, _PLACE = np.arange(256)[:, None], np.arange(8)
SPELL_BITS = ((_BYTE >> (7 - _PLACE)) & 1).astype(np.int8)          # of each byte, the first bit first
SPELL_NODES = hashed((1 << _PLACE) + (_BYTE >> (8 - _PLACE)) + (1 << 41))


def spelled_bytes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of words, each closed by a zero byte, and the number of the word of each."""
    data = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    return data, np.repeat(np.arange(len(words)), size)


def spelled_slots(data: np.ndarray, word: np.ndarray):
    """For each of ``SPELL_ORDERS``: the slots of all bits of the bytes, one row a byte."""
    node, wide = SPELL_NODES[data], data.astype(np.int64)
    context = np.zeros(len(data), np.int64)
    for back in range(1, max(SPELL_ORDERS) + 1):
        b = np.zeros(len(data), np.int64)
        b[back:] = wide[:-back] * (word[back:] == word[:-back])
        context = context * 257 + b + 1
        if back in SPELL_ORDERS:
            yield slots(hashed(context + (back << 50))[:, None], node, SPELL_SLOTS)


# ---- gathering the tables -----------------------------------------------------------------------------

def gather(train: DataFrame, counts: DataFrame, model) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ones, all) counts of the two context tables over all training texts, and of the spelling
    tables over the counted words that are no symbols, each once however the texts are dealt."""
    schema = arrow(_PART)
    sizes = [SLOTS, SLOTS] + [SPELL_SLOTS] * len(SPELL_ORDERS)

    def blank(tables) -> dict[int, np.ndarray]:
        return {t: np.zeros(2 * sizes[t], np.uint32) for t in tables}  # zeros and ones of a slot side by side

    def add(sums: np.ndarray, slot: np.ndarray, bit: np.ndarray) -> None:
        slot <<= 1
        slot += bit
        np.add.at(sums, slot.ravel(), np.uint32(1))

    def blocks(sums: dict[int, np.ndarray]):
        for t, s in sums.items():
            s = s.reshape(-1, 2)
            s = np.stack([s[:, 1], s[:, 0] + s[:, 1]])
            for at in range(0, sizes[t], BLOCK):
                part = s[:, at:at + BLOCK]
                if part[1].any():
                    yield _batch([(t, at // BLOCK, zlib.compress(part.astype("<u4").tobytes(), 1))], schema)

    def contexts(batches):
        m: Model = model.value
        sums = blank((0, 1))

        def close(texts: list) -> None:
            flat, *found = m.contexts(texts)
            index, place = m.code.expand(flat)
            node, bit = m.code.hashes[m.code.nodes[index]], m.code.bits[index]
            for t, c in enumerate(found):
                add(sums[t], slots(c[place], node, SLOTS), bit)

        texts, held = [], 0
        for batch in batches:
            for (text,) in rows(batch, "text"):
                texts.append(m.symbols(words_of(text)))
                held += len(texts[-1])
                if held * 10 > BUFFER:
                    close(texts)
                    texts, held = [], 0
        if texts:
            close(texts)
        yield from blocks(sums)

    def spelling(batches):
        m: Model = model.value
        sums = blank(range(2, len(sizes)))

        def close(words: list[bytes]) -> None:
            data, word = spelled_bytes(words)
            for i, slot in enumerate(spelled_slots(data, word)):
                add(sums[2 + i], slot, SPELL_BITS[data])

        words, held = [], 0
        for batch in batches:
            for (w,) in rows(batch, "w"):
                if w not in m.number:
                    words.append(w)
                    held += len(w) + 1
                    if held > SPELL_BYTES:
                        close(words)
                        words, held = [], 0
        if words:
            close(words)
        yield from blocks(sums)

    def packed(key, total) -> tuple:
        # log odds and the size of the evidence: 3 bytes a slot
        ones, every = total.reshape(2, BLOCK).astype(float)
        prior = PRIOR if key[0] < 2 else 0.05
        p = (ones + prior) / (every + 2 * prior)
        seen = np.minimum(np.log2(every + 1) * 8, 255).astype("u1")
        return (*key, np.log(p / (1 - p)).astype("<f2").tobytes() + seen.tobytes())

    def summed(batches):
        now, total = None, None
        for batch in batches:
            out = []
            for table, block, part in rows(batch, "table", "block", "part"):
                if (table, block) != now:
                    if now:
                        out.append(packed(now, total))
                    now, total = (table, block), np.zeros(2 * BLOCK, np.uint64)
                total += np.frombuffer(zlib.decompress(part), "<u4")
            yield _batch(out, schema)
        if now:
            yield _batch([packed(now, total)], schema)

    parts = train.select("text").mapInArrow(contexts, _PART).unionByName(counts.select("w").mapInArrow(spelling, _PART))
    parts = parts.repartition("table", "block").sortWithinPartitions("table", "block").mapInArrow(summed, _PART)
    out = [(np.zeros(s, np.float16), np.zeros(s, np.uint8)) for s in sizes]
    for t, b, packed in parts.collect():  # fixed size: 3 bytes a slot
        at = b * BLOCK
        out[t][0][at:at + BLOCK] = np.frombuffer(packed[:2 * BLOCK], "<f2")
        out[t][1][at:at + BLOCK] = np.frombuffer(packed[2 * BLOCK:], "u1")
    return out


# ---- scoring ----------------------------------------------------------------------------------------

def _cost(z: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """-ln P(bit) for log odds z of a one."""
    out = np.exp(np.where(bit > 0, -z, z))
    out += 1
    return np.log(out, out=out)


def spell_costs(model: Model, words: list[bytes]) -> np.ndarray:
    """-ln P of the bytes of each word: mean of the log odds, each weighted by its evidence."""
    data, word = spelled_bytes(words)
    total = np.zeros((len(data), 8, 2), np.float32)
    total[..., 1] = 0.05
    for k, slot in enumerate(spelled_slots(data, word)):
        total += model.ready[2 + k].take(slot, axis=0)
    each = _cost(total[..., 0] / total[..., 1], SPELL_BITS[data]).sum(axis=1)
    return np.bincount(word, weights=each, minlength=len(words))


def mix(model: Model, flat: np.ndarray, c1: np.ndarray, c2: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """-ln P of every symbol; ``segment``: number of the segment each symbol lies in (non-decreasing)."""
    code = model.code
    n_seg = int(segment[-1]) + 1
    begin = np.searchsorted(segment, np.arange(n_seg))
    step = np.arange(len(flat)) - begin[segment]
    order = np.lexsort((segment, step))                     # step by step, all segments side by side
    index, place = code.expand(flat[order])
    node, bit = code.nodes[index], code.bits[index]
    token_c1, token_c2 = c1[order], c2[order]
    inputs = [code.stretch.take(node)]
    p = code.alone.take(node)
    node = code.hashes.take(node)
    size = code.lengths[flat[order]]
    first = np.cumsum(size) - size                          # first bit of each symbol
    gate = np.zeros(len(flat), np.int64)
    for k, c in enumerate((token_c1, token_c2)):
        slot = slots(c[place], node, SLOTS)
        found = model.ready[k].take(slot, axis=0)           # what was seen, on the shorter context's prediction
        p = (found[:, 0] + np.float32(STRENGTH[k]) * p) / (found[:, 1] + np.float32(STRENGTH[k]))
        np.clip(p, 1e-6, 1 - 1e-6, out=p)
        inputs.append(np.log(p / (1 - p)))
        gate = gate * 6 + np.minimum(model.tables[k][1].take(slot[first]) >> 4, 5)
    seg_sorted = segment[order]
    gate += seg_sorted * 36
    weights = [np.full(n_seg * 36, w, np.float32) for w in START]
    # adaptive stage: 24 cells of log odds, start at their middle
    cells = np.tile(((np.arange(24) - 11.5) * 0.75).astype(np.float32), n_seg)
    bounds = np.searchsorted(step[order], np.arange(int(step.max()) + 2))
    target, row = bit.astype(np.float32), seg_sorted * 24
    mixed = np.empty(len(index), np.float32)
    for t in range(len(bounds) - 1):
        a, b = bounds[t], bounds[t + 1]
        lo, hi = first[a], first[b] if b < len(flat) else len(index)
        g = gate[a:b]
        x, y = [i[lo:hi] for i in inputs], target[lo:hi]
        w = [v.take(g) for v in weights]
        owner = place[lo:hi] - a
        z = w[0].take(owner) * x[0]
        z += w[1].take(owner) * x[1]
        z += w[2].take(owner) * x[2]
        np.clip(z, -14, 14, out=z)
        cell = (z * np.float32(1 / 0.75) + np.float32(12)).astype(np.int64)
        np.clip(cell, 0, 23, out=cell)
        cell += row.take(place[lo:hi])
        refined = cells.take(cell)
        mixed[lo:hi] = np.float32(0.7) * z + np.float32(0.3) * refined
        error = y - 1 / (1 + np.exp(-z))
        at = first[a:b] - lo
        for v, old, i in zip(weights, w, x):
            v[g] = old + np.float32(RATE) * np.add.reduceat(error * i, at)
        q = 1 / (1 + np.exp(-refined))
        cells[cell] = refined + np.float32(APM_RATE) * (y - q) / np.maximum(q * (1 - q), np.float32(0.05))
    out = np.empty(len(flat))
    out[order] = np.add.reduceat(_cost(mixed, bit), first)
    return out


def score_texts(model: Model, texts: list[list[bytes]], spelled: dict[bytes, float],
                places: list[np.ndarray] | None = None) -> list[float]:
    """log10 P of each text (as words); ``places`` of the words, if known."""
    if not model.ready:
        model.prepare()
    places = places or [model.places(w) for w in texts]
    symbols = [model.symbols_at(p) for p in places]
    others = [[ws[i] for i in np.flatnonzero(p < 0).tolist()] for ws, p in zip(texts, places)]
    every = set().union(*others)
    new = every.difference(spelled)
    if len(spelled) + len(new) > SPELL_CACHE:
        spelled.clear()
        new = every
    new = sorted(new)
    for at in range(0, len(new), 10_000):
        part = new[at:at + 10_000]
        spelled.update(zip(part, (spell_costs(model, part) + model.unlisted).tolist()))
    flat, c1, c2 = model.contexts(symbols)
    sizes = [len(s) for s in symbols]
    segment = np.concatenate([np.arange(n) // SEGMENT for n in sizes])
    text = np.repeat(np.arange(len(sizes)), sizes)
    fresh = np.ones(len(flat), bool)
    fresh[1:] = (segment[1:] != segment[:-1]) | (text[1:] != text[:-1])
    costs = mix(model, flat, c1, c2, np.cumsum(fresh) - 1)
    total = np.bincount(text, weights=costs, minlength=len(sizes))
    for i, (p, s, words) in enumerate(zip(places, symbols, others)):
        p = p[s[:-1] == 0]
        cost = model.list_costs.take(p)
        cost[p < 0] = [spelled[w] for w in words]
        total[i] += sum(cost.tolist())
    return (-total / math.log(10)).tolist()


def lm_scores(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): ``doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score, n_bytes, bits_per_byte``.

    Learns from the rows whose crc32(doc_id as text) mod 7 is not 2 (a NULL id counts as the
    empty text).  ``base_score``: add-one unigram log10 probability.  NULL text is empty: one
    token, the end.  Repeated rows count and are scored each.  Without training rows all counts
    are 0 and every word is spelled.  Other columns are not read.
    """
    spark = docs.sparkSession
    base = id_text(docs).withColumn("held_out", held_out(F.col("doc_id")))
    train = base.where(~F.col("held_out"))
    counts = materialize(word_counts(train), "counts")
    n_total, n_types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    short = counts.where((F.octet_length("w") <= MAX_WORD) & (F.col("w") != F.lit(b"")))
    least = _least_count(short, KNOWN)
    top = sorted(short.where(F.col("n") >= least).collect(), key=lambda r: (-r["n"], r["w"]))  # at most KNOWN
    ends = counts.where(F.col("w") == F.lit(b"")).select("n").first()
    ends = ends["n"] if ends else 0
    symbol_words = [bytes(r["w"]) for r in top[:SYMBOLS] if r["n"] > 1]
    symbol_counts = [r["n"] for r in top[:SYMBOLS] if r["n"] > 1]
    model = Model(symbol_words, [ends] + symbol_counts, n_total - ends - sum(symbol_counts))
    sizes = {r["n"]: r["words"] for r in counts.where((F.col("n") <= 2) & (F.col("w") != F.lit(b"")))
             .groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect()}   # at most two rows
    without = n_total - ends - sum(symbol_counts)
    first = spark.sparkContext.broadcast(model)
    model.tables = gather(train, counts, first)
    shared = spark.sparkContext.broadcast((model, {bytes(r["w"]): r["n"] for r in top}))
    schema = arrow(SCORED)
    log_ends = math.log10(ends + 1)

    def run(batches):
        m, known = shared.value
        if not m.listed:
            m.list_words(known, without, sizes.get(1, 0), sizes.get(2, 0))
        spelled: dict[bytes, float] = {}
        logs = np.array([math.log10(known[w] + 1) for w in m.place])
        task, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts, places, heads, rare, held = [], [], [], [], 0

            def close():
                return _scored_batch(heads, score_texts(m, texts, spelled, places) if texts else [], rare, schema)

            for doc_id, text, out_of in rows(batch, "doc_id", "text", "held_out"):
                words = words_of(text)
                at = m.places(words)
                found = at[at >= 0]
                heads.append(((task << 40) | row, doc_id, out_of, len((text or "").encode()), len(words) + 1,
                              len(found) + (ends > 0), math.fsum(logs.take(found).tolist()) + log_ends))
                rare.append(Counter([words[i] for i in np.flatnonzero(at < 0).tolist()] if len(found) < len(at) else ()))
                row += 1
                texts.append(words)
                places.append(at)
                held += len(words) + 1
                if held * 10 > BUFFER:
                    yield close()
                    texts, places, heads, rare, held = [], [], [], [], 0
            yield close()

    scored = materialize(base.mapInArrow(run, SCORED), "scored")
    # counts of the words that were not broadcast
    rare = scored.select("rid", F.explode("rare").alias("r")).select("rid", F.col("r.w").alias("w"), F.col("r.m").alias("m"))
    late = (rare.join(counts, "w", "inner").groupBy("rid")
            .agg(F.sum("m").alias("late"), F.sum(F.col("m") * F.log10(F.col("n") + 1)).alias("late_logs")))
    out = scored.drop("rare").join(late, "rid", "left")
    norm = math.log10(n_total + n_types + 1)
    logs = F.col("log_counts") + F.coalesce("late_logs", F.lit(0.0))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("late", F.lit(0))).cast("long").alias("n_known"),
                      F.lit(n_total).cast("long").alias("train_tokens"), (logs - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
                      "score", "n_bytes",
                      (-F.col("score") * F.lit(math.log2(10)) / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"))
