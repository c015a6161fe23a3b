"""Hierarchical multi-length packing of tokenised documents.

Every task tokenises its documents and packs them by itself, so nothing is shuffled and
memory is bounded by a pool of pending pieces:

* full windows of the largest tier are cut off a document first;
* the rest is routed to the smallest tier (context size) that holds it;
* each tier packs its pieces largest first, and the gap of a window is filled with the
  largest pieces that fit, from its own tier, then from shorter ones; what is still free is
  filled by cutting a shorter piece (its tail goes back to its own tier);
* what is left at the end of a task is cut into powers of two.

Every sequence therefore holds exactly its tier's size or a smaller power of two, without
padding.  Step groups: the sequences of one size are numbered inside a task and
``step_tokens / size`` of them make a step, so all full steps hold the same number of tokens
and one shape.  Sequence ids start with the task's partition number; a retried task reads
the same partition and gives the same rows.
"""
from __future__ import annotations

import zlib
from bisect import bisect_right, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from airnet.llm.common import arrow, give_back, id_text, lean

TIERS = (4096, 2048, 1024, 512)
POOL = 2_048           # pending pieces of a task (each below the largest tier)
CACHE_SIZE = 800_000     # words; their ids lie in one array
SLICE_BYTES = 1 << 21    # of texts whose words are looked up at once; a longer text is one slice
STEP_TOKENS = 8 * 4096
PUNCT = ".,;:!?#*$%&"
SLICE_ROWS = 500
SCRIPTS_END = chr(0x530)   # Latin, Greek and Cyrillic lie before it

PIECE_SCHEMA = StructType(
    [StructField("doc_id", LongType())]
    + [StructField(c, LongType(), False) for c in ("start", "length", "ids_crc32", "doc_tokens",
                                                   "sequence_id", "offset")]
    + [StructField("tier", IntegerType(), False), StructField("step_id", LongType(), False)])


class WordEncoder:
    """Ids of whole texts, word by word through a bounded cache.

    White space ends every pre-token of the tokenizer and is dropped, so a text's ids are
    those of its white-space separated words in a row.  A word of letters and trailing
    punctuation is encoded as these two parts, which the tokenizer separates as well, if the word is still
    all letters in lower case (a dotted capital I is not: its dot would join the punctuation)
    and its script is one whose letters all versions of Unicode agree on; any other word is encoded whole.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.end = end_id.to_bytes(4, "little")
        vocab = self.tok.get_vocab()
        self.closing = np.zeros(max(vocab.values()) + 1, bool)
        self.closing[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        # row of each known word; the ids of row i lie at data[at[i]:at[i + 1]]
        self.row: dict[str, int] = {}
        self.at, self.data = np.zeros(1 << 16, np.int64), np.empty(1 << 18, "<u4")

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _store(self, words: list[str], ids: np.ndarray, length: np.ndarray) -> None:
        """New rows: words not known yet, their ids in a row and the number of each."""
        n, k = len(self.row), len(words)
        self.row.update(zip(words, range(n, n + k)))
        self.at, self.data = _room(self.at, n + k + 1), _room(self.data, int(self.at[n]) + len(ids))
        self.data[self.at[n]:self.at[n] + len(ids)] = ids
        self.at[n + 1:n + k + 1] = self.at[n] + np.cumsum(length)

    def _apart(self, words: list[str]) -> None:
        ids = self._encode(words)
        self._store(words, np.array([x for i in ids for x in i], "<u4"), np.array(list(map(len, ids)), np.int64))

    def _letters(self, words: list[str]) -> None:
        """Each word is letters only, hence one pre-token that ends with a closing piece."""
        for at in range(0, len(words), 2_000):
            part = words[at:at + 2_000]
            ids = np.array(self._encode([" ".join(part)])[0], "<u4")
            stops = np.flatnonzero(self.closing[ids]) + 1
            if len(stops) == len(part) and stops[-1] == len(ids):
                self._store(part, ids, np.diff(stops, prepend=0))
            else:  # a word that breaks the rule
                self._apart(part)

    def _laid(self, rows_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the rows in a row, and where each begins (and the last ends)."""
        start = self.at[rows_]
        n = self.at[rows_ + 1] - start
        ends = np.zeros(len(rows_) + 1, np.int64)
        np.cumsum(n, out=ends[1:])
        place = np.arange(ends[-1])
        place += np.repeat(start - ends[:-1], n)
        return self.data[place], ends

    def add(self, words: list[str]) -> None:
        """Rows for different words, none of them known."""
        letters, tailed, other = [], [], []
        for w in words:
            core = w.rstrip(PUNCT)
            if core.isalpha() and (core.isascii() or max(core) < SCRIPTS_END and core.lower().isalpha()):
                if len(core) == len(w):
                    letters.append(w)
                else:
                    tailed.append((w, core, w[len(core):]))
            else:
                other.append(w)
        row = self.row
        self._letters(letters)
        self._letters(list({core for _, core, _ in tailed}.difference(row)))
        self._apart(other)
        self._apart(list({end for _, _, end in tailed}.difference(row)))
        tailed = [x for x in tailed if x[0] not in row]
        both = np.array([row[x] for _, core, end in tailed for x in (core, end)], np.int64)
        ids, ends = self._laid(both)
        self._store([w for w, _, _ in tailed], ids, np.diff(ends[::2]))

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, the end id behind them."""
        texts = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, "")
        # separators x1c-x1f split words for Arrow but not for the tokenizer
        apart = np.flatnonzero(pc.match_substring_regex(texts, "[\x1c-\x1f]").to_numpy(zero_copy_only=False))
        out: list[bytes] = []
        size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + SLICE_BYTES, "right")))
            out += self._slice(texts.slice(at, stop - at))
            at = stop
        for i in apart.tolist():
            out[i] = pack_ids(self._encode([texts[i].as_py()])[0]) + self.end
        return out

    def _slice(self, texts: pa.Array) -> list[bytes]:
        """As ``encode``: the different words of the texts are looked up once, their ids laid out by place."""
        parts = pc.utf8_split_whitespace(texts)
        each = parts.flatten().dictionary_encode()
        codes, words = each.indices.to_numpy(), each.dictionary.to_numpy(zero_copy_only=False).tolist()
        missing = [w for w in words if w not in self.row]
        if len(self.row) + len(missing) > CACHE_SIZE:
            self.row.clear()
            missing = words
        self.add(missing)
        ids, ends = self._laid(np.fromiter(map(self.row.__getitem__, words), np.int64, len(words))[codes])
        raw, ends = ids.tobytes(), 4 * ends
        bounds = ends[parts.offsets.to_numpy() - parts.offsets[0].as_py()].tolist()
        return [raw[a:b] + self.end for a, b in zip(bounds, bounds[1:])]


def _room(x: np.ndarray, n: int) -> np.ndarray:
    """``x`` with room for ``n`` values at least."""
    return x if n <= len(x) else np.concatenate([x, np.zeros(max(n, 2 * len(x)) - len(x), x.dtype)])


def pack_ids(ids: list[int]) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


class Packer:
    """Packs the pieces of one task.  ``emit(piece, sequence, offset, size, step)``."""

    def __init__(self, task: int, emit, tiers=TIERS, step_tokens: int = STEP_TOKENS, pool: int = POOL):
        self.task, self.emit, self.tiers = task, emit, tuple(sorted(tiers, reverse=True))
        self.pools: dict[int, list] = {t: [] for t in self.tiers}  # sorted by length
        self.pending, self.limit, self.step_tokens = 0, pool, step_tokens
        self.sequences, self.by_size, self.order = 0, {}, 0

    def add(self, doc_id, ids: bytes) -> None:
        top, n = self.tiers[0], len(ids) // 4
        at = 0
        while n - at >= top:
            self._close([(doc_id, at, top, ids[4 * at:4 * (at + top)], n)], top)
            at += top
        if at < n:
            self._route((doc_id, at, n - at, ids[4 * at:], n))
        if self.pending >= self.limit:
            self._pack(last=False)

    def finish(self) -> None:
        self._pack(last=True)

    def _route(self, piece) -> None:
        tier = min(t for t in self.tiers if t >= piece[2])
        self.order += 1
        insort(self.pools[tier], (piece[2], self.order, piece))
        self.pending += 1

    def _take(self, most: int, tiers) -> tuple | None:
        """The largest pending piece of at most ``most`` ids, longer tiers first."""
        for t in tiers:
            pool = self.pools[t]
            at = bisect_right(pool, (most, float("inf")))
            if at:
                self.pending -= 1
                return pool.pop(at - 1)[2]
        return None

    def _cut(self, gap: int, tiers) -> tuple | None:
        """The first ``gap`` ids of a longer pending piece, from the shortest tier that has one."""
        for t in reversed(tiers):
            if self.pools[t]:
                self.pending -= 1
                d, start, n, ids, total = self.pools[t].pop()[2]
                self._route((d, start + gap, n - gap, ids[4 * gap:], total))
                return d, start, gap, ids[:4 * gap], total
        return None

    def _pack(self, last: bool) -> None:
        for k, tier in enumerate(self.tiers):
            lower = self.tiers[k:]
            while self.pools[tier]:
                window, free = [self._take(tier, (tier,))], tier
                free -= window[0][2]
                while free:
                    piece = self._take(free, lower) or self._cut(free, lower)
                    if piece is None:
                        break
                    window.append(piece)
                    free -= piece[2]
                if not free:
                    self._close(window, tier)
                elif last:
                    self._powers(window)
                else:  # nothing shorter is left now; keep for the next round
                    for piece in window:
                        self._route(piece)
                    return

    def _powers(self, pieces: list) -> None:
        """Cut what is left into sequences of the powers of two in its length."""
        left = sum(p[2] for p in pieces)
        queue = pieces[::-1]
        while left:
            size = 1 << (left.bit_length() - 1)
            window, free = [], size
            while free:
                d, start, n, ids, total = queue.pop()
                take = min(n, free)
                window.append((d, start, take, ids[:4 * take], total))
                if take < n:
                    queue.append((d, start + take, n - take, ids[4 * take:], total))
                free -= take
            self._close(window, size)
            left -= size

    def _close(self, window: list, size: int) -> None:
        number = self.by_size.get(size, 0)
        self.by_size[size] = number + 1
        sequence = (self.task << 40) | self.sequences
        self.sequences += 1
        step = (self.task << 40) | (size.bit_length() << 34) | (number // max(1, self.step_tokens // size))
        offset = 0
        for piece in window:
            self.emit(piece, sequence, offset, size, step)
            offset += piece[2]


_ENCODERS: dict = {}


def _encoder(path: str, end_id: int) -> WordEncoder:
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = WordEncoder(path, end_id)
    return _ENCODERS[path, end_id]


def pack_documents(docs: DataFrame, tokenizer_path: str, *, end_id: int = 2, tiers=TIERS,
                   step_tokens: int = STEP_TOKENS, pool: int = POOL) -> DataFrame:
    """One row per piece of a document: where it starts in the document's ids, its length and
    CRC-32, the sequence and offset it lies at, the sequence's size and step group.

    NULL text is empty, so such a document is its end id alone.  Rows with a NULL or repeated
    ``doc_id`` are packed like any other.  Very long texts are cut into full windows.  An
    empty table gives no rows.  Columns other than ``doc_id`` and ``text`` are not read.
    """
    schema = arrow(PIECE_SCHEMA)

    def pack(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        out: list = []

        def emit(piece, sequence, offset, size, step):
            out.append((piece[0], piece[1], piece[2], zlib.crc32(piece[3]), piece[4], sequence, offset, size, step))

        def flush():
            cols = list(zip(*out)) or [[] for _ in PIECE_SCHEMA]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        packer = Packer(TaskContext.get().partitionId(), emit, tiers, step_tokens, pool)
        encoder = _encoder(tokenizer_path, end_id)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for at in range(0, len(ids), SLICE_ROWS):
                for doc_id, x in zip(ids[at:at + SLICE_ROWS], encoder.encode(texts.slice(at, SLICE_ROWS))):
                    packer.add(doc_id, x)
                give_back()
                if len(out) > 10_000:
                    yield flush()
        packer.finish()
        yield flush()

    return id_text(docs).mapInArrow(lean(pack), PIECE_SCHEMA)
