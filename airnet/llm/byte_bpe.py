"""Byte-level BPE: encoding by the tokenizers library over Arrow batches, and decoding.

The vocabulary is a rank file (one base64 token and its rank a line).  Each worker builds a
tokenizers model from it: bytes become printable characters (the byte table), every split of a
token into two other tokens is a merge of the token's rank, and a pre-token that is a token
itself is taken whole.

* **Chunks.**  A pre-token never holds white space behind other characters, so a text is cut
  into runs of visible characters with at most one space before them and runs of white
  space; each chunk is encoded alone, which gives the ids of the whole text.  Short chunks are
  kept in a bounded cache of the worker, the missing ones of a few megabytes of text are
  encoded in one call.
* **Ties.**  A rank file gives all splits of a token one rank, and the leftmost pair of the
  lowest rank merges first; a merge list orders the splits of one token.  The results can differ
  only where one token of three bytes or more could arise twice in a pre-token, so chunks in which
  any three bytes occur twice are settled by rank order (an exact check after the encoding).
* **Offsets** (characters, end exclusive): a token that holds a part of a character covers the
  whole character, as the tokenizers library counts.
* **Decoding** puts the bytes of the ids together.  Ids may be cut anywhere: ``head`` are the bytes
  that end a character begun before, ``tail`` those of a character that goes on behind, so
  that pieces can be joined without a broken character.
"""
from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from airnet.llm.common import arrow, id_text, rows, ship

MAX_KEY = 64             # characters of a chunk that is kept in the cache
CACHE_SIZE = 200_000     # chunks
GROUP_CHARS = 2 << 20    # texts whose missing chunks are encoded in one call
SEGMENT = 1 << 20        # characters of a text cut into chunks at once

# white space of Unicode (re's \s also holds four control characters)
_WS = r"\t-\r" + "".join(map(chr, [0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_CHUNK = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
_CUT = re.compile(f"(?<=[^{_WS}]) (?=[^{_WS}])")

IDS_SCHEMA = StructType([StructField("doc_id", LongType()), StructField("ids", BinaryType(), False)])
OFFSET_SCHEMA = StructType([*IDS_SCHEMA, StructField("starts", ArrayType(IntegerType(), False), False),
                            StructField("ends", ArrayType(IntegerType(), False), False)])
DECODED_SCHEMA = StructType([StructField("doc_id", LongType()), StructField("ids", BinaryType()),
                             StructField("decoded", BinaryType()), StructField("head", BinaryType()),
                             StructField("text", StringType()), StructField("tail", BinaryType())])
ROUND_TRIP_SCHEMA = StructType([StructField("doc_id", LongType()), StructField("n_tokens", LongType(), False),
                                StructField("ids_sha256", StringType(), False),
                                StructField("decoded_sha256", StringType(), False)])


def byte_table() -> dict[int, str]:
    """A printable character for each byte: visible Latin-1 bytes stand for themselves, the
    others, in order, for the characters from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _repeats(b: bytes) -> bool:
    """Whether any three bytes occur twice."""
    return len(b) > 3 and len({b[i:i + 3] for i in range(len(b) - 2)}) < len(b) - 2


class ByteBpe:
    """One vocabulary with its encoder, decoder and worker cache."""

    def __init__(self, path: str, pattern: str):
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers
        self.pattern, self.ranks = pattern, read_ranks(path)
        shown = byte_table()
        self.tokens: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)
        text_of = {t: "".join([shown[x] for x in t]) for t in self.ranks}
        merges = []
        for t in sorted(self.ranks, key=self.ranks.get):
            splits = [(t[:i], t[i:]) for i in range(1, len(t))]
            merges += [(text_of[a], text_of[b]) for a, b in splits if a in self.ranks and b in self.ranks]
        self.tokenizer = Tokenizer(models.BPE({text_of[t]: r for t, r in self.ranks.items()}, merges,
                                              ignore_merges=True, cache_capacity=0))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self._exact = None
        self.cache: dict[str, bytes] = {}

    def _settle(self, chunk: str) -> list[int]:
        """Ids by rank order, the leftmost of equal ranks first."""
        if self._exact is None:
            import tiktoken
            self._exact = tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=self.ranks,
                                            special_tokens={})
        return self._exact.encode_ordinary(chunk)

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        return [np.array(self._settle(c) if _repeats(c.encode()) else e.ids, "<u4").tobytes()
                for c, e in zip(chunks, found)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        out, group, held = [], [], 0
        for text in texts:
            group.append(text)
            held += len(text)
            if held >= GROUP_CHARS:
                out += self._encode_group(group)
                group, held = [], 0
        return out + self._encode_group(group)

    def _encode_group(self, texts: list[str]) -> list[bytes]:
        out, waiting, parts = [], [], 0
        for i, text in enumerate(texts):
            out.append([])
            for segment in segments(text):
                chunks = _CHUNK.findall(segment)
                waiting.append((i, chunks))
                parts += len(segment)
                if parts >= GROUP_CHARS:
                    self._look_up(waiting, out)
                    waiting, parts = [], 0
        self._look_up(waiting, out)
        return [b"".join(x) for x in out]

    def _look_up(self, waiting: list[tuple[int, list[str]]], out: list[list[bytes]]) -> None:
        cache = self.cache
        if len(cache) > CACHE_SIZE:
            cache.clear()
        missing = list(set().union(*[c for _, c in waiting]) - cache.keys())
        cache.update(zip(missing, self._encode_chunks(missing)))
        for i, chunks in waiting:
            out[i].append(b"".join([cache[c] for c in chunks]))
        for c in missing:
            if len(c) > MAX_KEY:
                del cache[c]

    def offsets(self, text: str, ids: bytes) -> tuple[list[int], list[int]]:
        """First character and end of each token."""
        raw = np.frombuffer(text.encode(), np.uint8)
        if not len(raw):
            return [], []
        place = np.cumsum((raw & 0xC0) != 0x80) - 1
        ends = np.cumsum(self.sizes[np.frombuffer(ids, "<u4")])
        starts = np.concatenate([[0], ends[:-1]])
        return place[starts].tolist(), (place[ends - 1] + 1).tolist()

    def decode(self, ids: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def segments(text: str):
    """The text in parts of about SEGMENT characters, cut before a space between visible characters."""
    at = 0
    while len(text) - at > SEGMENT:
        cut = _CUT.search(text, at + SEGMENT)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def whole_characters(raw: bytes) -> tuple[bytes, str, bytes]:
    """(head, text, tail): bytes that end an earlier character, the whole characters, and the
    bytes of a character that is not complete.  Other broken bytes become U+FFFD."""
    start = 0
    while start < min(3, len(raw)) and raw[start] & 0xC0 == 0x80:
        start += 1
    end = len(raw)
    for back in range(1, min(3, len(raw) - start) + 1):
        b = raw[-back]
        if b & 0xC0 != 0x80:
            if (b >= 0xF0 and back < 4) or (b >= 0xE0 and back < 3) or (b >= 0xC0 and back < 2):
                end = len(raw) - back
            break
    return raw[:start], raw[start:end].decode("utf-8", "replace"), raw[end:]


@lru_cache(maxsize=2)
def _model(path: str, pattern: str) -> ByteBpe:
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark deals out the work
    return ByteBpe(path, pattern)


def _parts(batch: pa.RecordBatch):
    """The batch in slices of a few megabytes of text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        done = int(sizes[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, done + GROUP_CHARS, "right")))
        yield batch.slice(at, end - at)
        at = end


def _encoded(batches, model: ByteBpe):
    """(doc ids, texts, ids) of each part of the batches."""
    for batch in batches:
        for part in _parts(batch):
            texts = [t or "" for t in part.column("text").to_pylist()]
            yield part.column("doc_id").cast(pa.int64()), texts, model.encode(texts)


def encode(docs: DataFrame, path: str, pattern: str, *, offsets: bool = False) -> DataFrame:
    """``doc_id, ids`` (binary: little-endian unsigned 32-bit numbers) for every row of ``docs``
    (doc_id, text); with ``offsets`` also ``starts, ends`` in characters.

    NULL text counts as empty (no ids).  A NULL ``doc_id`` and repeated rows stay: one output row
    per input row.  Texts of any length are encoded whole.  Other columns may have any name.  An
    empty table gives an empty result.
    """
    wanted = OFFSET_SCHEMA if offsets else IDS_SCHEMA
    schema = arrow(wanted)

    def run(batches):
        model = _model(path, pattern)
        for doc_ids, texts, ids in _encoded(batches, model):
            columns = [doc_ids, pa.array(ids, schema.field("ids").type)]
            if offsets:
                places = [model.offsets(t, i) for t, i in zip(texts, ids)]
                columns += [pa.array([p[k] for p in places], schema.field(2 + k).type) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return id_text(docs).mapInArrow(run, wanted)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids, decoded, head, text, tail`` for rows of ``doc_id`` and ``ids`` (binary as from
    :func:`encode`, whole or cut between any two ids).

    ``decoded`` are all bytes; ``text`` the whole characters among them, ``head`` and ``tail`` the
    bytes of characters that were cut off.  NULL ids count as none.  An id outside the vocabulary
    fails.  Repeated rows stay; an empty table gives an empty result.
    """
    ship(encoded.sparkSession)
    schema = arrow(DECODED_SCHEMA)

    def run(batches):
        model = _model(path, pattern)
        for batch in batches:
            out = []
            for doc_id, ids in rows(batch, "doc_id", "ids"):
                raw = model.decode(ids or b"")
                out.append((doc_id, ids, raw, *whole_characters(raw)))
            cols = list(zip(*out)) or [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, DECODED_SCHEMA)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: digests of the ids of :func:`encode` and of the
    bytes that decoding these ids gives back, both in one pass over the texts."""
    schema = arrow(ROUND_TRIP_SCHEMA)

    def run(batches):
        model = _model(path, pattern)
        for doc_ids, _, ids in _encoded(batches, model):
            yield pa.RecordBatch.from_arrays([
                doc_ids, pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                pa.array([hashlib.sha256(model.decode(i)).hexdigest() for i in ids], pa.string())], schema=schema)

    return id_text(docs).mapInArrow(run, ROUND_TRIP_SCHEMA)
