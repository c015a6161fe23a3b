"""Token counts of whole texts by a two-tier, map-side lookup of pre-token lengths.

A pre-token is a run of spaces and the characters up to the next space.  A sentencepiece
BPE model whose pieces hold the space mark only at their start never merges across such a
boundary, so the count of a text is the sum over its pre-tokens (checked when the model is
loaded; a model with inner marks is counted text by text).

* Tier 1: the most frequent pre-tokens of the corpus with their lengths.  Every task sums its
  pre-tokens in a bounded counter and hands over its ``TASK_TOP`` heaviest; these summaries
  (never the pre-tokens themselves) are added up and the ``HOT`` heaviest, at most
  ``MAX_KEY`` characters each, are broadcast: at most 65,536 x 64 characters.
* Tier 2: a miss is encoded once by the worker and kept in its bounded cache.

The table only decides what is looked up and what is encoded; counts are exact either way.
"""
from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from airnet.llm.common import arrow, id_text, rows

HOT = 65_536          # pre-tokens in the broadcast table
TASK_TOP = 4_096      # pre-tokens in the summary of one task
MAX_KEY = 64          # characters; longer pre-tokens are encoded each time
COUNTER_SIZE = 1 << 18
CACHE_SIZE = 600_000
MARK = "▁"

COUNT_SCHEMA = StructType([StructField("doc_id", LongType()), StructField("n_bytes", LongType(), False),
                           StructField("n_tokens", LongType(), False),
                           StructField("over_limit", BooleanType(), False)])
_SUMMARY = StructType([StructField("pre_token", StringType(), False), StructField("n", LongType(), False)])


def pre_tokens(text: str) -> list[str]:
    """Words after one space each as they stand; a longer run of spaces keeps all but its
    first space in front of the word.  A lone mark (a final or only space) is ``""``."""
    if MARK in text:
        text = text.replace(MARK, " ")
    words = text.split(" ")
    if "" not in words:
        return words
    out, run, last = [], 0, len(words) - 1
    for i, w in enumerate(words):
        if w == "" and i < last:
            run += 1
        else:
            out.append(" " * run + w)
            run = 0
    return out


class _Model:
    """The tokenizer of one worker process with its two tiers."""

    def __init__(self, path: str, hot: list[str], lengths: list[int]):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        # pieces with the mark behind another character would merge across pre-tokens
        self.local = not any(MARK in self.sp.id_to_piece(i).lstrip(MARK) for i in range(self.sp.get_piece_size()))
        self.hot = dict(zip(hot, lengths))
        self.table = _Table(self)

    def encode(self, pre_token: str) -> int:
        if pre_token.strip(" ") == "":
            return len(self.sp.encode(pre_token)) if pre_token else 1
        return len(self.sp.encode(pre_token))

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.local:
            return len(self.sp.encode(text))
        table = self.table
        return sum([table[w] for w in pre_tokens(text)])


class _Table(dict):
    """Tier 1 plus the worker cache (tier 2); a full cache is emptied down to tier 1."""

    def __init__(self, model: _Model):
        super().__init__(model.hot)
        self.model = model

    def __missing__(self, w: str) -> int:
        n = self.model.encode(w)
        if len(w) <= MAX_KEY:
            if len(self) >= CACHE_SIZE:
                self.clear()
                self.update(self.model.hot)
            self[w] = n
        return n


_MODELS: dict = {}


def _model(path: str, table) -> _Model:
    value = table.value
    key = (path, hash(value["text"]))
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = _Model(path, value["text"].split("\x00")[:-1], value["n"])
    return _MODELS[key]


def _summaries(batches):
    seen: Counter = Counter()
    for batch in batches:
        for (text,) in rows(batch, "text"):
            if text:
                seen.update(pre_tokens(text))
            while len(seen) > COUNTER_SIZE:  # lossy counting: drop the lightest half
                seen = Counter(dict(seen.most_common(COUNTER_SIZE // 2)))
    top = [(w, n) for w, n in seen.most_common(TASK_TOP) if n > 1 and len(w) <= MAX_KEY and "\x00" not in w]
    yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()),
                                      pa.array([n for _, n in top], pa.int64())], schema=arrow(_SUMMARY))


def hot_table(docs: DataFrame, model_path: str):
    """Broadcast of the frequent pre-tokens with their token counts (see module doc)."""
    import sentencepiece
    spark = docs.sparkSession
    found = (id_text(docs).select("text").mapInArrow(_summaries, _SUMMARY)
             .groupBy("pre_token").agg(F.sum("n").alias("n"))
             .orderBy(F.col("n").desc(), "pre_token").limit(HOT).select("pre_token"))
    words = [r[0] for r in found.collect()]  # at most HOT rows of at most MAX_KEY characters
    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    lengths = [len(sp.encode(w)) if w else 1 for w in words]
    return spark.sparkContext.broadcast({"text": "".join(w + "\x00" for w in words), "n": lengths})


def token_counts(docs: DataFrame, model_path: str, *, limit: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs`` (doc_id, text).

    NULL text counts as empty (0 bytes, 0 tokens).  A NULL ``doc_id`` and repeated rows are
    kept as they are: one output row per input row.  Only ``doc_id`` and ``text`` are read,
    so other columns may have any name.  An empty table gives an empty result.
    """
    table = hot_table(docs, model_path)
    schema = arrow(COUNT_SCHEMA)

    def count(batches):
        model = _model(model_path, table)
        for batch in batches:
            ids, n_bytes, n_tokens = [], [], []
            for doc_id, text in rows(batch, "doc_id", "text"):
                text = text or ""
                ids.append(doc_id)
                n_bytes.append(len(text.encode("utf-8")))
                n_tokens.append(model.count(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                 pa.array([n > limit for n in n_tokens], pa.bool_())], schema=schema)

    return id_text(docs).mapInArrow(count, COUNT_SCHEMA)
