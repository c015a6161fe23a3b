"""Licence scan with a positional index of rare template words; DataFrame functions only.

1. Corpus pass: document frequencies of the templates' words (a few dozen rows) give their IDF.
2. Every template keeps a posting (word, position) for each word of its key phrase; its two
   anchors are the highest-IDF words of that phrase.
3. File pass, narrow and without a shuffle: the file's places of anchor words are looked up,
   shifted by the anchors' positions, and the two lists intersected; each place left is a
   relative position at which both rare words stand as in the template.
4. There the whole key phrase is verified word by word, and the rest of the template is
   compared position by position.  A template of which at least ``min_match`` of the words
   stand in place gives its label.

A phrase's words include its anchors, so the lookup loses no place.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airnet.llm.common import id_text

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    label: str
    words: str            # the text around and with the key phrase
    key: str              # mandatory: these words stand consecutively
    base: bool = False    # every place of the key phrase counts by itself

    @property
    def key_words(self) -> list[str]:
        return self.key.split()

    @property
    def all_words(self) -> list[str]:
        return self.words.split()

    @property
    def key_at(self) -> int:
        """Position of the key phrase in the template."""
        w, k = self.all_words, self.key_words
        return next(i for i in range(len(w)) if w[i:i + len(k)] == k)


#: fixed values: phrases and labels
TEMPLATES = (
    Template("mit", "under the mit license", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", "cc by nc", base=True),
    Template("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             "permission is hereby granted free of charge"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("apache-2", "you may not use this file except in compliance with the license",
             "use this file except in compliance with the license"),
)


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lower-cased, as one array (empty for NULL or no word)."""
    flat = F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS, " "))
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " "))


def word_frequencies(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> dict[str, int]:
    """Number of documents that hold each word of the key phrases (at most as many rows as
    the templates have words)."""
    vocabulary = sorted({w for t in templates for w in t.key_words})
    found = (id_text(docs).select(F.explode(F.array_distinct(words_of(F.col("text")))).alias("w"))
             .where(F.col("w").isin(vocabulary)).groupBy("w").count())
    return {**dict.fromkeys(vocabulary, 0), **{r["w"]: r["count"] for r in found.collect()}}


def anchors(template: Template, df: dict[str, int]) -> list[tuple[str, int]]:
    """The two rarest words of the key phrase with their positions in it."""
    order = sorted(enumerate(template.key_words), key=lambda x: (df[x[1]], x[0]))
    return [(w, i) for i, w in order[:2]]


def _places(template: Template, df: dict[str, int]) -> Column:
    """Starts of the template's key phrase among the words ``w`` with the anchor hits ``hits``."""
    def shift(word: str, at: int) -> Column:
        return F.transform(F.filter("hits", lambda h: h["w"] == F.lit(word)), lambda h: h["i"] - F.lit(at))

    shifted = [shift(word, at) for word, at in anchors(template, df)]
    near = shifted[0] if len(shifted) == 1 else F.array_intersect(*shifted)
    key = F.array(*[F.lit(x) for x in template.key_words])
    size = len(template.key_words)
    return F.filter(F.array_distinct(near),
                    lambda o: (o >= 0) & (F.slice("w", F.greatest(o, F.lit(0)) + 1, size) == key))


def _matched(template: Template, place: Column) -> Column:
    """Share of the template's words that stand at their relative position."""
    total = F.lit(0)
    for i, word in enumerate(template.all_words):
        at = place + F.lit(i - template.key_at)
        here = F.when(at >= 0, F.get(F.col("w"), at))
        total = total + F.coalesce(F.when(here == F.lit(word), F.lit(1)), F.lit(0))
    return total / F.lit(float(len(template.all_words)))


def _best_match(template: Template, places: str) -> Column:
    return F.array_max(F.transform(places, lambda place: _matched(template, place)))


def _labelled(template: Template, places: str) -> Column:
    return F.transform(places, lambda o: F.struct(F.lit(template.label).alias("label"), o.cast("long").alias("start")))


def license_scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, *, min_match: float = 0.6) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, places`` (``places``: label and start of every key phrase found).

    NULL text has no words.  Without a place the positions are NULL, the label strings empty
    and the score 0.  Repeated rows and NULL ids give one row each; only ``doc_id`` and
    ``text`` are read, so other columns may have any name.
    """
    df = word_frequencies(docs, templates)
    rare = sorted({a for t in templates for a, _ in anchors(t, df)})
    out = id_text(docs).select("doc_id", words_of(F.col("text")).alias("w"))
    # position lookup only in files that hold an anchor at all
    none = F.array().cast("array<struct<w:string,i:int>>")
    listed = F.transform("w", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    hits = F.when(F.arrays_overlap("w", F.array(*[F.lit(x) for x in rare])),
                  F.filter(listed, lambda h: h["w"].isin(rare))).otherwise(none)
    out = out.withColumn("hits", hits)
    for k, t in enumerate(templates):
        out = out.withColumn(f"p{k}", F.when(F.size("hits") > 0, _places(t, df))
                             .otherwise(F.array().cast("array<int>")))
        if t.base:
            score = F.when(F.size(f"p{k}") > 0, F.lit(1.0)).otherwise(F.lit(0.0))
        else:
            score = F.coalesce(_best_match(t, f"p{k}"), F.lit(0.0))
        out = out.withColumn(f"s{k}", score)
    base = [k for k, t in enumerate(templates) if t.base]
    starts = F.concat(*[F.col(f"p{k}") for k in base])

    def joined(which, ok) -> Column:
        given = F.array(*[F.when(ok(k), F.lit(templates[k].label)) for k in which])
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(given))), ",")

    every = range(len(templates))
    places = F.concat(*[_labelled(t, f"p{k}") for k, t in enumerate(templates)])
    return out.select(
        "doc_id", F.size("w").cast("long").alias("n_words"),
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        joined(base, lambda k: F.size(f"p{k}") > 0).alias("base_labels"),
        joined(every, lambda k: F.col(f"s{k}") >= F.lit(min_match)).alias("labels"),
        F.greatest(*[F.col(f"s{k}") for k in every]).alias("score"), places.alias("places"))
