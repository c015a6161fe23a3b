"""Ranked search against a brute-force scorer that knows no classes."""
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from airnet.llm import lexical_search
from airnet.llm.lexical_search import search

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("bag", StringType()),
                   StructField("n", StringType()), StructField("we`ird.name", StringType())])
ITEMS = StructType([StructField("item_id", LongType()), StructField("text", StringType()), StructField("item", StringType())])
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    bags = [(d[0], split(d[1])) for d in docs]
    bags = [(d, t) for d, t in bags if t]
    n, total = len(bags), sum(len(t) for _, t in bags)
    df = Counter(w for _, t in bags for w in set(t))
    asked = {}
    for i, text, *_ in sorted(set(x[:2] for x in items), key=repr):
        asked.setdefault(i, []).extend(split(text))
    out = []
    for i, query in asked.items():
        scored = []
        for d, t in bags:
            tf, m = Counter(t), 25 + (75 * len(t) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * tf[w]) // (1000 * tf[w] + 8 * m))
                    for w in query if w in tf)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        scored.sort()
        out += [(i, r + 1, d, -s) for r, (s, _, _, d) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def _tables(n=300, seed=4):
    rng = random.Random(seed)
    words = [f"W{i}" for i in range(60)] + ["é", "中文", "x1", "Straße"]
    texts = [" ".join(rng.choices(words, [1 / (j + 1) for j in range(len(words))], k=rng.randint(1, 40))) for _ in range(n)]
    docs = [(i, t, "b", None, None) for i, t in enumerate(texts)]
    docs += [(1000 + i, "W1 w2-W3", None, "n", None) for i in range(60)]              # one class beyond k
    docs += [(2000 - i, f"other{i} words{i} w1", None, None, None) for i in range(40)]  # one class by restriction
    docs += [(None, "w1 w2 w3", None, None, None), (7, None, None, None, None), (8, "", None, None, None), (9, "-- !", None, None, None),
             docs[5], docs[5], (3000, "w1 " * 50000, None, None, None)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12))), None) for i in range(25)]
    items += [items[0], (3, "W1 another text w1", "x"), (30, None, None), (31, "...", None), (32, "unheard of", None), (None, "w1 w5", None)]
    return docs, items


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(lexical_search, "ITEM_BYTES", 100)
        monkeypatch.setattr(lexical_search, "CELL_NUMBERS", 1)
    docs, items = _tables()
    if small:
        items = items[:6]
    got = search(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS), k=7)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [
        ("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items, 7)


def test_a_class_is_scored_once(spark):
    docs, _ = _tables()
    frame = spark.createDataFrame(docs, DOCS)
    number = {b"w1": 0, b"w2": 1, b"w3": 2}
    found = lexical_search.bags(frame, spark.sparkContext.broadcast(number))
    n, total = 400, 4000
    got = lexical_search.classes(found, n, total, 5).collect()
    assert len({(bytes(r.bag), r.m) for r in got}) == len(got) and all(len(r.members) <= 5 for r in got)
    assert [1000, 1001, 1002, 1003, 1004] in [r.members for r in got]   # the least of 60
    want = {}
    for d, text, *_ in docs:
        counts = Counter(number[w.encode()] for w in split(text) if w.encode() in number)
        if counts:
            key = (lexical_search.pack(counts), 25 + (75 * len(split(text)) * n) // total)
            want.setdefault(key, []).append(lexical_search.NO_ID if d is None else d)
    assert {(bytes(r.bag), r.m): r.members for r in got} == {key: sorted(x)[:5] for key, x in want.items()}


def test_empty(spark):
    docs, items = _tables()
    none, no_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert search(none, spark.createDataFrame(items, ITEMS)).count() == 0
    assert search(spark.createDataFrame(docs, DOCS), no_items).count() == 0
