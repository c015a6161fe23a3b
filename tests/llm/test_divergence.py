"""Source divergence against a brute-force version with Python's whole numbers."""
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from airnet.llm import divergence
from airnet.llm.divergence import source_divergence

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                     StructField("source", StringType()), StructField("term", StringType()), StructField("p0", StringType()),
                     StructField("we`ird.name", StringType())])
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, ranks):
    count, held, lang_count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = TERM.findall((text or "").translate(LOWER))
        count[lang, source].update(found)
        lang_count[lang].update(found)
        held[lang].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in held[lang].items() if n >= least]
        v = len(kept)

        def prob(counter):
            n = sum(counter[t] for t in kept)
            return {t: 1 + (10**9 * (counter[t] + 5)) // (n + 5 * v) for t in kept}
        q, p = prob(lang_count[lang]), {g[1]: prob(count[g]) for g in groups if g[0] == lang}
        for s in p:
            pair = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in p if o != s]
            term = [(p[s][t] - q[t], t) for t in kept if count[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, items, most in (("pair", pair, None), ("term", term, ranks)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, x, k + 1) for k, (x, i) in enumerate(items[:most])]
    return sorted(out)


def _rows(n=400, n_sources=9, seed=1):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("zu", "Ka", "é", "中", "Ñ", "x") for b in ("la", "ri", "ß", "Q", "ed", "")]
    rows = []
    for d in range(n):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["hot"] * n_sources + [f"s{i}" for i in range(n_sources)] + [None])
        text = rng.choice([" ", "\n", "-", "1"]).join(rng.choice(words) for _ in range(rng.randint(0, 30)))
        rows.append((d, text, lang, source, "t", "p", None))
    rows += [(1, None, "xx", "lonely", None, None, None), (2, "only once here", "yy", "a", None, None, None),
             (2, None, "yy", "b", None, None, None), (3, "", "de", "empty", None, None, None), rows[0], rows[0],
             (None, "zula " * 20000, "en", "long", None, None, None)]
    return rows


@pytest.mark.parametrize("blocks", [None, (2, 3, 50)])
def test_equals_brute_force(spark, monkeypatch, blocks):
    if blocks:
        for name, x in zip(("SOURCE_BLOCK", "TERM_BLOCK"), blocks):
            monkeypatch.setattr(divergence, name, x)
    rows = _rows()
    got = source_divergence(spark.createDataFrame(rows, SCHEMA).repartition(4), min_docs=20, term_ranks=7)
    assert [f.dataType.simpleString() for f in got.schema] == ["string", "string", "string", "string", "bigint", "int"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 20, 7)


def test_tables_handed_over_early_give_the_same_counts(spark):
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "en"]), pa.array(["a", "b"]), pa.array([b"x Y x", b"x z"])],
                                       names=["lang", "source", "raw"])
    whole = [r for b in divergence._count([batch, batch]) for r in b.to_pylist()]
    assert {(r["source"], r["term"]): (r["cnt"], r["docs"]) for r in whole} == {
        ("a", None): (0, 0), ("a", "x"): (4, 2), ("a", "y"): (2, 2), ("b", None): (0, 0), ("b", "x"): (2, 2), ("b", "z"): (2, 2)}
    size, divergence.TABLE_SIZE = divergence.TABLE_SIZE, 1
    try:
        early = [r for b in divergence._count([batch, batch]) for r in b.to_pylist()]
    finally:
        divergence.TABLE_SIZE = size
    total = Counter()
    for r in early:
        total[r["source"], r["term"]] += r["cnt"]
    assert total["a", "x"] == 4 and len(early) > len(whole)


def test_large_counts_are_exact(spark):
    from pyspark.sql import functions as F
    big = 9_000_000_000_000_000_000
    row = spark.sql(f"select {big}L as c, {big}L as n, 7L as v").select(
        divergence.scaled(F.col("c"), F.col("n"), F.col("v")).alias("p")).first()
    assert row.p == 1 + (10**9 * (big + 5)) // (big + 35)


def test_empty(spark):
    assert source_divergence(spark.createDataFrame([], SCHEMA)).count() == 0
