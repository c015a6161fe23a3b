"""The pipeline's stages on a small corpus with planted cases, and its awkward rows."""
import numpy as np
import pytest

import corpus_pipeline as C

WORDS = [f"{a}{b}{c}" for a in "bdfgk" for b in ("an", "or", "il") for c in ("", "s", "ing", "ed")]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, key string, row string"


def _text(rng, lines=8, words=15):
    return "\n".join(" ".join(f"{w}{rng.integers(0, 900)}" for w in rng.choice(WORDS, words)) for _ in range(lines))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = np.random.default_rng(8)
    texts = {d: _text(rng) for d in range(40)}
    item = " ".join(f"{w}{rng.integers(1000, 1900)}" for w in rng.choice(WORDS, 30)) + "."
    texts[40] = texts[2]                                             # exact copy
    texts[41] = " ".join(w if i != 9 else "other" for i, w in enumerate(texts[3].split(" ")))   # near copy
    texts[42] = _text(rng) + "\n" + item + "\n" + _text(rng)          # holds a benchmark item
    texts[43] = "too short"
    texts[44] = None
    texts[45] = "again and " * 200
    folder = str(tmp_path_factory.mktemp("sf"))
    rows = [(d, t, "en", "s", len(t or ""), "k", "r") for d, t in texts.items()]
    spark.createDataFrame(rows + [rows[7], (None, None, None, None, None, None, None)], COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, texts


def _stage(spark, corpus, name, docs=None):
    folder, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet") if docs is None else docs
    out = dict(C.STAGES)[name](spark, docs, folder)
    return docs, out


def test_quality(spark, corpus):
    docs, out = _stage(spark, corpus, "quality_rules")
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted([*range(43), 7])


def test_line_dedup(spark, corpus):
    docs, out = _stage(spark, corpus, "line_dedup")
    got = {r.doc_id: r for r in out.where("doc_id is not null").collect()}
    assert out.columns == docs.columns and 40 not in got and all(got[d].text == corpus[1][d] for d in range(40))
    assert out.where("doc_id = 7").count() == 2 and out.where("doc_id is null").count() == 1


def test_near_copies(spark, corpus):
    docs, out = _stage(spark, corpus, "near_copies")
    ids = sorted(r.doc_id for r in out.where("doc_id is not null").collect())
    assert out.columns == docs.columns and ids == [d for d in sorted(corpus[1]) if d not in (40, 41)]


def test_decontamination(spark, corpus):
    docs, out = _stage(spark, corpus, "decontamination")
    assert out.columns == docs.columns and docs.count() - out.count() == 1 and out.where("doc_id = 42").count() == 0


def test_run(spark, corpus):
    got = C.run(spark, corpus[0])
    assert {r.doc_id for r in got.select("doc_id").distinct().collect()} == set(range(40))


def test_empty(spark, corpus):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet").limit(0)
    for name, _ in C.STAGES:
        _, out = _stage(spark, corpus, name, docs)
        assert out.count() == 0


def test_near_copies_of_repeated_ids(spark, corpus):
    """Classes are told apart by what their texts hold, not by ids, which may repeat or be NULL."""
    rng = np.random.default_rng(9)
    one, two, three, four = (_text(rng) for _ in range(4))
    rows = [(1, one), (1, two), (2, one), (1, "..."), (1, None), (1, ""), (None, three), (None, three), (None, four), (3, four)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or ""), "k", "r") for d, t in rows], COLUMNS)
    _, out = _stage(spark, corpus, "near_copies", docs)
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(1, one), (1, two), (1, "..."), (1, None), (1, ""), (None, three), (3, four)], key=str)


def test_line_dedup_keeps_what_is_left(spark, corpus):
    """A document that lost a line stays as long as it holds anything, in unspaced scripts too."""
    line = "a line of many words that two of the documents hold"
    rows = [(1, line), (2, f"{line}\n这一段文字没有空格但是完全干净"), (3, f"{line}\n \t"), (4, line)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t), "k", "r") for d, t in rows], COLUMNS)
    _, out = _stage(spark, corpus, "line_dedup", docs)
    assert {r.doc_id: r.text for r in out.collect()} == {1: line, 2: "这一段文字没有空格但是完全干净"}
