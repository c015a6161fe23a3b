"""Verbatim copies of items of any length, and the projection against a plain sum."""
import collections

import numpy as np
import pytest


def _corpus(lengths, each=12):
    rng = np.random.default_rng(8)
    words = np.array([f"v{i}" for i in range(4000)])
    p = 1 / np.arange(1, 4001)
    p /= p.sum()
    items, docs, planted = [], [], {}
    for n in lengths:
        for _ in range(each):
            i = len(items)
            items.append((i, " ".join(rng.choice(words, n, p=p))))
            text = list(rng.choice(words, 430, p=p))
            at = int(rng.integers(0, 431))
            docs.append((i, " ".join(text[:at] + [items[i][1]] + text[at:])))
            planted[i] = n
    clean = [(10_000 + k, " ".join(rng.choice(words, 430, p=p))) for k in range(100)]
    return items, docs + clean, planted


def test_recall_by_item_length(spark):
    """Copies of items of 3 to 500 words are found; of long ones no document without them is."""
    from airnet.llm.decontamination import contaminated
    items, docs, planted = _corpus((3, 4, 6, 8, 12, 15, 16, 40, 64, 65, 100, 150, 200, 300, 500))
    got = {(r.doc_id, r.item_id) for r in contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                                       spark.createDataFrame(items, "item_id long, text string")).collect()}
    found, of = collections.Counter(), collections.Counter()
    for i, n in planted.items():
        of[n] += 1
        found[n] += (i, i) in got
    assert {n: found[n] / of[n] for n in of if found[n] < 0.9 * of[n]} == {}
    assert not [(d, i) for d, i in got if d != i and planted[i] >= 8]


def test_very_long_text(spark, monkeypatch):
    """A text of many pieces: items at its start, at its end and across pieces."""
    from airnet.llm import decontamination as D
    rng = np.random.default_rng(3)
    words = np.array([f"v{i}" for i in range(3000)])
    items = [(i, " ".join(rng.choice(words, n))) for i, n in enumerate((5, 10, 30, 90))]
    block = D.Block(items)
    block.fit(np.full(len(block.vocab), 3.0), np.eye(len(block.vocab)))
    gap = [f"g{i}" for i in range(997)]
    text = " ".join(t for k in range(20) for _, item in items for t in [item, " ".join(gap[:300 + 37 * k])])
    monkeypatch.setattr(D, "PIECE", 64)
    assert {h[1] for h in D._search(block, [1], [text], 0.6, 0.5)} == {0, 1, 2, 3}
    one = {(h[0], h[1]): round(h[3], 6) for h in D._search(block, [1, 2], [text, items[3][1]], 0.6, 0.5)}
    monkeypatch.setattr(D, "PIECE", 1 << 20)
    assert {(h[0], h[1]): round(h[3], 6) for h in D._search(block, [1, 2], [text, items[3][1]], 0.6, 0.5)} == one
    assert D._search(block, [1, 2], ["", "nothing known"], 0.6, 0.5) == []


@pytest.mark.parametrize("lo,hi", [(0, 50), (7, 31)])
def test_units_are_sums(lo, hi):
    from airnet.llm import decontamination as D
    rng = np.random.default_rng(1)
    block = D.Block([(0, " ".join(f"v{i}" for i in range(40)))])
    block.project = rng.normal(size=(40, 6)).astype(np.float32)
    unit = np.sort(rng.integers(0, 50, 300))
    feature = rng.integers(0, 40, 300)
    want = np.zeros((50, 6), np.float32)
    np.add.at(want, unit, block.project[feature])
    assert np.allclose(D._units(block, feature, unit, lo, hi), want[lo:hi], atol=1e-4)
