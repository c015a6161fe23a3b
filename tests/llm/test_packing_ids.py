"""The packed ids against the tokenizers library, text by text."""
import random

import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from airnet.llm import packing


@pytest.fixture(scope="module")
def encoder():
    return packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"), 2)


def _texts(n, seed=6):
    rng = random.Random(seed)
    parts = ["hello", "World", "İ", "Hello İİ", "ı", "Σ", "ΣΑΣ", "ñ", "ñ", "é", "ß", "ẞ", "ǅ", "ŉ", "ا", "中文", "日", "한국", "ค", "\U0001e900",
             "\U00031350", "ꟊ", ",", ".", "!!", "#", "&", "$5", "12", "½", "'s", "'", "-", "_", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "　",
             "<|endoftext|>", "<|startoftext|>", "</w>", "🎉", "̇", "️", "‍", "a" * 30, "I", "II"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(n)] + [
        "İ,", "Helloİİ,", "ا中İ.", "", " ", "İstanbul, IĞDIR. Çalış!", "ΟΔΟΣ."]


def test_ids_equal_the_library(encoder):
    texts = _texts(20_000)
    want = [packing.pack_ids([*ids, 2]) for ids in encoder._encode(texts)]
    got = encoder.encode(texts)
    assert [t for t, a, b in zip(texts, got, want) if a != b] == []


def test_a_full_cache_changes_nothing(encoder, monkeypatch):
    texts = _texts(2_000, 9)
    want = encoder.encode(texts)
    monkeypatch.setattr(packing, "CACHE_SIZE", 50)
    assert packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"), 2).encode(texts) == want


def test_white_space_is_that_of_the_tokenizer():
    """Words are split by Arrow; every character that parts them there does so for str.split too, and the reverse."""
    texts = [f"a{chr(c)}b" for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    got = pc.utf8_split_whitespace(pa.array(texts)).to_pylist()
    assert [t for t, x in zip(texts, got) if x != t.split()] == []


def test_long_texts_and_slices(encoder, monkeypatch):
    """Texts beyond a slice, many slices, NULL and empty texts among them."""
    texts = _texts(500, 3) + [" ".join(_texts(3_000, 4)), None, "", " \t "]
    want = encoder.encode(pa.array(texts, pa.string()))
    monkeypatch.setattr(packing, "SLICE_BYTES", 100)
    got = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"), 2).encode(pa.array(texts, pa.string()))
    assert got == want == [packing.pack_ids([*i, 2]) for i in encoder._encode([t or "" for t in texts])]
