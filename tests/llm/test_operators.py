"""Each operator against a brute-force version on small tables, with the awkward rows."""
import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                     StructField("source", StringType()), StructField("n_chars", LongType()),
                     # names that operators might use themselves
                     StructField("key", StringType()), StructField("row", StringType()), StructField("n", StringType())])
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"


def _texts():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    out = {}
    for d in range(60):
        out[d] = "\n".join(" ".join(rng.choice(words, 12)) for _ in range(6))
    out[60] = out[3]                                            # exact copy
    near = out[4].split(" ")
    near[5] = "changed"
    out[61] = " ".join(near)                                    # near copy
    out[62] = out[5] + "\n" + BASE + "\nUnder the MIT License. Apache License, Version 2.0; CC BY-NC cc by nc"
    out[63] = None
    out[64] = ""
    out[65] = " \n \t\n"
    out[66] = "  lead  two   spaces ▁mark </s> <|endoftext|> Éİ \x1c x "
    out[67] = "same word " * 300                                # long and repetitive
    out[68] = "x" * 5000                                        # one very long word
    out[69] = "\n".join([BASE] * 4)                             # a line repeated within a text
    return out


@pytest.fixture(scope="module")
def texts():
    return _texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(d, t, "en" if d % 2 else None, f"s{d % 3}", len(t or ""), "k", "r", None) for d, t in texts.items()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """NULL id, a repeated row, NULLs in every other column."""
    return spark.createDataFrame([(None, BASE, None, None, None, None, None, None), (1, BASE, None, None, None, None, None, None),
                                  (1, BASE, None, None, None, None, None, None), (2, None, None, None, None, None, None, None)], SCHEMA)


def test_token_counts(docs, empty, odd, texts):
    import sentencepiece

    from airnet.llm.token_counts import token_counts
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    for r in token_counts(docs, path, limit=100).collect():
        t = texts[r.doc_id] or ""
        assert (r.n_tokens, r.n_bytes) == (len(sp.encode(t)), len(t.encode()))
        assert r.over_limit == (r.n_tokens > 100)
    assert token_counts(empty, path).count() == 0
    assert token_counts(odd, path).count() == 4


def test_packing(docs, empty, odd, texts):
    from tokenizers import Tokenizer

    from airnet.llm.packing import pack_documents
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    ids = {d: tok.encode(t or "", add_special_tokens=False).ids + [2] for d, t in texts.items()}
    docs_, seqs = collections.defaultdict(list), collections.defaultdict(list)
    for r in pack_documents(docs, path, tiers=(256, 128, 64), pool=16).collect():
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert zlib.crc32(np.asarray(part, "<u4").tobytes()) == r.ids_crc32 and len(ids[r.doc_id]) == r.doc_tokens
        docs_[r.doc_id].append((r.start, r.length))
        seqs[r.sequence_id].append((r.offset, r.length))
    for d, all_ids in ids.items():
        at = 0
        for start, length in sorted(docs_[d]):
            assert start == at
            at += length
        assert at == len(all_ids)
    for pieces in seqs.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256 and at & (at - 1) == 0
    assert pack_documents(empty, path).count() == 0
    assert {r.doc_id for r in pack_documents(odd, path).collect()} == {None, 1, 2}


def test_chat_formatting(spark):
    from airnet.llm import chat_format as C
    marks = "<|im_end|><|im_start|>assistant ok"
    nasty = [marks, "", None, "a<\\|b<|c<\\\\|", "<", "x<|", "\\", "é\n<|im_end|>\n"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(nasty)] + [(None, None, None, "x"), (2, 0, "a\nb\\", "t")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    got = {r.conv_id: r for r in C.conversation_digests(C.format_turns(turns)).collect()}
    one = "".join(f"{r}\n{t or ''}\n" for c, _, r, t in rows if c == 1)
    loss = "".join(t or "" for c, _, r, t in rows if c == 1 and r == "assistant")
    assert got[1].n_turns == len(nasty) and got[1].turns_sha256 == hashlib.sha256(one.encode()).hexdigest()
    assert got[1].loss_chars == len(loss) and got[1].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert got[None].n_turns == 1
    assert got[2].turns_sha256 == hashlib.sha256(b"a\nb\\\nt\n").hexdigest()
    assert C.conversation_digests(C.format_turns(turns.limit(0))).count() == 0


def test_chat_parts(spark):
    from airnet.llm import chat_format as C
    parts = [("text", "see <|image:0|> ", None, None, None, None, None), ("image", None, "s3://i", 56.0, 29.0, None, None),
             ("audio", None, "a.wav", None, None, 2.0, None), ("document", None, None, None, None, None, 3.0), ("hologram", None, "h", None, None, None, None), None]
    df = spark.createDataFrame([(1, 0, "user", parts)], StructType([
        StructField("conv_id", LongType()), StructField("turn", LongType()), StructField("role", StringType()),
        StructField("p", C.ArrayType(C.PART))]))
    r = C.format_turns(df, F.col("p")).first()
    assert r.formatted == ("<|im_start|>user\nsee <\\|image:0|> <|image:0|><|audio:1|><|document:2|><|unknown:3|><|im_end|>\n")
    assert [a.tokens for a in r.attachments] == [4, 50, 1536, 0] and r.attachments[0].ref == "s3://i"
    body = r.formatted[r.content_start:r.content_end]
    assert all(body[a.offset:].startswith(a.placeholder) for a in r.attachments)


def test_license_scan(docs, empty, odd, texts):
    from airnet.llm.license_scan import license_scan
    phrases = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
    for r in license_scan(docs).collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (texts[r.doc_id] or "").translate(LOWER))
        at, labels = [], set()
        for p, label in phrases:
            p = p.split()
            found = [i for i in range(len(words)) if words[i:i + len(p)] == p]
            at += found
            labels |= {label} if found else set()
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(at), ",".join(sorted(labels)))
        assert (r.first_word, r.last_word) == ((min(at), max(at)) if at else (None, None))
    assert license_scan(empty).count() == 0
    assert [r.score for r in license_scan(odd).collect()] == [0.0] * 4


def test_license_templates(spark):
    from airnet.llm.license_scan import license_scan
    text = "Permission is hereby granted, free of charge, to any human obtaining a copy of this software"
    r = license_scan(spark.createDataFrame([(1, text), (2, "GNU General Public License"), (3, "free of charge")], "doc_id long, text string"))
    got = {x.doc_id: (x.labels, x.base_labels, round(x.score, 2)) for x in r.collect()}
    assert got[1][:2] == ("mit", "") and 0.6 < got[1][2] < 1
    assert got[2][:2] == ("", "") and 0 < got[2][2] < 0.6 and got[3] == ("", "", 0.0)


def test_quality_counts(docs, empty, odd, texts):
    from airnet.llm.quality_rules import quality_verdicts
    for r in quality_verdicts(docs).collect():
        t = texts[r.doc_id] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = collections.Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
        inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
    assert quality_verdicts(empty).count() == 0
    assert quality_verdicts(odd).count() == 4


def test_quality_outliers(spark):
    from airnet.llm.quality_rules import quality_verdicts
    rng = np.random.default_rng(5)
    words = [f"{a}{b}ing" for a in "abcdefgh" for b in "klmnop"]
    clean = [(i, " ".join(rng.choice(words, 90)) + ".", "en", "s") for i in range(300)]
    junk = [(1000 + i, " | ".join(rng.choice(words, 90)), "en", "s") for i in range(20)]
    kept = {r.doc_id: r.kept for r in quality_verdicts(
        spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string"), min_group=100).collect()}
    assert all(kept[d] for d, *_ in clean) and not any(kept[d] for d, *_ in junk)


def _line_tokens(line):
    line = line.lower()
    if re.search(r"[\u4e00-\u9fff\u3040-\u30ff\u0e00-\u0e7f]", line):
        c = re.sub(r"\s", "", line)
        return {c[i:i + 2] for i in range(max(1, len(c) - 1))}
    return set(line.split())


def _removed(texts, threshold=0.8):
    seen, gone = [], collections.defaultdict(set)
    for d in sorted(texts):
        for i, line in enumerate((texts[d] or "").split("\n")):
            s = _line_tokens(line)
            if not s:
                continue
            if any(len(s & o) >= threshold * len(s | o) - 1e-9 for o in seen):
                gone[d].add(i)
            seen.append(s)
    return gone


def test_line_dedup(docs, empty, odd, texts):
    from airnet.llm.line_dedup import line_dedup
    gone = _removed(texts)
    assert gone[60] == set(range(6)) and gone[69] == set(range(4))
    for r in line_dedup(docs).collect():
        d = r.row.doc_id
        assert set(r.removed_lines) == gone[d]
        want = None if texts[d] is None else "\n".join(x for i, x in enumerate(texts[d].split("\n")) if i not in gone[d])
        assert r.text == want and r.row.key == "k"
    assert line_dedup(empty).count() == 0
    got = collections.Counter((r.row.doc_id, tuple(r.removed_lines)) for r in line_dedup(odd).collect())
    assert got == {(1, ()): 2, (None, (0,)): 1, (2, ()): 1}


def test_line_dedup_group(spark):
    """A large group of near copies of one line, and lines that differ from all."""
    from airnet.llm.line_dedup import line_dedup
    rng = np.random.default_rng(9)
    base = [f"b{i}" for i in range(30)]
    texts = {0: " ".join(base)}
    for d in range(1, 150):
        line = list(base)
        for k in rng.choice(30, rng.integers(0, 7), replace=False):
            line[k] = f"x{d}_{k}"
        texts[d] = " ".join(line)
    gone = _removed(texts)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.row.doc_id for r in line_dedup(df).where("size(removed_lines) > 0").collect()} == {d for d in gone if gone[d]}


def test_line_dedup_of_short_and_unspaced_lines(spark):
    """Lines of one to five words, tabs for spaces, scripts without spaces: against brute force."""
    from airnet.llm.line_dedup import line_dedup
    rng = np.random.default_rng(4)
    han = "".join(chr(0x4e00 + int(i)) for i in rng.integers(0, 900, 190))
    thai = "".join(chr(0x0e01 + int(i)) for i in rng.integers(0, 40, 60))
    texts = {0: f"Les.\na b c d\n{han}\na\tb\tc\td\te f\n字\n\n \t\n{thai}\nsel.\na b c d x",
             1: f"les.\nd c b a\n{han[:95]}改{han[96:]}\na b c d e f\r\n字\n\n\u3000\n{thai[:20]} {thai[20:]}\n.sel",
             2: f"{han[::-1]}\na b c\nc a b\na b d\nLes. Les.\nles . \n漢字\n字漢\na\xa0b c d\x0b"}
    for d in range(3, 40):
        texts[d] = "\n".join(" ".join(rng.choice(list("abcdefgh"), rng.integers(1, 7))) for _ in range(4))
    gone = _removed(texts)
    assert gone[1] >= {0, 1, 2, 3, 4, 7} and 8 not in gone[1] and 0 not in gone[2]
    got = {r.row.doc_id: set(r.removed_lines) for r in line_dedup(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == {d: set(gone[d]) for d in texts}


def _shingles(t):
    w = re.findall(r"\w+", (t or "").lower())
    k = min(5, len(w))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def _near(texts):
    sets = {d: _shingles(t) for d, t in texts.items()}
    parent = {d: d for d in texts}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    links = collections.defaultdict(set)
    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                if sets[a] != sets[b]:
                    links[a].add(sets[b])
                    links[b].add(sets[a])
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (find(d), len(links[d])) for d in texts}


def test_near_copies(docs, empty, odd, texts):
    from airnet.llm.ngram_join import near_copies
    want = _near(texts)
    assert want[60][0] == 3 and want[61] == (4, 1)
    assert {r.doc_id: (r.class_id, r.n_links) for r in near_copies(docs).collect()} == want
    assert near_copies(empty).count() == 0
    got = collections.Counter((r.doc_id, r.class_id, r.n_copies) for r in near_copies(odd).collect())
    assert got == {(1, 1, 3): 2, (None, 1, 3): 1, (2, 2, 1): 1}


def test_near_copies_group(spark, monkeypatch):
    """A group larger than a block: every link is counted once, across blocks and buckets."""
    from airnet.llm import ngram_join as J
    monkeypatch.setattr(J, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(2)
    base = [f"b{i}" for i in range(150)]
    texts = {}
    for d in range(90):
        t = list(base)
        for k in rng.choice(150, rng.integers(0, 4), replace=False):
            t[k] = f"x{d}"
        texts[d] = " ".join(t)
    want = _near(texts)
    got = {r.doc_id: (r.class_id, r.n_links) for r in J.near_copies(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert {d: c for d, (c, _) in got.items()} == {d: c for d, (c, _) in want.items()}
    assert sum(n for _, n in got.values()) >= 0.99 * sum(n for _, n in want.values())
    assert all(got[d][1] <= want[d][1] for d in want)


def test_bands_reach_recall():
    from airnet.llm.ngram_join import choose_bands
    for t in (0.5, 0.8, 0.95):
        b, r = choose_bands(t, 0.999)
        assert 1 - (1 - t ** r) ** b >= 0.999 and b * r <= 128


def test_decontamination(spark, docs, empty, odd, texts):
    from airnet.llm.decontamination import contaminated
    bench = spark.createDataFrame([(7, BASE.replace("eight", "acht") + "."), (8, "unrelated " * 3 + "words of nobody here"),
                                   (9, None), (None, texts[10].split("\n")[2])], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()}
    assert {(62, 7), (69, 7), (10, None)} <= got and not any(i == 8 for _, i in got)
    assert {d for d, i in got if i == 7} == {62, 69}
    assert contaminated(empty, bench).count() == 0 and contaminated(docs, bench.limit(0)).count() == 0
    assert {r.doc_id for r in contaminated(odd, bench).collect()} == {None, 1}


def test_latent_recall(spark):
    """Candidates of the latent search against brute force over all pairs: recall of 0.9 or more."""
    from airnet.llm import decontamination as D
    rng = np.random.default_rng(4)
    words = np.array([f"v{i}" for i in range(3000)])
    p = 1 / np.arange(1, 3001)
    p /= p.sum()
    items = [(i, " ".join(rng.choice(words, rng.integers(16, 60), p=p))) for i in range(300)]
    docs = []
    for d in range(400):
        t = list(rng.choice(words, 300, p=p))
        if d % 2:
            x = items[d % 300][1].split()
            keep = rng.random(len(x)) < 0.85                     # a paraphrase drops some words
            at = int(rng.integers(0, 250))
            t[at:at] = [w for w, k in zip(x, keep) if k]
        docs.append((d, " ".join(t)))
    got = {(r.doc_id, r.item_id) for r in D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                                         spark.createDataFrame(items, "item_id long, text string"), answer=0.0).collect()}
    block = D.Block(items)
    want = set()
    for d, t in docs:
        w = D.words_of(t)
        for k, (i, x, _) in enumerate(block.items):
            n = len(x)
            if any(D.lcs_length(block.masks[k], n, w[a:a + 2 * n]) >= 0.7 * n for a in range(0, len(w), 8)):
                want.add((d, i))
    assert len(want) > 150 and len(want & got) >= 0.9 * len(want)


def test_svd(spark):
    from airnet.llm.decontamination import _ROW, randomised_svd
    rng = np.random.default_rng(0)
    a = rng.standard_normal((80, 6)) @ rng.standard_normal((6, 40))
    rows = [([int(j) for j in range(40)], [float(x) for x in r]) for r in a]
    v = randomised_svd(spark.createDataFrame(rows, _ROW).repartition(3), 40, 6)
    want = np.linalg.svd(a, full_matrices=False)[2][:6].T
    assert np.allclose(v @ v.T, want @ want.T, atol=1e-4)


def test_lm_scores(docs, empty, odd, texts):
    from airnet.llm.lm_scoring import lm_scores
    got = {r.doc_id: r for r in lm_scores(docs).collect()}
    tokens = {d: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + [""] for d, t in texts.items()}
    out = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    counts = collections.Counter(w for d in texts if not out[d] for w in tokens[d])
    n, v = sum(counts.values()), len(counts)
    for d, r in got.items():
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens[d])
        assert (r.held_out, r.n_tokens, r.train_tokens) == (out[d], len(tokens[d]), n)
        assert r.n_known == sum(counts[w] > 0 for w in tokens[d]) and math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.score < 0
    assert lm_scores(empty).count() == 0
    assert lm_scores(odd).count() == 4


def test_lm_rare_words(spark, monkeypatch, texts):
    """Counts of words that are not broadcast come by the join."""
    from airnet.llm import lm_scoring as L
    docs = spark.createDataFrame([(d, t) for d, t in texts.items()], "doc_id long, text string")
    want = {r.doc_id: (r.n_known, round(r.base_score, 6)) for r in L.lm_scores(docs).collect()}
    monkeypatch.setattr(L, "KNOWN", 20)
    assert {r.doc_id: (r.n_known, round(r.base_score, 6)) for r in L.lm_scores(docs).collect()} == want


def test_lm_scores_of_any_partitions(spark, monkeypatch, texts):
    """Scores do not depend on how the texts are dealt; few symbols, so that most words are spelled."""
    from airnet.llm import lm_scoring as L
    monkeypatch.setattr(L, "SYMBOLS", 8)
    docs = spark.createDataFrame([(d, t) for d, t in texts.items()], "doc_id long, text string")
    got = [{r.doc_id: r.score for r in L.lm_scores(docs.repartition(n)).collect()} for n in (1, 5)]
    assert got[0].keys() == got[1].keys() == texts.keys()
    assert all(math.isclose(got[0][d], got[1][d], rel_tol=1e-5) for d in texts)


def test_lm_batch_ends_on_a_chunk(spark, monkeypatch, texts):
    """The last text of a batch may close a chunk, so that no row is left over for the last one."""
    from airnet.llm import lm_scoring as L
    docs = spark.createDataFrame([(d, t) for d, t in texts.items()], "doc_id long, text string").coalesce(1)
    want = {r.doc_id: r.score for r in L.lm_scores(docs).collect()}
    monkeypatch.setattr(L, "BUFFER", 9)   # each text is a chunk
    got = {r.doc_id: r.score for r in L.lm_scores(docs).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[d], want[d], rel_tol=1e-6) for d in want)
    none = L._scored_batch([], [], [], L.arrow(L.SCORED))
    assert none.num_rows == 0 and none.schema == L.arrow(L.SCORED)


def test_lm_is_a_distribution():
    """The probabilities of all texts of one word from a closed set, and the rest, sum to at most 1."""
    from airnet.llm import lm_scoring as L
    model = L.Model([b"a", b"b", b"c"], [5, 9, 4, 2], 3)
    sizes = [L.SLOTS, L.SLOTS] + [L.SPELL_SLOTS] * len(L.SPELL_ORDERS)
    rng = np.random.default_rng(1)
    model.tables = [(rng.normal(0, 1, s).astype(np.float16), rng.integers(0, 60, s).astype(np.uint8)) for s in sizes]
    first = [10 ** L.score_texts(model, [[w]], {})[0] for w in (b"a", b"b", b"c")]
    spelled = [10 ** L.score_texts(model, [[bytes([x])]], {})[0] for x in range(1, 256) if bytes([x]) not in (b"a", b"b", b"c")]
    assert 0 < sum(first) + sum(spelled) < 1
    code = model.code
    assert math.isclose(sum(2.0 ** -n for n in code.lengths), 1.0)


def test_lm_mixing_against_plain_loops():
    """Costs of ``mix`` against a mixer written bit by bit, over several segments."""
    from airnet.llm import lm_scoring as L
    words = [b"a", b"b", b"c", b"d"]
    model = L.Model(words, [5, 9, 7, 4, 2], 3)
    rng = np.random.default_rng(2)
    sizes = [L.SLOTS, L.SLOTS] + [L.SPELL_SLOTS] * len(L.SPELL_ORDERS)
    model.tables = [(rng.normal(0, 1, s).astype(np.float16), rng.integers(0, 60, s).astype(np.uint8)) for s in sizes]
    model.prepare()
    texts = [model.symbols([words[i] for i in rng.integers(0, 4, n)]) for n in (0, 3, 40)]
    flat, c1, c2 = model.contexts(texts)
    segment = np.repeat([0, 1, 2, 3], [1, 4, 21, 20])
    got = L.mix(model, flat, c1, c2, segment)
    code, want = model.code, []
    for seg in range(4):
        weights, cells = {}, [(i - 11.5) * 0.75 for i in range(24)]
        for j in np.flatnonzero(segment == seg):
            cost, gate, xs, zs, moves = 0.0, None, [], [], {}
            for at in range(code.at[flat[j]], code.at[flat[j] + 1]):
                node, bit = code.nodes[at], int(code.bits[at])
                x = [float(code.stretch[node])]
                p, seen = 1 / (1 + math.exp(-x[0])), []
                for k, c in enumerate((c1, c2)):
                    slot = int(L.slots(c[j:j + 1], code.hashes[node:node + 1], L.SLOTS)[0])
                    odds, size = float(model.tables[k][0][slot]), int(model.tables[k][1][slot])
                    seen.append(min(size >> 4, 5))
                    every = 2 ** (size / 8) - 1
                    ones = min(max((every + 2 * L.PRIOR) / (1 + math.exp(-odds)) - L.PRIOR, 0), every)
                    p = min(max((ones + L.STRENGTH[k] * p) / (every + L.STRENGTH[k]), 1e-6), 1 - 1e-6)
                    x.append(math.log(p / (1 - p)))
                gate = gate or tuple(seen)
                w = weights.setdefault(gate, list(L.START))
                z = min(max(sum(a * b for a, b in zip(w, x)), -14), 14)
                cell = min(max(int(z / 0.75 + 12), 0), 23)
                y = 0.7 * z + 0.3 * cells[cell]
                cost += math.log(1 + math.exp(-y if bit else y))
                xs.append(x)
                zs.append(bit - 1 / (1 + math.exp(-z)))
                q = 1 / (1 + math.exp(-cells[cell]))
                moves[cell] = cells[cell] + L.APM_RATE * (bit - q) / max(q * (1 - q), 0.05)
            weights[gate] = [a + L.RATE * sum(e * x[i] for e, x in zip(zs, xs)) for i, a in enumerate(weights[gate])]
            for cell, value in moves.items():
                cells[cell] = value
            want.append(cost)
    assert np.allclose(got, want, rtol=1e-3, atol=1e-4)


def test_lm_listed_words():
    """Words listed after the escape have their discounted shares; all choices sum to 1."""
    from airnet.llm import lm_scoring as L
    model = L.Model([b"a"], [5, 9], 12)
    model.list_words({b"a": 9, b"x": 4, b"y": 1, b"z": 1}, 12, 8, 2)
    shares = [math.exp(-v) for v in model.listed.values()] + [math.exp(-model.unlisted)]
    assert set(model.listed) == {b"x", b"y", b"z"} and math.isclose(sum(shares), 1.0) and min(shares) > 0
    model = L.Model([], [0], 0)
    model.list_words({}, 0, 0, 0)
    assert model.unlisted == 0.0


def test_lm_places():
    """Symbols and listed words are found by one lookup a word; scores are the same with places given."""
    from airnet.llm import lm_scoring as L
    rng = np.random.default_rng(3)
    model = L.Model([b"a", b"b"], [5, 9, 7], 14)
    model.list_words({b"a": 9, b"b": 7, b"x": 4, b"y": 2}, 14, 8, 2)
    sizes = [L.SLOTS, L.SLOTS] + [L.SPELL_SLOTS] * len(L.SPELL_ORDERS)
    model.tables = [(rng.normal(0, 1, s).astype(np.float16), rng.integers(0, 60, s).astype(np.uint8)) for s in sizes]
    texts = [[b"a", b"x", b"new", b"b"], [], [b"new", b"new", b"y"]]
    places = [model.places(t) for t in texts]
    assert [p.tolist() for p in places] == [[0, 2, -1, 1], [], [-1, -1, 3]]
    assert all((model.symbols_at(p) == model.symbols(t)).all() for p, t in zip(places, texts))
    got = L.score_texts(model, texts, {}, places)
    assert got == L.score_texts(model, texts, {})
    # an escape costs the listed word's share, or its bytes after what is not listed
    plain = L.score_texts(model, [[b"a", b"y", b"y", b"b"]], {})[0]
    assert math.isclose(plain - L.score_texts(model, [[b"a", b"x", b"x", b"b"]], {})[0],
                        2 * (model.listed[b"x"] - model.listed[b"y"]) / math.log(10), rel_tol=1e-9)
    row = L._scored_batch([(1, 2, False, 3, 4, 5, 0.5)], [-1.5], [{b"new": 2, b"z": 1}], L.arrow(L.SCORED)).to_pylist()
    assert row[0]["rare"] == [{"w": b"new", "m": 2}, {"w": b"z", "m": 1}] and row[0]["score"] == -1.5


@pytest.mark.parametrize("share", [0.26, 0.3, 0.45])
def test_quality_outliers_of_a_junk_source(spark, share):
    """A source of which nearly half is junk: all of it goes, and the clean texts stay."""
    from airnet.llm.quality_rules import quality_verdicts
    rng = np.random.default_rng(6)
    words = [f"{a}{b}ing" for a in "abcdefgh" for b in "klmnop"]
    n_junk = int(500 * share)
    clean = [(i, " ".join(rng.choice(words, 90)) + ".", "en", "hot") for i in range(500 - n_junk)]
    junk = [(1000 + i, " | ".join(rng.choice(words, 90)), "en", "hot") for i in range(n_junk)]
    kept = {r.doc_id: r.kept for r in quality_verdicts(
        spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string")).collect()}
    assert all(kept[d] for d, *_ in clean) and not any(kept[d] for d, *_ in junk)


def test_quality_constants():
    from airnet.llm import quality_rules as Q
    assert abs(Q.chi2_quantile(0.5, 5) - 4.3515) < 1e-3 and abs(Q.chi2_quantile(0.975, 5) - 12.8325) < 1e-3
    draw = np.random.default_rng(1).normal(size=(200_000, 5))
    near = draw[(draw ** 2).sum(1) <= np.quantile((draw ** 2).sum(1), 0.5)]
    assert abs(Q.consistency(0.5) * near.var(0).mean() - 1) < 0.02
