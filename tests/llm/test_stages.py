"""Stages on tables with odd column names and rows that share id and text."""
from pyspark.sql.types import LongType, MapType, StringType, StructField, StructType

from airnet.llm import stages

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("a`b.c", StringType()),
                     StructField("row", StringType()), StructField("m", MapType(StringType(), LongType()))])
WORDS = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


def test_rows_that_share_id_and_text_keep_the_least(spark):
    rows = [(7, WORDS, "z", None, {"k": 1}), (7, WORDS, "c", "r", None), (7, WORDS, "x", None, None),
            (8, "another text of its own altogether here", "q", None, None), (8, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for n in (1, 4):
        kept = stages.near_copies_stage(spark, docs.repartition(n), "")
        assert kept.columns == docs.columns
        assert sorted((r["doc_id"], r["text"] is None, r["a`b.c"]) for r in kept.collect()) == [
            (7, False, "c"), (8, False, "q"), (8, True, None)]


def test_line_dedup_keeps_odd_columns(spark):
    rows = [(1, WORDS, "x", "r", {"k": 2}), (2, WORDS + "\nand a second line that is found nowhere else", "y", None, None),
            (3, WORDS, "z", None, None)]
    out = stages.line_dedup_stage(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert out.columns == [f.name for f in SCHEMA.fields]
    assert sorted((r["doc_id"], r["text"], r["a`b.c"]) for r in out.collect()) == [
        (1, WORDS, "x"), (2, "and a second line that is found nowhere else", "y")]


def test_quality_rules_send_few_texts_at_once(spark, monkeypatch):
    from airnet.llm import quality_rules
    seen, write = [], quality_rules.materialize
    keys = [f"spark.sql.execution.arrow.{k}" for k in ("maxRecordsPerBatch", "maxBytesPerBatch")]

    def spy(frame, label="state"):
        seen.append((label, *[spark.conf.get(k) for k in keys]))
        return write(frame, label)

    before = [spark.conf.get(k) for k in keys]
    monkeypatch.setattr(quality_rules, "materialize", spy)
    docs = spark.createDataFrame([(i, "a b c", "en", "x") for i in range(3)], "doc_id long, text string, lang string, source string")
    assert quality_rules.quality_verdicts(docs).count() == 3
    assert seen[0][0] == "stats" and int(seen[0][1]) <= 500 and int(seen[0][2].rstrip("b")) <= 4 << 20
    assert [spark.conf.get(k) for k in keys] == before


def test_a_task_gives_its_memory_back():
    import subprocess
    import sys
    code = """
import re
from airnet.llm.common import lean

def held():
    return int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) >> 10

def run(batches):
    blocks = [bytearray(2_000) for _ in range(100_000)]
    keep.extend(blocks[::2_000])     # what stays lies among what goes
    yield from batches

keep, before = [], held()
assert list(lean(run)([1, 2])) == [1, 2]
print(held() - before)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    assert int(out.stdout) < 60  # of 200 MB


def test_workers_get_few_texts_at_once(spark, monkeypatch):
    from airnet.llm import ngram_join
    seen, write = {}, stages.materialize

    def noted(df, label="state"):
        seen[label] = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
        return write(df, label)

    monkeypatch.setattr(stages, "materialize", noted)
    monkeypatch.setattr(ngram_join, "materialize", noted)
    docs = spark.createDataFrame([(i, WORDS + " again" * (i % 2), "q", None, None) for i in range(4)], SCHEMA)
    ngram_join.near_copies(docs)
    assert stages.packing(spark, docs, "").count() >= 4
    assert max(seen[k] for k in ("signatures", "sets", "pieces")) <= 500
