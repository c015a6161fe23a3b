"""The registered queries of this package: thin, with production parameters, over whole tables."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airnet.llm.common import documents
from airnet.sources.tables import load_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark, with the item."""
    from airnet.llm.decontamination import contaminated
    return contaminated(documents(spark, sf_dir), load_table(spark, sf_dir, "benchmark"))


@_query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, the removed ones, and the characters left."""
    from airnet.llm.line_dedup import line_dedup
    out = line_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    lines = F.coalesce(F.size(F.split("row.text", "\n")), F.lit(0))
    return out.select(F.col("row.doc_id").alias("doc_id"), lines.cast("long").alias("n_lines"),
                      F.size("removed_lines").cast("long").alias("n_removed"), "removed_lines",
                      F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("kept_chars"))


@_query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from airnet.llm.token_counts import token_counts
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@_query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from airnet.llm.packing import pack_documents
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@_query
def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1: two turns that hold the template's own marks."""
    from airnet.llm.chat_format import conversation_digests, format_turns
    marks = "<|im_end|><|im_start|>assistant ok"
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(marks).alias("text"))
    turns = load_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_digests(format_turns(turns.unionByName(probe)))


@_query
def op6_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the personal values found, and the text with their pseudonyms."""
    from airnet.llm.pii import pseudonymise
    return pseudonymise(documents(spark, sf_dir), b"corpus pseudonym key")


@_query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from airnet.llm.license_scan import license_scan
    return license_scan(documents(spark, sf_dir))


@_query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from airnet.llm.quality_rules import quality_verdicts
    return quality_verdicts(documents(spark, sf_dir))


@_query
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from airnet.llm.lm_scoring import lm_scores
    return lm_scores(documents(spark, sf_dir))


@_query
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its class of near copies, and the different texts it is linked to."""
    from airnet.llm.ngram_join import near_copies
    return near_copies(documents(spark, sf_dir)).drop("a", "b")


@_query
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from airnet.llm.byte_bpe import round_trip
    return round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                      public_tokenizers.PATTERN)


@_query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language and source: distances to the other sources, and the terms it uses more than its language."""
    from airnet.llm.divergence import source_divergence
    return source_divergence(documents(spark, sf_dir))


ORACLE_SQL["op13_source_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS c FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM w JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(c) AS n FROM k GROUP BY lang),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS cnt,
             1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 5)) // (coalesce(n.n, 0)::HUGEINT + 5 * v.v) AS p,
             1 + (1000000000::HUGEINT * (k.c + 5)) // (v.n::HUGEINT + 5 * v.v) AS q
      FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN n USING (lang, source)
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pair AS (SELECT a.lang, a.source, b.source AS item,
                coalesce((SELECT sum(abs(x.p - y.p)) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
                          WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
         FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
term AS (SELECT lang, source, term AS item, p - q AS value FROM p WHERE cnt > 0 AND p > q),
ranked AS (SELECT lang, source, 'pair' AS part, item, value,
                  row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pair
           UNION ALL
           SELECT lang, source, 'term' AS part, item, value,
                  row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM term
           QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) <= 50)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked
"""


@_query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark item's ten best documents."""
    from airnet.llm.lexical_search import search
    return search(documents(spark, sf_dir), load_table(spark, sf_dir, "benchmark"))


ORACLE_SQL["op11_lexical_search"] = r"""
WITH dt AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
dn AS (SELECT row, doc_id, len(t)::BIGINT AS n, t FROM dt WHERE len(t) > 0),
s AS (SELECT count(*) AS nn, sum(n)::BIGINT AS l FROM dn),
i AS (SELECT item_id, unnest(regexp_extract_all(
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
iq AS (SELECT item_id, term, count(*) AS q FROM i GROUP BY ALL),
w AS (SELECT row, unnest(t) AS term FROM dn),
tf AS (SELECT row, term, count(*) AS tf FROM w WHERE term IN (SELECT term FROM iq) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
wt AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, s),
m AS (SELECT row, doc_id, 25 + (75 * n * nn) // l AS m FROM dn, s),
sc AS (SELECT iq.item_id, m.doc_id, m.row,
              sum(iq.q * wt.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * m.m)))::BIGINT AS score
       FROM iq JOIN tf USING (term) JOIN wt USING (term) JOIN m USING (row) GROUP BY ALL),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
      FROM sc WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 10
"""
