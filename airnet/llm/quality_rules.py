"""Quality rules: robust multivariate outliers per language and source.

Each document gives a few counts (one pass, text by text) and from them a vector of transformed
shares.  For every ``(lang, source)``, language and the whole corpus a minimum-covariance-determinant
estimate of location and scatter is found as in FastMCD, with the smallest spreads ``FLOOR`` added to
each scatter, so that no determinant is 0:

1. **Starts.**  On a hashed draw of about ``DRAW`` documents a group, the medians and ``STARTS``
   random sets of p + 1 documents are concentrated; the ``CANDIDATES`` of smallest determinant
   go on.  The draw only proposes starts.
2. **Concentration** over *all* documents: keep the nearer half, take its mean and covariance
   (times the consistency factor), and repeat until the determinant stops falling.  The
   smallest determinant wins.
3. **Reweighting** over all documents: mean and covariance of those within the cut-off, until
   their number stays.

A document is rejected if its squared Mahalanobis distance exceeds the quantile of chi-square(p)
at ``LEVEL``, or if it fails the base rule.

Scale: the vectors (a few dozen bytes a document) are written once to the shared folder.  Each
step is one grouped aggregate over all groups at once (combined before the shuffle, so a group with a
third of all rows is no hot spot) and a join with a few small rows per group; nothing is collected.
Groups of fewer than ``MIN_GROUP`` documents use their language's estimate, and that the whole corpus's.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from airnet.llm.common import arrow, batches, rows, ship
from airnet.session import materialize

WHITE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
SUPPORT = 0.5           # share of a group that its estimate rests on: fewer than half may be junk
DRAW = 600              # documents of a group that starts are drawn from
STARTS = 40
CANDIDATES = 3          # starts of each group that are concentrated over all its documents
FALL = 1e-4             # a smaller fall of the determinant's logarithm is none
ROUNDS = 30             # of reweighting, should two sets of documents take turns
MIN_GROUP = 200
#: Texts that go to Python at once; a task holds them several times over, outside of the JVM's heap.
BATCH_ROWS, BATCH_BYTES = 500, 4 << 20
#: One in a million documents of a normal group lies beyond the cut-off.
LEVEL = 1 - 1e-6
FEATURES = ("f_length", "f_symbols", "f_dup_lines", "f_repeats", "f_letters")
#: Smallest spread of each feature: shares that are constant in a group (no symbols at all) would
#: else make any difference infinitely far.
FLOOR = (0.10, 0.10, 0.35, 0.15, 0.10)

STATS_SCHEMA = StructType(
    [StructField("doc_id", LongType())]
    + [StructField(c, LongType(), False) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                   "n_repeat_words")]
    + [StructField("base_failed", BooleanType(), False)]
    + [StructField(c, DoubleType(), False) for c in FEATURES])


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=n)
    if len(number) < 1 << 21:
        windows = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
    else:  # too many different words for three in 63 bits: number the pairs first
        pairs = np.unique((ids[:-1] << 31) | ids[1:], return_inverse=True)[1].astype(np.int64)
        windows = (pairs[:-1] << 31) | ids[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(windows), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, dtype=bool)
    covered[:-2] |= twice
    covered[1:-1] |= twice
    covered[2:] |= twice
    return int(covered.sum())


def text_stats(text: str) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, letters of a whole text."""
    raw = text.encode("utf-8")
    words = raw.split()
    blank = len(raw) - len(raw.translate(None, WHITE))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip(WHITE)]
    letters = len(text) - blank - (len(raw) - len(raw.translate(None, WHITE + _NOT_LETTERS)) - blank)
    return (len(words), len(text) - blank, symbols, len(lines) - len(set(lines)), repeated_words(words), letters,
            len(lines), sum(map(raw.count, (b"!", b"?"))))


_NOT_LETTERS = bytes(b for b in range(128) if not chr(b).isalpha() and b not in WHITE)


def features(stats: tuple) -> tuple:
    """Transformed shares: log word length; logs of symbol, repeated-line and repeated-word
    shares in thousandths; log odds of marks against letters."""
    n_words, word_chars, n_symbols, n_dup, n_repeat, letters, n_lines, shouts = stats
    words, chars = max(n_words, 1), max(word_chars, 1)
    return (float(np.log((word_chars + 5.0) / (words + 1.0))),
            float(np.log1p(100.0 * (n_symbols + shouts) / chars)),
            float(np.log1p(10.0 * n_dup / max(n_lines, 1))),
            float(np.log1p(10.0 * n_repeat / words)),
            float(np.log((chars - letters + 1.0) / (letters + 1.0)) / 4.0))


def document_stats(docs: DataFrame, *keep: str) -> DataFrame:
    """Counts and vector of every row (doc_id, text); ``keep``: columns to carry along."""
    ship(docs.sparkSession)
    carried = [StructField(f"__{i}", StringType()) for i in range(len(keep))]
    schema = StructType(STATS_SCHEMA.fields + carried)
    as_arrow = arrow(schema)
    frame = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        *[F.col(c).cast("string").alias(f"__{i}") for i, c in enumerate(keep)])

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, text, *rest in rows(batch, "doc_id", "text", *[f.name for f in carried]):
                stats = text_stats(text or "")
                failed = stats[0] < MIN_WORDS or 100 * stats[4] > 50 * stats[0]
                out.append((doc_id, *stats[:5], failed, *features(stats), *rest))
            cols = list(zip(*out)) or [[] for _ in as_arrow]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, as_arrow)], schema=as_arrow)

    return frame.mapInArrow(run, schema)


def chi2_share(x: float, df: int) -> float:
    """Share of chi-square with an odd number of degrees of freedom below ``x``."""
    share = math.erf(math.sqrt(x / 2))
    for k in range(1, df - 1, 2):
        share -= (x / 2) ** (k / 2) * math.exp(-x / 2) / math.gamma(k / 2 + 1)
    return share


def chi2_quantile(share: float, df: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_share(middle, df) < share else (low, middle)
    return high


CUTOFF = chi2_quantile(LEVEL, len(FEATURES))


def consistency(share: float) -> float:
    """What the covariance of the nearest ``share`` of a normal group is to be multiplied by."""
    p = len(FEATURES)
    return share / chi2_share(chi2_quantile(share, p), p + 2)


def _fit(x: np.ndarray, weight: np.ndarray, factor: float) -> tuple[float, np.ndarray, np.ndarray]:
    """log determinant, mean and scatter of weighted vectors."""
    mean = np.average(x, axis=0, weights=weight)
    d = x - mean
    cov = factor * (d * weight[:, None]).T @ d / weight.sum() + np.diag(np.square(FLOOR))
    return float(np.linalg.slogdet(cov)[1]), mean, cov


def _nearest(x: np.ndarray, weight: np.ndarray, mean: np.ndarray, cov: np.ndarray) -> np.ndarray:
    d = x - mean
    order = np.argsort(np.einsum("ij,ij->i", d @ np.linalg.inv(cov), d), kind="stable")
    held = np.cumsum(weight[order])
    return order[:int(np.searchsorted(held, SUPPORT * held[-1])) + 1]


def search(x: np.ndarray, weight: np.ndarray) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """The ``CANDIDATES`` different estimates of smallest determinant over many starts."""
    rng, factor = np.random.default_rng(len(x)), consistency(SUPPORT)
    flat = np.ones(len(x))
    starts = [(0.0, np.median(x, axis=0), np.diag(np.square(FLOOR)))]
    starts += [_fit(x[i], flat[i], 1.0) for i in (rng.choice(len(x), min(len(x), len(FEATURES) + 1), replace=False)
                                                  for _ in range(STARTS))]

    def step(fit):
        near = _nearest(x, weight, fit[1], fit[2])
        return _fit(x[near], weight[near], factor)

    found: list[tuple[float, np.ndarray, np.ndarray]] = []
    for fit in sorted((step(step(s)) for s in starts), key=lambda f: f[0])[:4 * CANDIDATES]:
        while (after := step(fit))[0] < fit[0] - FALL / 100:
            fit = after
        if all(abs(fit[0] - f[0]) > FALL for f in found):
            found.append(fit)
    return sorted(found, key=lambda f: f[0])[:CANDIDATES]


KEYS = ["level", "lang", "source"]
_ESTIMATE = "level int, lang string, source string, cand int, n long, fall double, logdet double, mean array<double>, precision array<double>"


def _estimates(moments: DataFrame, factor: float) -> DataFrame:
    """Log determinant, its fall, and inverse of each scatter, widened by the smallest spreads."""
    upper = np.triu_indices(len(FEATURES))

    def run(frames):
        for pdf in frames:
            logdets, out = [], []
            for cov in pdf["cov"]:
                full = np.zeros((len(FEATURES),) * 2)
                full[upper] = factor * np.asarray(cov, dtype=float)
                full = full + np.triu(full, 1).T + np.diag(np.square(FLOOR))
                logdets.append(float(np.linalg.slogdet(full)[1]))
                out.append(np.linalg.inv(full).ravel().tolist())
            pdf["logdet"], pdf["precision"] = logdets, out
            pdf["fall"] = pdf["before"] - pdf["logdet"]
            yield pdf[["level", "lang", "source", "cand", "n", "fall", "logdet", "mean", "precision"]]

    return moments.mapInPandas(run, _ESTIMATE)


def _moments(frame: DataFrame, factor: float) -> DataFrame:
    """Estimates from the rows of each group and candidate; ``logdet``: that of the last step."""
    p = len(FEATURES)
    means = F.array(*[F.avg(f) for f in FEATURES])
    cov = F.array(*[F.covar_pop(FEATURES[i], FEATURES[j]) for i in range(p) for j in range(i, p)])
    return _estimates(frame.groupBy(*KEYS, "cand").agg(F.count(F.lit(1)).alias("n"), F.min("logdet").alias("before"),
                                                       means.alias("mean"), cov.alias("cov")), factor)


def _starts(stats: DataFrame, sizes: DataFrame) -> DataFrame:
    """Candidates of each group, from a draw of its documents that hangs on nothing but the rows."""
    chance = F.pmod(F.xxhash64("doc_id", *FEATURES), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = (stats.join(sizes, KEYS, "inner").where(chance * F.col("size") < F.lit(float(DRAW)))
             .groupBy(*KEYS, "doc_id", *FEATURES).agg(F.count(F.lit(1)).cast("double").alias("w")))
    drawn = drawn.groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.array(*FEATURES, "w"))).alias("rows"))

    def run(frames):
        for pdf in frames:
            out = []
            for level, lang, source, rows_ in zip(pdf["level"], pdf["lang"], pdf["source"], pdf["rows"]):
                drawn_ = np.array([list(r) for r in rows_], dtype=float)
                for i, (logdet, mean, cov) in enumerate(search(drawn_[:, :-1], drawn_[:, -1])):
                    out.append((level, lang, source, i, 0, 0.0, logdet, mean.tolist(), np.linalg.inv(cov).ravel().tolist()))
            yield pd.DataFrame(out, columns=["level", "lang", "source", "cand", "n", "fall", "logdet", "mean", "precision"])

    return drawn.mapInPandas(run, _ESTIMATE)


def distance(mean: Column, precision: Column) -> Column:
    """Squared Mahalanobis distance of the feature vector."""
    p = len(FEATURES)
    d = [F.col(f) - mean[i] for i, f in enumerate(FEATURES)]
    total = F.lit(0.0)
    for i in range(p):
        total = total + d[i] * d[i] * precision[i * p + i]
        for j in range(i + 1, p):
            total = total + F.lit(2.0) * d[i] * d[j] * precision[i * p + j]
    return total


def _placed(stats: DataFrame, estimates: DataFrame) -> DataFrame:
    held = stats.join(estimates.select(*KEYS, "cand", "logdet", "mean", "precision"), KEYS, "inner")
    return held.select(*KEYS, "cand", "logdet", *FEATURES, distance(F.col("mean"), F.col("precision")).alias("d2"))


def robust_estimates(passed: DataFrame, min_group: int) -> DataFrame:
    """``level, lang, source, mean, precision``: the reweighted MCD estimate of each language and source
    (level 2), language (1) and of all (0) with at least ``min_group`` documents."""
    none = F.lit("")
    stats = passed.select("doc_id", *FEATURES, F.explode(F.array(*[
        F.struct(F.lit(k).alias("level"), (F.col("lang") if k else none).alias("lang"),
                 (F.col("source") if k == 2 else none).alias("source")) for k in range(3)])).alias("g"))
    stats = stats.select("g.*", "doc_id", *FEATURES)
    sizes = materialize(stats.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= min_group), "sizes")
    best = materialize(_starts(stats, sizes), "mcd")
    best = best.withColumn("logdet", F.lit(math.inf))  # of the draw; the first step over all documents sets it
    going, done = best, None
    while going.limit(1).count():
        bound = materialize(_placed(stats, going).groupBy(*KEYS, "cand")
                            .agg(F.percentile_approx("d2", SUPPORT, 10_000).alias("bound")), "bound")
        near = _placed(stats, going).join(bound, [*KEYS, "cand"], "inner").where("d2 <= bound")
        after = materialize(_moments(near, consistency(SUPPORT)), "mcd")
        stopped = going.join(after.where(F.col("fall") <= FALL).select(*KEYS, "cand"), [*KEYS, "cand"], "left_semi")
        done = stopped if done is None else done.unionByName(stopped)
        going = after.where(F.col("fall") > FALL)
    if done is None:
        return best.select(*KEYS, "mean", "precision")
    least = F.min(F.struct("logdet", "cand", "mean", "precision")).alias("v")
    now = done.groupBy(*KEYS).agg(least).select(*KEYS, "v.cand", "v.logdet", F.lit(0).cast("long").alias("n"), "v.mean", "v.precision")
    now = materialize(now, "mcd")

    settled = None
    for k in range(ROUNDS):
        within = _placed(stats, now).where(F.col("d2") <= F.lit(CUTOFF))
        after = materialize(_moments(within, 1.0), "reweighted")
        moved = after.join(now.select(*KEYS, F.col("n").alias("last")), KEYS, "inner")
        moved = materialize(moved.withColumn("same", F.col("n") == F.col("last")), "reweighted")
        ended = moved.where("same").select(*KEYS, "mean", "precision")
        settled = ended if settled is None else settled.unionByName(ended)
        now = moved.where("not same")
        if not now.limit(1).count():
            return settled
    return settled.unionByName(now.select(*KEYS, "mean", "precision"))


def quality_verdicts(docs: DataFrame, *, lang: str = "lang", source: str = "source", cutoff: float = CUTOFF,
                     min_group: int = MIN_GROUP) -> DataFrame:
    """Per row of ``docs``: the counts, ``base_failed``, ``distance`` and ``kept``.

    NULL text has no words and fails the base rule.  NULL language or source is a group of its
    own (as the text ``\\0``).  Repeated rows count as often as they occur; NULL ids are kept.  The
    estimates rest on the documents that pass the base rule.  A corpus of fewer than
    ``min_group`` such documents has no estimate, and the base rule alone decides.
    """
    stats = document_stats(docs, lang, source)
    null = F.lit("\x00")
    with batches(docs.sparkSession, BATCH_ROWS, BATCH_BYTES):
        stats = materialize(stats.withColumnsRenamed({"__0": "lang", "__1": "source"})
                            .withColumns({"lang": F.coalesce("lang", null), "source": F.coalesce("source", null)}), "stats")
    passed = stats.where(~F.col("base_failed"))
    found = materialize(robust_estimates(passed, min_group), "estimates")

    def named(level, *by):
        return found.where(F.col("level") == level).select(*by, F.col("mean").alias(f"m{level}"), F.col("precision").alias(f"p{level}"))

    every = named(0)
    out = (stats.join(named(2, "lang", "source"), ["lang", "source"], "left").join(named(1, "lang"), ["lang"], "left")
           .withColumns({c: every.select(c).scalar() for c in ("m0", "p0")}))
    mean = F.coalesce("m2", "m1", "m0")
    precision = F.coalesce("p2", "p1", "p0")
    d2 = distance(mean, precision)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      (~F.col("base_failed") & F.coalesce(d2 <= F.lit(cutoff), F.lit(True))).alias("kept"),
                      d2.alias("distance"), *FEATURES)
