"""Column profiling (which columns are sparse, equal to another, or the concatenation of
two others) and one-pass descriptive statistics.  Each profile is a single aggregate
over the data (map-side partial aggregation); pairs and triples of columns are told apart by fingerprints
and only the few candidates left are compared row by row."""
from __future__ import annotations

from itertools import combinations, permutations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from airnet.operators._util import as_list, quoted


def profile_nulls(df: DataFrame, columns=None) -> DataFrame:
    """One row per column: ``column``, ``null_fraction`` (NULL share), ``rows``."""
    cols = as_list(columns) or df.columns
    aggs = [F.avg(quoted(c).isNull().cast("double")).alias(f"n{i}") for i, c in enumerate(cols)]
    one = df.agg(F.count(F.lit(1)).alias("rows"), *aggs)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("null_fraction"))
        for i, c in enumerate(cols)]))
    return one.select("rows", stacked.alias("p")).select("p.column", "p.null_fraction", "rows")


_INTEGRAL = ("tinyint", "smallint", "int", "bigint")
ENDS = 2   # characters whose hashes are compared at both ends


def _typed_groups(df: DataFrame, cols: list[str]) -> dict[str, list[str]]:
    groups: dict[str, list[str]] = {}
    for c in cols:
        t = df.schema[c].dataType.simpleString()
        groups.setdefault("bigint" if t in _INTEGRAL else t, []).append(c)
    return groups


def _chunked(items: list, size: int) -> list[list]:
    return [items[i:i + size] for i in range(0, len(items), size)] or [[]]


def _order_free(column):
    """A sum over the rows that does not depend on their order: of 24 bits of the hash (2^39 rows fit)."""
    return F.sum(F.xxhash64(column).bitwiseAND(F.lit((1 << 24) - 1)))


def _fingerprints(df: DataFrame, cols: list[str], texts: list[str]) -> dict[str, dict]:
    """One scan: the fingerprint of each column of ``cols``, and of ``texts`` (as strings) the NULLs, the sum and
    least of the lengths, and fingerprints of the first and last characters.  One row reaches the driver."""
    aggs, names = [F.count(F.lit(1))], [("", "rows")]
    for c in cols:
        x = quoted(c)
        x = x.cast("bigint") if df.schema[c].dataType.simpleString() in _INTEGRAL else x
        aggs += [_order_free(x), F.bit_xor(F.xxhash64(x))]
        names += [(c, "sum"), (c, "xor")]
    for c in texts:
        x = quoted(c).cast("string")
        aggs += [F.count(x), F.sum(F.length(x).cast("long")), F.min(F.length(x))]
        names += [(c, "held"), (c, "chars"), (c, "least")]
        aggs += [_order_free(F.left(x, F.lit(ENDS))), _order_free(F.right(x, F.lit(ENDS)))]
        names += [(c, "left"), (c, "right")]
    row = df.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggs)]).first()
    out: dict[str, dict] = {}
    for (c, what), value in zip(names, row):
        out.setdefault(c, {})[what] = value
    return out


def _exact(df: DataFrame, candidates: list, check, max_checks: int) -> set:
    """The candidates for which ``check`` holds on every row: one scan per ``max_checks``; few, as fingerprints chose them."""
    held = set()
    for chunk in _chunked(candidates, max_checks):
        if chunk:
            row = df.agg(*[F.every(check(x)).alias(f"e{i}") for i, x in enumerate(chunk)]).first()
            held |= {x for x, ok in zip(chunk, row) if ok}
    return held


def profile_equal_columns(df: DataFrame, columns=None, *, max_checks: int = 2000) -> DataFrame:
    """One row per pair of same-typed columns ``(column_a, column_b, equal)``;
    ``equal`` is true when the two agree (NULL-safe) on every row.  Whole numbers of any width are one type.

    One scan sums a hash of every column, whatever the rows' order; only pairs whose sums agree are
    compared row by row, in a second scan.  On a table without rows ``equal`` is NULL.
    """
    cols = as_list(columns) or df.columns
    pairs = [p for grp in _typed_groups(df, cols).values() for p in combinations(grp, 2)]
    schema = "column_a string, column_b string, equal boolean"
    if not pairs:
        return df.sparkSession.createDataFrame([], schema)
    marks = _fingerprints(df, cols, [])
    if not marks[""]["rows"]:
        return df.sparkSession.createDataFrame([(a, b, None) for a, b in pairs], schema)
    equal = _exact(df, [p for p in pairs if marks[p[0]] == marks[p[1]]],
                   lambda p: quoted(p[0]).eqNullSafe(quoted(p[1])), max_checks)
    return df.sparkSession.createDataFrame([(a, b, (a, b) in equal) for a, b in pairs], schema)


def _can_join(marks: dict, c: str, a: str, b: str, sep: str) -> bool:
    """Whether the fingerprints allow ``c == concat_ws(sep, a, b)`` on every row."""
    n, x, y, z = marks[""]["rows"], marks[c], marks[a], marks[b]
    if x["held"] < n:
        return False   # concat_ws is never NULL
    both = (max(0, y["held"] + z["held"] - n), min(y["held"], z["held"]))
    rest = x["chars"] - (y["chars"] or 0) - (z["chars"] or 0)
    if not both[0] * len(sep) <= rest <= both[1] * len(sep):
        return False
    return not any(part["held"] == n and part["least"] >= ENDS and part[end] != x[end]
                   for part, end in ((y, "left"), (z, "right")))


def profile_concat_columns(df: DataFrame, columns=None, sep: str = "", *, max_checks: int = 2000,
                           numbers: bool = False, only_true: bool = False) -> DataFrame:
    """One row per ordered column triple ``(column, part_a, part_b, is_concat)``:
    ``is_concat`` when ``column == concat_ws(sep, part_a, part_b)`` on every row.  With ``numbers``
    numeric columns, read as text, take part beside the string columns.

    One scan gives each column's lengths and the fingerprints of its first and last characters; only
    triples that these allow are compared row by row, in a second scan.  ``only_true`` leaves out
    the triples that do not hold.  On a table without rows ``is_concat`` is NULL.
    """
    cols = [c for c in (as_list(columns) or df.columns) if df.schema[c].dataType.simpleString() == "string"
            or numbers and isinstance(df.schema[c].dataType, NumericType)]
    triples = [(c, a, b) for c in cols for a, b in permutations([x for x in cols if x != c], 2)]
    schema = "column string, part_a string, part_b string, is_concat boolean"
    if not triples:
        return df.sparkSession.createDataFrame([], schema)
    marks = _fingerprints(df, [], cols)
    if not marks[""]["rows"]:
        return df.sparkSession.createDataFrame([] if only_true else [(*t, None) for t in triples], schema)
    text = {c: quoted(c).cast("string") for c in cols}
    found = _exact(df, [t for t in triples if _can_join(marks, *t, sep)],
                   lambda t: text[t[0]].eqNullSafe(F.concat_ws(sep, text[t[1]], text[t[2]])), max_checks)
    return df.sparkSession.createDataFrame([(*t, t in found) for t in triples if t in found or not only_true], schema)


def describe_columns(df: DataFrame, columns) -> DataFrame:
    """avg / min / max of several columns in ONE aggregate (one scan, one row):
    ``<col>_avg``, ``<col>_min``, ``<col>_max``."""
    aggs = []
    for c in as_list(columns):
        aggs += [F.avg(c).alias(f"{c}_avg"), F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.agg(*aggs)


def distinct_values(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Distinct non-NULL values of one column."""
    return df.select(F.col(col).alias(out or col)).where(F.col(out or col).isNotNull()).distinct()


def bounded_keys(df: DataFrame, col: str, n: int = 20) -> list:
    """At most ``n`` distinct non-NULL values of ``col``, smallest first (deterministic).

    The only driver collect of the library besides header promotion: bounded by ``n``.
    """
    rows = distinct_values(df, col).orderBy(col).limit(n).collect()
    return [r[0] for r in rows]
