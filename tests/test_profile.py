"""Column profiles by fingerprints against row-by-row comparison."""
import random
from itertools import combinations, permutations

from pyspark.sql import functions as F

from airnet.operators import profile, reshape


def _wide(spark, n=300, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, x = rng.choice(["", "ab", "abc", "é", None]), rng.choice(["x", "yy", "中文"]), rng.randint(0, 9)
        shuffled = rng.choice(["x", "yy"])
        rows.append((a, b, x, x, f"{x}{b}", None if a is None else a + b, f"{x}-{b}", shuffled, float(x), (i * 7) % n, i, "k"))
    schema = ("a string, b string, n int, n2 bigint, nb string, ab string, n_b string, s string, d double, p1 int, p2 int, `we``ird.name` string")
    return spark.createDataFrame(rows, schema), rows


def test_equal_columns(spark):
    df, rows = _wide(spark)
    got = {(r["column_a"], r["column_b"]): r["equal"] for r in profile.profile_equal_columns(df).collect()}
    at = {c: i for i, c in enumerate(df.columns)}
    assert got[("n", "n2")] is True and got[("p1", "p2")] is False   # the same values in another order
    for (a, b), equal in got.items():
        assert equal == all(r[at[a]] == r[at[b]] for r in rows), (a, b)


def test_concatenations_with_numbers_and_separator(spark):
    df, rows = _wide(spark)
    at = {c: i for i, c in enumerate(df.columns)}
    cols = ["a", "b", "n", "n2", "nb", "ab", "n_b", "s", "p1"]
    for sep in ("", "-"):
        got = {(r["column"], r["part_a"], r["part_b"]): r["is_concat"]
               for r in profile.profile_concat_columns(df, cols, sep, numbers=True).collect()}
        text = lambda r, c: None if r[at[c]] is None else str(r[at[c]])
        for c in cols:
            for a, b in permutations([x for x in cols if x != c], 2):
                want = all(text(r, c) == sep.join(v for v in (text(r, a), text(r, b)) if v is not None) for r in rows)
                assert got[(c, a, b)] == want, (c, a, b, sep)
        assert got[("nb", "n", "b")] == (sep == "") and got[("n_b", "n2", "b")] == (sep == "-")
    some = profile.profile_concat_columns(df, cols, "-", numbers=True, only_true=True).collect()
    assert {(r["column"], r["part_a"]) for r in some} == {("n_b", "n"), ("n_b", "n2")}


def test_few_candidates_are_left_of_fifty_columns(spark):
    df = spark.range(500).select(*[((F.col("id") * (i + 3)) % 211).cast("string").alias(f"c{i}") for i in range(49)], F.concat_ws(
        "_", ((F.col("id") * 3) % 211).cast("string"), ((F.col("id") * 4) % 211).cast("string")).alias("made"))
    marks = profile._fingerprints(df, df.columns, df.columns)
    left = [t for c in df.columns for t in ((c, a, b) for a, b in permutations([x for x in df.columns if x != c], 2))
            if profile._can_join(marks, *t, "_")]
    assert ("made", "c0", "c1") in left and len(left) < 120
    same = [p for p in combinations(df.columns, 2) if all(marks[p[0]][k] == marks[p[1]][k] for k in ("sum", "xor"))]
    assert len(same) < 20


def test_no_rows(spark):
    df, _ = _wide(spark)
    assert {r["equal"] for r in profile.profile_equal_columns(df.limit(0)).collect()} == {None}
    assert {r["is_concat"] for r in profile.profile_concat_columns(df.limit(0)).collect()} == {None}


def test_the_kept_duplicate_does_not_depend_on_partitions(spark):
    rows = [(i % 5, None if i % 7 == 0 else i, f"t{i}") for i in range(100)]
    df = spark.createDataFrame(rows, "k long, v long, `t.x` string")
    got = [sorted(map(str, reshape.drop_dups(df.repartition(n), ["k"], order=["v"]).collect())) for n in (1, 6)]
    assert got[0] == got[1] and len(got[0]) == 5
    assert reshape.drop_dups(df, ["k"], order=["v"]).columns == ["k", "v", "t.x"]
    nulls = spark.createDataFrame([(None, 2), (None, 1)], "k long, v long")
    assert [tuple(r) for r in reshape.drop_dups(nulls, "k").collect()] == [(None, 1)]
