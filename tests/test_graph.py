import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from airnet.functions.columns import EDGE_PALETTE
from airnet.operators import graph, reshape, sequence, style

# invented network: a shared station, parallel edges, a branch, a non-numeric line,
# a quoted name and the same name written with a hyphen and an en dash
LINES = [
    ("1", ["A", "B", "C", "D"]),
    ("2", ["E", "B", "F"]),
    ("3", ["A", "B", "A", "B"]),        # B-A twice more: parallel edges
    ("3_a", ["C", 'Gare "Nord"']),
    ("3bis", ["Champs-Elysees", "F"]),
    ("7", ["Champs–Elysees", "D"]),
    ("9", ["Solo"]),                     # one-stop line: vertex without edge
]


@pytest.fixture()
def net(spark):
    df = spark.createDataFrame(LINES, "line string, stops array<string>")
    stops = reshape.lines_to_stops(df, "line", "stops")
    edges = sequence.sequence_edges(stops, "line", ["stop_seq"], "station")
    return stops, edges


def test_edges_multigraph(net):
    stops, edges = net
    e = sorted((r["src"], r["dst"], r["line"]) for r in edges.collect())
    assert len(e) == 3 + 2 + 3 + 1 + 1 + 1
    assert e.count(("A", "B", "3")) == 2 and e.count(("B", "A", "3")) == 1
    v = {r["name"] for r in graph.stops_vertices(stops, "station").collect()}
    assert "Solo" in v and len(v) == 10
    vn = {r["name"] for r in graph.graph_vertices(edges, normalize=True).collect()}
    assert "Champs–Elysees" not in vn and "Champs-Elysees" in vn


def test_blocked_edges_equal_plain(spark):
    rows = [("L", i, f"s{i % 37}") for i in range(500)] + [("M", i, f"s{i}") for i in range(5)]
    stops = spark.createDataFrame(rows, "line string, seq int, station string")
    plain = sequence.sequence_edges(stops, "line", ["seq"], "station")
    blocked = sequence.sequence_edges(stops, "line", ["seq"], "station",
                                      block_rows=7)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, blocked.collect()))


def test_dense_ids_consecutive(spark):
    v = spark.createDataFrame([(f"n{i:04d}",) for i in range(1000)], "name string")
    ids = graph.dense_ids(v, partitions=7).collect()
    assert sorted(r["vertex_id"] for r in ids) == list(range(1000))
    assert all(r["name"] == f"n{r['vertex_id']:04d}" for r in ids)


def _matrix_diffusion(names, edge_pairs, p0, alpha, steps):
    idx = {n: i for i, n in enumerate(names)}
    a = np.zeros((len(names), len(names)))
    for s, d in edge_pairs:
        a[idx[d], idx[s]] += 1
        a[idx[s], idx[d]] += 1
    p = np.array([p0[n] for n in names], dtype=float)
    for _ in range(steps):
        p = p + alpha * a @ p
    return dict(zip(names, p))


def test_diffusion_matches_matrix_form(spark, net):
    stops, edges = net
    verts = graph.stops_vertices(stops, "station")
    scores = spark.createDataFrame([("A", 1.0), ("F", 3.0), ("Nowhere", 2.0)], "station string, score double")
    seeded = graph.seed_vertices(verts, scores)
    obs = {r["name"]: (r["value"], r["observed"]) for r in seeded.collect()}
    assert obs["A"] == (1.0, True) and obs["B"] == (0.0, False) and "Nowhere" not in obs
    counts = graph.mapped_counts(verts, scores).collect()[0]
    assert (counts["scored"], counts["mapped"]) == (3, 2)
    out = graph.diffuse(seeded.select("name", "value"), edges, alpha=0.1, steps=5, checkpoint_every=2)
    got = {r["name"]: r["value"] for r in out.collect()}
    pairs = [(r["src"], r["dst"]) for r in edges.collect()]
    exp = _matrix_diffusion(sorted(obs), pairs, {k: v[0] for k, v in obs.items()}, 0.1, 5)
    for k in exp:
        assert got[k] == pytest.approx(exp[k], rel=1e-12)
    snaps = graph.diffuse(seeded.select("name", "value"), edges, alpha=0.1, steps=5, snapshots=True)
    assert sorted({r["iter"] for r in snaps.collect()}) == list(range(6))


def test_diffusion_identity_and_linearity(spark, net):
    stops, edges = net
    verts = graph.stops_vertices(stops, "station")
    s1 = graph.seed_vertices(verts, spark.createDataFrame([("A", 1.0)], "station string, score double"))
    s2 = graph.seed_vertices(verts, spark.createDataFrame([("D", 2.0)], "station string, score double"))
    s12 = graph.seed_vertices(verts, spark.createDataFrame([("A", 1.0), ("D", 2.0)], "station string, score double"))
    ident = {r["name"]: r["value"] for r in graph.diffuse(s1.select("name", "value"), edges, 0.0, 3).collect()}
    assert ident == {r["name"]: r["value"] for r in s1.collect()}
    run = lambda s: {r["name"]: r["value"] for r in graph.diffuse(s.select("name", "value"), edges, 0.2, 3).collect()}
    a, b, ab = run(s1), run(s2), run(s12)
    for k in ab:
        assert ab[k] == pytest.approx(a[k] + b[k], rel=1e-12)


def test_colors(spark):
    df = spark.createDataFrame([("1",), ("3_a",), ("3bis",), ("0",), ("21",), ("20",), ("",), (None,)], "line string")
    got = [r["color"] for r in style.edge_colors(df).collect()]
    assert got == [EDGE_PALETTE[0], EDGE_PALETTE[2], "#000000", "#000000", EDGE_PALETTE[0], EDGE_PALETTE[19],
                   "#000000", "#000000"]
    snaps = spark.createDataFrame([("a", 0, 0.0), ("b", 0, 1.0), ("c", 0, 3.0), ("d", 0, 2.0), ("e", 1, 5.0)],
                                  "name string, iter int, value double")
    col = {r["name"]: r["color"] for r in style.node_colors(snaps).collect()}
    assert col == {"a": "#DDDDDD", "b": "#00ff00", "c": "#ff0000", "d": "#7f7f00", "e": "#00ff00"}
    sc = {r["name"]: r["scaled"] for r in style.minmax_scale(snaps).collect()}
    assert sc["d"] == 0.5 and sc["e"] == 0.0
    b = {r["iter"]: (r["min_pos"], r["max_pos"]) for r in graph.snapshot_bounds(
        snaps.union(spark.createDataFrame([("z", 2, 0.0)], snaps.schema))).collect()}
    assert b[0] == (1.0, 3.0) and b[2] == (None, None)


def test_dot_document(spark, net, tmp_dir):
    stops, edges = net
    verts = graph.stops_vertices(stops, "station")
    ids = graph.dense_ids(verts)
    snaps = graph.seed_vertices(verts, spark.createDataFrame([("A", 1.0)], "station string, score double"))
    nodes = style.node_colors(snaps.withColumn("iter", F.lit(0))).join(ids, "name")
    nl = style.dot_node_lines(nodes, id_col="vertex_id", label="name")
    e = style.edge_colors(edges)
    e = (e.join(ids.select(F.col("name").alias("src"), F.col("vertex_id").alias("s")), "src")
          .join(ids.select(F.col("name").alias("dst"), F.col("vertex_id").alias("d")), "dst"))
    el = style.dot_edge_lines(e, src="s", dst="d")
    texts = [r["line"] for r in nl.collect()]
    assert any("label=\"Gare 'Nord'\"" in t for t in texts)
    doc = style.dot_document(nl, el.select(F.col("s").alias("src"), F.col("d").alias("dst"), "line", "line_text"),
                             "iteration 0")
    out = os.path.join(tmp_dir, "dot")
    style.write_dot(doc, out, partitions=3)
    parts = sorted(p for p in os.listdir(out) if p.startswith("part-"))
    lines = []
    for p in parts:
        with open(os.path.join(out, p)) as f:
            lines += f.read().splitlines()
    assert lines[0] == "graph metro {" and lines[-1] == "}"
    assert sum(" -- " in x for x in lines) == edges.count()
    assert sum("fillcolor" in x for x in lines) == verts.count()
    first_edge = next(i for i, x in enumerate(lines) if " -- " in x)
    assert all("fillcolor" not in x for x in lines[first_edge:])


def test_salted_hub_diffusion_matches_matrix(spark):
    # a star: hub H linked to 40 leaves, plus a chain; hot_degree=5 forces salting of H
    pairs = [("H", f"L{i}") for i in range(40)] + [("L0", "L1"), ("L1", "L2"), ("H", "H")]
    edges = spark.createDataFrame(pairs, "src string, dst string")
    names = sorted({x for p in pairs for x in p})
    p0 = {n: float(i % 5) for i, n in enumerate(names)}
    state = spark.createDataFrame(list(p0.items()), "name string, value double")
    exp = _matrix_diffusion(names, pairs, p0, 0.05, 3)
    for kw in ({"hot_degree": 5, "salts": 4},   # hub salted
               {"checkpoint_every": 0},          # states written at the end only
               {}):
        got = {r["name"]: r["value"] for r in graph.diffuse(state, edges, 0.05, 3, **kw).collect()}
        for k in exp:
            assert got[k] == pytest.approx(exp[k], rel=1e-12)
    w, hubs = graph.partitioned_weights(graph.symmetric_weights(edges), partitions=8, hot_degree=5, salts=4)
    assert [r["src"] for r in hubs.collect()] == ["H"]
    assert w.where(F.col("src") == "H").select("salt").distinct().count() > 1
    w2, none = graph.partitioned_weights(graph.symmetric_weights(edges), partitions=8, hot_degree=1000, salts=4)
    assert none is None and "salt" not in w2.columns


def test_dot_documents_have_a_line_order(spark, net, tmp_dir):
    stops, edges = net
    ids = graph.dense_ids(graph.stops_vertices(stops, "station"))
    seeded = graph.seed_vertices(graph.stops_vertices(stops, "station"), spark.createDataFrame([("A", 1.0)], "station string, score double"))
    snaps = graph.diffuse(seeded.select("name", "value"), edges, 0.1, 2, snapshots=True)
    nodes = style.dot_node_lines(style.node_colors(snaps).join(ids, "name"), id_col="vertex_id", label="name")
    e = style.edge_colors(edges)
    e = (e.join(ids.select(F.col("name").alias("src"), F.col("vertex_id").alias("s")), "src")
          .join(ids.select(F.col("name").alias("dst"), F.col("vertex_id").alias("d")), "dst"))
    el = style.dot_edge_lines(e, src="s", dst="d").select(F.col("s").alias("src"), F.col("d").alias("dst"), "line", "line_text")
    docs = style.dot_documents(nodes, el, [0, 2], "step %s")
    n = 5 + ids.count() + edges.count()
    got = {}
    for r in docs.collect():
        got.setdefault(r["iter"], {})[r["line_no"]] = r["value"]
    assert set(got) == {0, 2}
    for it, doc in got.items():
        assert sorted(doc) == list(range(n)) and doc[0] == "graph metro {" and doc[n - 1] == "}" and f'"step {it}"' in doc[1]
        assert [int(doc[i].split()[0]) for i in range(4, 4 + ids.count())] == list(range(ids.count()))
        pairs = [tuple(map(int, doc[i].split(" [")[0].split(" -- "))) for i in range(4 + ids.count(), n - 1)]
        assert pairs == sorted(pairs)
    style.write_dots(docs, os.path.join(tmp_dir, "dots"), partitions=3)
    for it, doc in got.items():
        folder = os.path.join(tmp_dir, "dots", f"iter={it}")
        text = "".join(open(os.path.join(folder, p)).read() for p in sorted(os.listdir(folder)) if p.startswith("part-"))
        assert text.splitlines() == [doc[i] for i in range(n)]
    assert style.dot_documents(nodes, el, []).count() == 0


def test_dot_documents_sort_the_edges_once(spark, monkeypatch):
    """Whatever the number of documents; repeated edges, ids without a value, an iteration without nodes."""
    from airnet.operators import sequence
    placed = []
    plain = sequence.sorted_places
    monkeypatch.setattr(sequence, "sorted_places", lambda *a, **b: placed.append(plain(*a, **b)) or placed[-1])
    nodes = spark.createDataFrame([(i, v, f"node {i} {v}") for i in (0, 1, 3) for v in range(2 + i)] + [(1, None, "node none")],
                                  "iter int, vertex_id long, line string")
    pairs = [(2, 1, "b"), (0, 1, "10"), (0, 1, "9"), (2, 1, "b"), (0, 1, None), (None, 0, "a")]
    edges = spark.createDataFrame([(*p, "edge {} {} {}".format(*p)) for p in pairs], "src long, dst long, line string, line_text string")
    docs = style.dot_documents(nodes, edges, [0, 1, 2], "step %s")
    assert docs.columns == ["iter", "line_no", "value"]
    assert sum(p.count() for p in placed) == 6 + len(pairs)   # nodes of iterations 0 and 1, each edge once
    ends = ["edge None 0 a", "edge 0 1 None", "edge 0 1 10", "edge 0 1 9", "edge 2 1 b", "edge 2 1 b", "}"]
    got = {i: {} for i in range(3)}
    for r in docs.collect():
        assert r["line_no"] not in got[r["iter"]]
        got[r["iter"]][r["line_no"]] = r["value"]
    for i, own in enumerate([["node 0 0", "node 0 1"], ["node none", "node 1 0", "node 1 1", "node 1 2"], []]):
        doc = [got[i].get(k) for k in range(len(got[i]))]
        assert doc[0] == "graph metro {" and f'"step {i}"' in doc[1] and doc[4:] == own + ends


def test_shuffle_files_go_with_the_write(spark):
    """What is written once leaves no shuffle files behind, and the session's setting stays."""
    from airnet import session
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        every = found.getAllFiles()
        return {n for n in (every.apply(i).getName() for i in range(every.size())) if n.startswith("shuffle_") and n.endswith(".data")}

    before, kept = files(), spark.conf.get(session._FREE_SHUFFLES)
    df = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).agg(F.sum("id").alias("n"))
    out = session.materialize(df)
    assert sorted(r["n"] for r in out.collect()) == [sum(range(i, 1000, 10)) for i in range(10)]
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(session._FREE_SHUFFLES) == kept
