"""Styling of graph snapshots and their text rendering as DOT (GraphViz) lines.

Text is produced as rows in parallel; :func:`write_dot` writes one ordered text output
per iteration (part files concatenate, in name order, into a valid DOT file)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airnet.functions.columns import hex_gradient, line_color, minmax_clamped
from airnet.operators.graph import with_bounds
from airnet.operators.sequence import position_in_key

# ---- fixed values: DOT layout of the rendered graph ----------------------------------------
DOT_NODE_FMT = '  %s [label="%s", fillcolor="%s"];'
DOT_EDGE_FMT = '  %s -- %s [color="%s", label="%s"];'
DOT_HEADER = [
    "graph metro {",
    "  graph [overlap=false, layout=sfdp, fontsize=20, label=\"%s\", labelloc=\"t\", size=\"20,20\", dpi=300];",
    "  node  [shape=circle, fontsize=8, style=filled, width=0.2, height=0.2];",
    "  edge  [penwidth=1];",
]
DOT_FOOTER = "}"
# ----------------------------------------------------------------------------------------------


def minmax_scale(snaps: DataFrame, *, value: str = "value", iter_col: str = "iter",
                 out: str = "scaled") -> DataFrame:
    """Value scaled to [0, 1] between its iteration's positive min and max (clamped;
    0 when min == max or when the iteration has no positive value)."""
    b = with_bounds(snaps, value=value, iter_col=iter_col)
    return b.withColumn(out, minmax_clamped(value, "min_pos", "max_pos")).drop("min_pos", "max_pos")


def node_colors(snaps: DataFrame, *, value: str = "value", iter_col: str = "iter",
                out: str = "color") -> DataFrame:
    """Green-to-red fill colour per vertex and iteration; ``#DDDDDD`` for values <= 0."""
    b = with_bounds(snaps, value=value, iter_col=iter_col)
    return b.withColumn(out, hex_gradient(value, "min_pos", "max_pos")).drop("min_pos", "max_pos")


def edge_colors(edges: DataFrame, line: str = "line", out: str = "color") -> DataFrame:
    """Palette colour of each edge from its line label."""
    return edges.withColumn(out, line_color(F.col(line).cast("string")))


def dot_node_lines(nodes: DataFrame, *, id_col: str, label: str, color: str = "color",
                   out: str = "line") -> DataFrame:
    """``  <id> [label="<label>", fillcolor="<color>"];`` (double quotes in labels -> ')."""
    lab = F.translate(F.col(label).cast("string"), '"', "'")
    return nodes.withColumn(out, F.format_string(DOT_NODE_FMT, F.col(id_col).cast("string"), lab, F.col(color)))


def dot_edge_lines(edges: DataFrame, *, src: str = "src", dst: str = "dst", line: str = "line",
                   color: str = "color", out: str = "line_text") -> DataFrame:
    """``  <src> -- <dst> [color="<color>", label="<line>"];``"""
    return edges.withColumn(out, F.format_string(DOT_EDGE_FMT, F.col(src).cast("string"),
                                                 F.col(dst).cast("string"), F.col(color),
                                                 F.col(line).cast("string")))


def dot_document(node_lines: DataFrame, edge_lines: DataFrame, title: str, *,
                 node_text: str = "line", edge_text: str = "line_text", node_key: str = "vertex_id",
                 edge_key=("src", "dst", "line")) -> DataFrame:
    """All lines of one DOT file as rows ``(section, k1, k2, k3, value)``; sorting by the
    first four columns gives the file order (header, nodes, edges, footer)."""
    spark = node_lines.sparkSession
    head = [(0, i, "", "", (h % title) if "%s" in h else h) for i, h in enumerate(DOT_HEADER)]
    hdr = spark.createDataFrame(head + [(3, 0, "", "", DOT_FOOTER)],
                                "section int, k1 long, k2 string, k3 string, value string")
    ek = list(edge_key)
    nodes = node_lines.select(F.lit(1).alias("section"), F.col(node_key).cast("long").alias("k1"),
                              F.lit("").alias("k2"), F.lit("").alias("k3"), F.col(node_text).alias("value"))
    edges = edge_lines.select(F.lit(2).alias("section"), F.col(ek[0]).cast("long").alias("k1"),
                              F.col(ek[1]).cast("string").alias("k2"), F.col(ek[2]).cast("string").alias("k3"),
                              F.col(edge_text).alias("value"))
    return hdr.unionByName(nodes).unionByName(edges)


def dot_documents(node_lines: DataFrame, edge_lines: DataFrame, iterations: list[int], title: str = "iteration %s", *,
                  iter_col: str = "iter", node_text: str = "line", edge_text: str = "line_text",
                  node_key: str = "vertex_id", edge_key=("src", "dst", "line")) -> DataFrame:
    """The DOT documents of several iterations as rows ``(iter, line_no, value)``, ``line_no`` from 0: header,
    nodes by id, edges by their two ids and label, footer.

    The line numbers are a distributed prefix sum, so no document passes through one task. The edges are the same lines in
    every document: they are sorted and written once and copied to the iterations when they are read.
    ``title`` takes the iteration.
    """
    spark = node_lines.sparkSession
    iterations = list(dict.fromkeys(int(i) for i in iterations))
    its = spark.createDataFrame([(i,) for i in iterations], f"{iter_col} int")
    nodes = (node_lines.where(F.col(iter_col).isin(iterations))
             .select(F.col(iter_col).cast("int").alias(iter_col), F.col(node_key).cast("long").alias("k1"), F.col(node_text).alias("value")))
    nodes, _ = position_in_key(nodes, [iter_col], ["k1"], n_keys=len(iterations), keep_order=False)
    a, b, c = edge_key
    edges = edge_lines.where(F.lit(bool(iterations))).select(
        F.col(a).cast("long").alias("k1"), F.col(b).cast("long").alias("k2"), F.col(c).cast("string").alias("k3"), F.col(edge_text).alias("value"))
    edges, _ = position_in_key(edges, [], ["k1", "k2", "k3"], n_keys=1, keep_order=False)
    # one row per iteration: where its edges and its footer stand
    text = [F.format_string(h, F.format_string(title, F.col(iter_col))) if "%s" in h else F.lit(h) for h in DOT_HEADER]
    n_nodes = nodes.groupBy(iter_col).agg(F.count(F.lit(1)).alias("n"))
    frame = (its.join(F.broadcast(n_nodes), iter_col, "left").crossJoin(F.broadcast(edges.agg(F.count(F.lit(1)).alias("edges"))))
             .select(iter_col, "edges", (F.lit(len(text)) + F.coalesce("n", F.lit(0))).alias("start")))
    fixed = F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("line_no"), t.alias("value")) for i, t in enumerate(text)],
                              F.struct((F.col("start") + F.col("edges")).alias("line_no"), F.lit(DOT_FOOTER).alias("value"))))
    return (frame.select(iter_col, fixed.alias("f")).select(iter_col, "f.line_no", "f.value")
            .unionByName(nodes.select(iter_col, (F.lit(len(text)) + F.col("__idx")).alias("line_no"), "value"))
            .unionByName(edges.crossJoin(F.broadcast(frame.select(iter_col, "start")))
                         .select(iter_col, (F.col("start") + F.col("__idx")).alias("line_no"), "value")))


def write_dots(docs: DataFrame, path: str, *, iter_col: str = "iter", partitions: int | None = None) -> None:
    """Write the documents of :func:`dot_documents`, one folder ``iter=<k>`` each; its part files, in name order,
    are the document (global range sort, no single task)."""
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (docs.repartitionByRange(n, iter_col, "line_no").sortWithinPartitions(iter_col, "line_no").select(iter_col, "value")
         .write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
         .partitionBy(iter_col).text(path))  # nothing but the documents' folders


def write_dot(doc: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write a DOT document as ordered text part files (global range sort, no single task)."""
    keys = ["section", "k1", "k2", "k3"]
    n = partitions or int(doc.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (doc.repartitionByRange(n, *keys).sortWithinPartitions(*keys).select("value")
        .write.mode("overwrite").text(path))
