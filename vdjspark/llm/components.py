"""Connected components of an edge table, by stars and pointer jumping; no edge leaves the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vdjspark.runtime import drop_staged, small, stage


def _with_top(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """edges (a, b) with ``top``, the least b of the least b of each a; and the staged minima, to be deleted when that has been used.

    Minima are aggregated before the shuffle. They are broadcast if few; else they are joined, and a
    node with very many neighbours is split as a skewed join.
    """
    least = stage(edges.groupBy("a").agg(F.min("b").alias("low")), "least")
    side = small(least)
    found = edges.alias("e").join(side.alias("l"), F.col("e.a") == F.col("l.a")).join(side.alias("f"), F.col("l.low") == F.col("f.a"), "left")
    return found.select("e.a", "e.b", F.coalesce("f.low", "l.low").alias("top")), least


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b: long) -> node, root: for every node of an edge, the least node it is connected with.

    Each round hangs every node and its smaller neighbours on the least neighbour of its least
    neighbour, which halves the way to the least node. It ends when every edge leads there already, so
    that the edges are stars. A round is two written tables, the minima and the new edges. Nodes with
    edges to themselves only are their own root.
    """
    edges = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    now, first = edges.filter("a != b"), True
    while True:
        topped, least = _with_top(now)
        if not topped.filter("b != top").limit(1).count():
            drop_staged(least)
            break
        pairs = F.array(F.struct("a", F.col("top").alias("b")), F.struct(F.col("b").alias("a"), F.col("top").alias("b")))
        after = stage(topped.select(F.explode(pairs).alias("e")).select("e.a", "e.b").filter("a != b").distinct(), "edges")
        for done in (least, *([] if first else [now])):
            drop_staged(done)
        now, first = after, False
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for more in (now, edges):
        nodes = nodes.unionByName(more.select(F.col("b").alias("node"), F.col("b").alias("root")))
    return nodes.groupBy("node").agg(F.min("root").alias("root"))
