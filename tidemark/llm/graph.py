"""Connected components of a graph given as a table of edges, by alternating large-star and small-star steps.

Each step is an aggregation and a join over the edges; their number stays below the first one's and falls to one a node.
Nothing is gathered on the driver but counts. A graph of few edges, counted, has its tables of minima sent to all tasks,
so that a node of very many edges is no one task's; in a larger one such a node is a skewed side of a sort-merge join,
which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import drop_table, materialise


def components(edges: DataFrame, max_rounds: int = 60, broadcast_edges: int = 30_000) -> DataFrame:
    """(node, root) of every node that has an edge: root is the smallest node of its component. edges: (a, b), of any
    type with an order; loops, nulls and repetitions are left out. An empty table gives an empty result."""

    def told(e: DataFrame) -> tuple:
        """The number of edges and what tells one set of edges from another."""
        h = F.xxhash64("a", "b")
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(h % 1_000_003)).first())

    e = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "edges")
    now = told(e)
    for _ in range(max_rounds):
        if not now[0]:
            break
        sent = F.broadcast if now[0] <= broadcast_edges else lambda d: d
        # large star: a node's larger neighbours go to the smallest of its neighbourhood
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = e.select(F.col("b").alias("a"), F.col("a").alias("b")).join(sent(low), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: a node and its smaller neighbours go to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(sent(low), "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = materialise(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
        drop_table(e)
        e, before, now = new, now, told(new)
        if now == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
