"""Connected components by contraction, in DataFrame operations with written tables between the rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.session import drop_scratch, scratch_table


def components(edges: DataFrame) -> DataFrame:
    """node, root for each end of edges (a, b: long), where root is the least node of the component.

    A round points each node at its least neighbour or itself, follows the pointers four steps, and replaces each
    edge by the edge between the ends' targets. A path shrinks at least fourfold in a round, a star vanishes
    in two. Neighbour lists are never gathered: a round is a grouped minimum and joins on node ids.
    """
    edges = scratch_table(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "cc-edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    roots = scratch_table(nodes.select("node", F.col("node").alias("root")), "cc-roots")
    while edges.limit(1).count():
        both = edges.union(edges.select("b", "a"))
        to = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("to"))
        for _ in range(2):
            on = to.select(F.col("node").alias("mid"), F.col("to").alias("next"))
            to = to.join(on, F.col("to") == F.col("mid")).select("node", F.col("next").alias("to"))
        to = scratch_table(to, "cc-pointers")
        a, b = to.select(F.col("node").alias("a"), F.col("to").alias("ta")), to.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        met = edges.join(a, "a").join(b, "b").filter("ta <> tb")
        rest = scratch_table(met.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "cc-edges")
        moved = roots.join(to.withColumnRenamed("node", "at"), F.col("root") == F.col("at"), "left")
        new_roots = scratch_table(moved.select("node", F.coalesce("to", "root").alias("root")), "cc-roots")
        for old in (edges, to, roots):
            drop_scratch(old)
        edges, roots = rest, new_roots
    drop_scratch(edges)
    return roots
