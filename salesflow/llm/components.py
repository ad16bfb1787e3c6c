"""Connected components of an edge table, on tables only.

Random-priority contraction: in each round every node points to the node of
lowest hashed priority in its closed neighbourhood, edges are redrawn between
the targets, and what became a loop goes.  The expected number of nodes falls
by a constant factor a round, so chains end in O(log n) rounds; a star ends in
one or two.  Each round is one aggregation (combined on the map side, so a hub
is harmless) and two joins of written tables, whose skewed partitions Spark
splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm._shared import shared_table


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node that has an edge; ``component`` is
    the smallest node reachable.

    Loops and edges with a null end are ignored; repeated edges and both
    directions are allowed.  An edge table without edges gives no rows.
    """
    e = shared_table(
        edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"),
                     F.col(a).isNotNull().alias("x"), F.col(b).isNotNull().alias("y"))
        .where("x and y and a <> b").select("a", "b").distinct(), "edges")
    labels = None
    turn = 0
    while not e.isEmpty():
        ends = e.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            e.select(F.col("b").alias("node"), F.col("a").alias("other")))
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("h"), F.col(c).alias("id"))
        target = (ends.groupBy("node").agg(F.min(rank("other")).alias("m"))
                  .select("node", F.least("m", rank("node"))["id"].alias("target")))
        target = shared_table(target, f"targets-{turn}")
        ta = target.select(F.col("node").alias("a"), F.col("target").alias("ta"))
        tb = target.select(F.col("node").alias("b"), F.col("target").alias("tb"))
        e = shared_table(
            e.join(ta, "a").join(tb, "b").where("ta <> tb")
            .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(),
            f"edges-{turn}")
        if labels is None:
            labels = target
        else:
            step = target.select(F.col("node").alias("target"), F.col("target").alias("next"))
            labels = labels.join(step, "target", "left").select(
                "node", F.coalesce("next", "target").alias("target"))
        turn += 1
    if labels is None:
        kind = e.schema["a"].dataType
        return e.select(F.col("a").cast(kind).alias("node"), F.col("b").cast(kind).alias("component"))
    labels = shared_table(labels, "labels")
    least = shared_table(labels.groupBy("target").agg(F.min("node").alias("component")), "least")
    return labels.join(least, "target").select("node", "component")
