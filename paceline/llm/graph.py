"""Connected components by contraction, in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.llm.common import files_for, materialize, spread_join


def components(edges: DataFrame) -> DataFrame:
    """v, component for every vertex of edges (a, b): component is the least vertex that v is connected to.

    Each round every vertex hooks on to its least neighbour, pointer jumping finds the roots, and the edges between roots
    are the next round's graph; a component with an edge loses at least half of its vertices in a round. A hub's edges are
    pre-aggregated, and joins deal its rows over several tasks. Edges are counted, so that small tables are a file each. Nothing but
    counts goes to the driver. Without edges the
    result is empty; repeated edges count once."""
    edges = edges.where(F.col("a") != F.col("b")).select("a", "b")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels, files = None, files_for(2 * edges.count())
    while True:
        hooks = both.groupBy("a").agg(F.min("b").alias("p")).select(F.col("a").alias("v"), F.least("a", "p").alias("root"))
        roots = materialize(hooks, "hooks", files)
        while True:
            up = roots.select(F.col("v").alias("root"), F.col("root").alias("up"))
            jumped = spread_join(roots, up, "root").select("v", F.col("up").alias("root"), (F.col("up") != F.col("root")).alias("moved"))
            jumped = materialize(jumped, "roots", files)
            moved = jumped.where("moved").limit(1).count()
            roots = jumped.select("v", "root")
            if not moved:
                break
        if labels is None:
            labels = roots.select("v", F.col("root").alias("component"))
        else:
            step = roots.select(F.col("v").alias("component"), "root")
            labels = materialize(spread_join(labels, step, "component", "left").select("v", F.coalesce("root", "component").alias("component")), "labels", files)
        ra, rb = roots.select(F.col("v").alias("a"), F.col("root").alias("ra")), roots.select(F.col("v").alias("b"), F.col("root").alias("rb"))
        ends = spread_join(spread_join(both, ra, "a"), rb, "b")
        both = materialize(ends.where(F.col("ra") != F.col("rb")).select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "contracted", files)
        if not both.limit(1).count():
            return labels
