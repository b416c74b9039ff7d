"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written


def components(edges: DataFrame, a: str = "a", b: str = "b", label: str = "root") -> DataFrame:
    """``(node, root)`` for every node of ``edges``; ``root`` is a node of its component.

    Each round hooks every vertex to its smallest neighbour, flattens those
    chains by pointer jumping, and contracts the graph to the roots, until no
    edge is left (a path takes one round, a star two at most).  Every step is
    a partial aggregate or an equi-join and is written to the shared folder;
    no component is ever gathered in one place.  Self-loops and repeated
    edges are allowed, empty edges give an empty result."""
    live = written(edges.select(F.least(a, b).alias("x"), F.greatest(a, b).alias("y"))
                   .filter("x < y").distinct(), "edges")
    found = None
    while not live.isEmpty():
        both = live.select("x", "y").union(live.select(F.col("y").alias("x"), F.col("x").alias("y")))
        hook = both.groupBy("x").agg(F.min("y").alias("m")) \
            .select(F.col("x").alias("node"), F.least("x", "m").alias("root"))
        hook = written(hook, "hook")
        while True:                      # pointer jumping
            up = hook.select(F.col("node").alias("root"), F.col("root").alias("up"))
            jumped = written(hook.join(up, "root").select("node", F.col("up").alias("root"),
                                                          (F.col("up") != F.col("root")).alias("moved")), "jump")
            hook = jumped.select("node", "root")
            if jumped.filter("moved").isEmpty():
                break
        if found is None:
            found = hook
        else:
            top = hook.select(F.col("node").alias("root"), F.col("root").alias("up"))
            found = written(found.join(top, "root", "left")
                            .select("node", F.coalesce("up", "root").alias("root")), "roots")
        left = hook.select(F.col("node").alias("x"), F.col("root").alias("rx"))
        right = hook.select(F.col("node").alias("y"), F.col("root").alias("ry"))
        live = written(live.join(left, "x").join(right, "y")
                       .select(F.least("rx", "ry").alias("x"), F.greatest("rx", "ry").alias("y"))
                       .filter("x < y").distinct(), "edges")
    if found is None:
        found = live.select(F.col("x").alias("node"), F.col("y").alias("root"))
    return found.withColumnRenamed("root", label)
