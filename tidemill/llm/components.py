"""Connected components of a table of links: smallest label reached, by hooking and pointer jumping on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.session import stage


def components(links: DataFrame) -> DataFrame:
    """For every a or b of ``links`` (columns a, b of one ordered type): node and label, the smallest node connected with it.

    Links are contracted round by round: each root hooks to the smallest root that a link joins it to, the hooks
    are followed by pointer jumping, and links inside a component go. The number of roots with links at least
    halves in a round. Null ends and links of a node with itself are ignored.
    """
    both = links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = stage(both, "links")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = stage(nodes.select("node", F.col("node").alias("label")), "labels")
    while not edges.isEmpty():
        two_way = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Every root points to the smallest of itself and its neighbours, so pointers only go down.
        hooks = stage(two_way.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("up")), "hooks")
        while True:
            jumped = hooks.alias("x").join(hooks.alias("y"), F.col("x.up") == F.col("y.a")).select(F.col("x.a").alias("a"), F.col("y.up").alias("up"), (F.col("x.up") != F.col("y.up")).alias("moved"))
            jumped = stage(jumped, "hooks")
            hooks = jumped.select("a", "up")
            if jumped.filter("moved").isEmpty():
                break
        labels = stage(labels.join(hooks, F.col("label") == F.col("a"), "left").select("node", F.coalesce("up", "label").alias("label")), "labels")
        to = lambda end, out: hooks.select(F.col("a").alias(end), F.col("up").alias(out))
        moved = edges.join(to("a", "x"), "a").join(to("b", "y"), "b").filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        edges = stage(moved, "links")
    return labels
