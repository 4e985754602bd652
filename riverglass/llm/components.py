"""Connected components by contraction: every vertex hooks to its smallest neighbour, and edges join what they hooked to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, materialize


def components(edges: DataFrame) -> DataFrame:
    """(key, root) of every vertex in edges (a, b); the root is the same in a component and is one of its vertices.

    Each round is a few joins of tables in the shared folder, in which a vertex of any degree is safe; vertices that
    something hooks to are all that is left, so rounds are few. Nothing but a count reaches the driver.
    """
    pair = F.array_sort(F.array("a", "b"))
    edges = materialize(edges.where("a <> b").select(pair[0].alias("a"), pair[1].alias("b")).distinct(), "edges")
    roots = None
    while (total := edges.count()) or roots is None:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        hooks = both.groupBy("u").agg(F.min("v").alias("v"), F.count("*").alias("degree"))
        hooks = materialize(hooks.select("u", F.least("u", "v").alias("p"), "degree"), "hooks")
        if roots is None:
            roots = hooks.select(F.col("u").alias("key"), F.col("p").alias("root"))
        else:
            step = hooks.select(F.col("u").alias("root"), F.col("p").alias("next"))
            sizes = roots.groupBy("root").agg(F.count("*").alias("size"))
            moved = join_groups(roots, sizes.join(step, "root"), ["root"], "size", roots.count())
            roots = moved.select("key", F.coalesce("next", "root").alias("root"))
        roots = materialize(roots, "roots")
        for side in ("a", "b"):
            found = hooks.select(F.col("u").alias(side), F.col("p").alias(f"p{side}"), F.col("degree").alias(f"degree_{side}"))
            edges = join_groups(edges, found, [side], f"degree_{side}", 2 * total)
        pair = F.array_sort(F.array("pa", "pb"))
        edges = materialize(edges.where("pa <> pb").select(pair[0].alias("a"), pair[1].alias("b")).distinct(), "edges")
    return roots
