"""Connected components by randomised contraction.

Each round every node adopts the neighbour (or itself) that comes first in a
fresh pseudo-random order, then what that one adopted, and the edges are
rewritten to the adopted nodes. A constant share of the nodes goes in each round
in expectation, so rounds grow with the logarithm of the graph and not with its
diameter (Boegeholz, Brand, Todor: "In-database connected component analysis",
2020). The adoption maps are then composed from the last to the first; their
sizes shrink geometrically.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.skew import HOT_ROWS, hot_keys, repeat_rows, spread_rows
from plumbline.session import spool


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """`(node, component)` for every node.

    `nodes` has `node`; `edges` has `src, dst`, each pair in either direction.
    The component id is one of its nodes.
    """
    both = edges.select("src", "dst").union(edges.select("dst", "src"))
    both = spool(both.filter("src != dst").distinct(), "edges")
    maps = []
    while total := both.count():
        # A text seed is passed to the generated code as an object, so every round runs the same compiled classes.
        seed = F.lit(f"round {len(maps)}")
        order, own = F.xxhash64(seed, F.col("dst")), F.xxhash64(seed, F.col("src"))
        best = F.min(F.struct(order.alias("o"), F.col("dst").alias("n")))
        chosen = both.groupBy("src").agg(best.alias("b"), F.count("*").alias("degree"))
        chosen = chosen.select(
            F.col("src").alias("node"),
            F.when(F.col("b.o") < own, F.col("b.n")).otherwise(F.col("src")).alias("rep"),
            "degree",
        )
        hot = None
        if total > HOT_ROWS:
            chosen = spool(chosen, "adopted")
            hot = hot_keys(chosen, ["node"], total, chosen.agg(F.max("degree")).first()[0], "degree")
        chosen = _adopt_twice(chosen.drop("degree"), hot)
        maps.append(chosen)
        both = spool(_contract(both, chosen, hot), "edges")
    if not maps:
        return nodes.select("node", F.col("node").alias("component"))
    final = maps.pop()
    while maps:
        step = maps.pop()
        later = final.select(F.col("node").alias("rep"), F.col("rep").alias("_later"))
        final = step.join(later, "rep", "left").select("node", F.coalesce("_later", "rep").alias("rep"))
    return nodes.join(final, "node", "left").select("node", F.coalesce("rep", "node").alias("component"))


def _adopt_twice(chosen: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Each node with the node adopted by the one it adopted: two rounds' progress in one."""
    spread = None if hot is None else hot.withColumnRenamed("node", "rep")
    second = chosen.select(F.col("node").alias("rep"), F.col("rep").alias("_next"))
    pairs = spread_rows(chosen, spread, ["rep"], "node").join(repeat_rows(second, spread, ["rep"]), ["rep", "_salt"])
    return pairs.select("node", F.col("_next").alias("rep"))


def _contract(both: DataFrame, chosen: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Edges between the adopted nodes.

    A node that many others adopted can own a large share of the edges; its
    edges are spread before they meet its one map row. The edges are symmetric,
    so the same spread serves both ends.
    """
    out = both
    for end, other in (("dst", "src"), ("src", "dst")):
        spread = None if hot is None else hot.withColumnRenamed("node", end)
        lookup = repeat_rows(chosen.withColumnRenamed("node", end), spread, [end])
        out = spread_rows(out, spread, [end], other).join(lookup, [end, "_salt"])
        out = out.select(F.col("rep").alias(end), other)
    return out.filter("src != dst").select("src", "dst").distinct()
