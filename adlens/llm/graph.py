"""Connected components of an edge list, by contraction along scrambled ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import dropped, stored

JUMPS = 3     # pointer doublings within a round: paths of 2**JUMPS steps are walked at once
TASK_ROWS = 1 << 17   # narrow rows of a round that are worth a task


def scrambled(node: Column) -> Column:
    """A one-to-one map of long ids that keeps nothing of their order (three Feistel rounds of 32-bit halves)."""
    low = F.lit(0xFFFFFFFF)
    left, right = F.shiftrightunsigned(node, 32), node.bitwiseAND(low)
    for k in range(3):
        left, right = right, left.bitwiseXOR(F.hash(right, F.lit(k)).cast("long").bitwiseAND(low))
    return F.shiftleft(left, 32).bitwiseOR(right)


def _written(df: DataFrame, name: str, rows: int) -> DataFrame:
    """``df`` stored by as many tasks as ``rows`` (a bound on its own) are worth: a round writes six small frames, and
    hundreds of near-empty tasks and files for each would take far longer than its work."""
    return stored(df.coalesce(rows // TASK_ROWS + 1), name)


def components(edges: DataFrame, kept: bool = False) -> DataFrame:
    """(node, component): the smallest node reachable, for nodes that have an edge.

    ``edges``: long columns u, v (``kept``: of a stored table, which is read as it is). A round points every node to the smallest scrambled id among
    itself and its neighbours, follows the pointers ``2**JUMPS`` steps, and contracts the graph
    along them. In scrambled order few nodes of a chain are smaller than both
    neighbours, however its ids run, so the number of rounds grows with the logarithm of the
    graph's size. Each node's stand is carried along, written every round (the lineage ends there), so no
    plan grows with the rounds. A hot node costs one aggregated row a task; no group is collected. Tasks
    follow the number of edges left, whatever the shuffle partitions.
    """
    pairs = edges.filter("u <> v").select("u", "v")
    pairs = pairs if kept else stored(pairs, "pairs")   # read twice, computed once
    links = pairs.count()
    named = _written(pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
                   .select("node", scrambled(F.col("node")).alias("at")), "nodes", 2 * links)
    low, high = F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")
    graph = _written(pairs.select(scrambled(F.col("u")).alias("a"), scrambled(F.col("v")).alias("b")).select(low, high).distinct(), "edges", links)
    if not kept:
        dropped(pairs)
    while left_over := graph.count():
        both = graph.unionByName(graph.select(F.col("v").alias("u"), F.col("u").alias("v")))
        to = _written(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "map", 2 * left_over)
        for _ in range(JUMPS):
            further = to.select(F.col("u").alias("m"), F.col("m").alias("next"))
            old, to = to, _written(to.join(further, "m").select("u", F.col("next").alias("m")), "map", 2 * left_over)
            dropped(old)
        left, right = to.select("u", F.col("m").alias("a")), to.select(F.col("u").alias("v"), F.col("m").alias("b"))
        old = graph
        graph = _written(graph.join(left, "u").join(right, "v").filter("a <> b").select(low, high).distinct(), "edges", left_over)
        dropped(old)
        old = named
        named = _written(named.join(to.select(F.col("u").alias("at"), "m"), "at", "left")
                         .select("node", F.coalesce("m", "at").alias("at")), "nodes", 2 * links)
        dropped(old)
        dropped(to)
    least = named.groupBy("at").agg(F.min("node").alias("component"))
    out = _written(named.join(least, "at").select("node", "component"), "components", 2 * links)
    dropped(named)
    return out
