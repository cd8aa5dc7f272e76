"""Connected components of an edge table by random contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.llm.common import stored


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); two nodes share a root iff they are connected.

    Each round gives every node the neighbour, or itself, of the smallest keyed hash and
    replaces both ends of each edge by their choice. A round leaves an expected constant
    fraction of the nodes, whatever the shape of the graph, so a path of n nodes takes
    about log n rounds and a star one. Only minima are gathered per node, combined before
    the shuffle, so a hub costs no more than its edges. Each round is a written table;
    nothing but one "is it empty" answer a round reaches the driver.

    Loops, repeated edges and edges with a null end are ignored.
    """
    ends = "least(a, b) AS a", "greatest(a, b) AS b"
    left = stored(edges.where("a <> b").selectExpr(*ends).distinct(), f"{label}-edges-0")
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        k = len(rounds)
        both = left.unionByName(left.selectExpr("b AS a", "a AS b"))
        smallest = both.groupBy("a").agg(F.min(F.struct(F.xxhash64(F.lit(k), "b").alias("h"), "b")).alias("best"))
        choice = stored(
            smallest.select(
                F.col("a").alias("node"),
                F.when(F.col("best.h") < F.xxhash64(F.lit(k), "a"), F.col("best.b")).otherwise(F.col("a")).alias("root"),
            ),
            f"{label}-round-{k}",
        )
        rounds.append(choice)
        contracted = (
            left.join(choice.selectExpr("node AS a", "root AS root_a"), "a")
            .join(choice.selectExpr("node AS b", "root AS root_b"), "b")
            .selectExpr("root_a AS a", "root_b AS b")
        )
        left = stored(contracted.where("a <> b").selectExpr(*ends).distinct(), f"{label}-edges-{k + 1}")
    if not rounds:
        return left.selectExpr("a AS node", "b AS root")
    result = rounds[0]
    for choice in rounds[1:]:
        onward = choice.selectExpr("node AS root", "root AS _next")
        result = result.join(onward, "root", "left").selectExpr("node", "ifnull(_next, root) AS root")
    return result
