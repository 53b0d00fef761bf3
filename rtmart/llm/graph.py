"""Connected components by alternating large-star and small-star steps.

Only edges are kept as state. Each step hangs a node's neighbours under the
smallest of them; after O(log^2 n) steps every component is one star. The
minimum per node is a map-side combined aggregate and the join back on a hub
is an ordinary equi-join, which adaptive execution splits, so a hub is never
gathered in one task. State is written to the shared folder after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rtmart.operators.lineage import cut_lineage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(neighbours: DataFrame, larger_only: bool) -> DataFrame:
    least = (neighbours.groupBy("u").agg(F.min("v").alias("m"))
             .select("u", F.least("u", "m").alias("m")))
    hung = neighbours.join(least, "u")
    if larger_only:
        hung = hung.where(F.col("v") > F.col("u"))
    out = hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not larger_only:
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; the root is the smallest node.

    ``edges`` has columns u, v of one orderable type; direction, repeats and
    loops do not matter. No edges give no rows.
    """
    state = cut_lineage(
        edges.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "components")
    seen = None
    while True:
        large = cut_lineage(_star(_both_ways(state), True), "components")
        small = _star(large, False)
        state = cut_lineage(small, "components")
        mark = state.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                         F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    return (state.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("root"))
                         .distinct()))
