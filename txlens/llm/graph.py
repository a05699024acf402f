"""Connected components of a distributed edge list by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialize


def components(edges: DataFrame, a: str = "a", b: str = "b", labels: DataFrame | None = None) -> DataFrame:
    """(node, label) for every node with an edge; label is the smallest node of its component.

    Each round points every node to its smallest neighbour (or itself) and replaces edges by those
    between the nodes pointed to, without loops and repeats. The smallest node of a component points
    to itself and so is what a component shrinks to; every other node's pointer chain ends there.
    At least half of the nodes that still have edges vanish in a round, so rounds grow with the
    logarithm of the longest chain; all steps are joins and aggregates with map-side combining.

    ``labels`` of earlier edges, if given, are gone on from: only what the new ``edges`` join is
    contracted.
    """
    kind = edges.schema[a].dataType
    rest = edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
    new = None
    if labels is not None:
        known = labels.count()
        new = materialize(
            rest.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(labels, "node", "left_anti").select("node", F.col("node").alias("label")),
            "components-new",
        )
        named = broadcast_if_small(labels, known)
        u, v = (named.select(F.col("node").alias(n), F.col("label").alias(f"p{n}")) for n in ("u", "v"))
        pu, pv = F.coalesce("pu", "u"), F.coalesce("pv", "v")
        rest = rest.join(u, "u", "left").join(v, "v", "left").select(F.least(pu, pv).alias("u"), F.greatest(pu, pv).alias("v"))
        labels = labels.unionByName(new)
    rest = materialize(rest.where("u != v").distinct(), "components-edges")
    n = rest.count()
    while n:
        both = rest.select("u", "v").unionByName(rest.select(F.col("v").alias("u"), F.col("u").alias("v")))
        points = materialize(
            both.groupBy("u").agg(F.min("v").alias("least")).select(F.col("u").alias("node"), F.least("u", "least").alias("to")), "components-points", 2 * n
        )
        nodes = points.count()
        if labels is None:
            labels = points.select("node", F.col("to").alias("label"))
        else:
            moved = broadcast_if_small(points.select(F.col("node").alias("label"), "to"), nodes)
            labels = labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
            labels = materialize(labels, "components-labels")
        u = broadcast_if_small(points.select(F.col("node").alias("u"), F.col("to").alias("pu")), nodes)
        v = broadcast_if_small(points.select(F.col("node").alias("v"), F.col("to").alias("pv")), nodes)
        rest = materialize(
            rest.join(u, "u").join(v, "v").where("pu != pv").select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct(),
            "components-edges", n,
        )
        n = rest.count()
    if labels is None:
        return rest.select(F.col("u").cast(kind).alias("node"), F.col("u").cast(kind).alias("label"))
    return labels
