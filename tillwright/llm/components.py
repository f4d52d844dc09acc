"""Connected components of links, by labels that shrink along links and jump to their label's label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import discard, stored


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for every node of ``links`` (long columns a, b).

    Each round takes the smallest label among a node's neighbours, pre-aggregated per node, then the
    label of that label. So the distance to the smallest node halves in each round. Every round's
    labels are written to the shared folder. Nulls and self-links are ignored.
    """
    known = links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    edges = stored(known.union(known.select("b", "a")).distinct(), "edges")
    first = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_b"))
    labels = stored(first.select("node", F.least("node", "_b").alias("component")), "labels")
    while True:
        of_b = labels.select(F.col("node").alias("b"), "component")
        near = edges.join(of_b, "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("_near"))
        met = labels.join(near, "node").select("node", F.col("component").alias("_old"), F.least("component", "_near").alias("_new"))
        met = stored(met, "labels")
        target = met.select(F.col("node").alias("_new"), F.col("_new").alias("_next"))
        jumped = stored(met.join(target, "_new").select("node", F.col("_next").alias("component"), (F.col("_next") != F.col("_old")).alias("_moved")), "labels")
        moved = not jumped.filter("_moved").isEmpty()
        discard(labels, met)
        jumped_at, labels = jumped.stored_at, jumped.select("node", "component")
        labels.stored_at = jumped_at
        if not moved:
            discard(edges)
            return labels
