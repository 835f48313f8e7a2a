"""Connected components by DataFrame joins, for graphs that no machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapdeck.llm.common import materialise


def _jump(parents: DataFrame) -> DataFrame:
    """Follow parents to the root: p becomes the parent of p until nothing changes."""
    while True:
        up = parents.select(F.col("node").alias("p"), F.col("p").alias("pp"))
        moved = materialise(parents.join(up, "p", "left").select("node", F.coalesce("pp", "p").alias("new"), "p"), "cc-jump")
        parents = moved.select("node", F.col("new").alias("p"))
        if moved.filter("new <> p").isEmpty():
            return parents


def connected_components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (a, b); comp is the smallest node of the component.

    Each round every node hooks onto its smallest neighbour if that is smaller, chains are followed to
    their roots, and the links are rewritten between roots; links inside one tree vanish.  Nodes that still have a link
    have a smaller neighbour or are one, so the number of live roots falls by a factor each round.
    All tables are written out, so joins are between plain scans and AQE splits a hub.
    """
    edges = materialise(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-links")
    both = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    labels = materialise(both.select("node", F.col("node").alias("comp")), "cc-nodes")
    while not edges.isEmpty():
        seen = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("near")))
        hooks = seen.groupBy("node").agg(F.min("near").alias("near")).select("node", F.least("node", "near").alias("p"))
        roots = _jump(materialise(hooks, "cc-hooks"))
        up = roots.select(F.col("node").alias("comp"), F.col("p"))
        labels = materialise(labels.join(up, "comp", "left").select("node", F.coalesce("p", "comp").alias("comp")), "cc-labels")
        ra, rb = roots.select(F.col("node").alias("a"), F.col("p").alias("pa")), roots.select(F.col("node").alias("b"), F.col("p").alias("pb"))
        edges = edges.join(ra, "a").join(rb, "b").filter("pa <> pb")
        edges = materialise(edges.select(F.greatest("pa", "pb").alias("a"), F.least("pa", "pb").alias("b")).distinct(), "cc-links")
    return labels
