"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id``, ``component``: for every id in a link the smallest id it is connected to.

    Each round every vertex points to its smallest neighbour if that is smaller, pointers are
    followed to their roots by doubling, and the links are rewritten between roots; links
    inside a root vanish. A hub's neighbours are combined per task before the shuffle. Every step
    is written below the shared folder, so a lost executor repeats that step only.
    """
    edges = links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct()
    edges = materialize(edges, "cc-edges")
    labels = None
    while not edges.isEmpty():
        ends = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).unionAll(edges.select("b", "a"))
        parent = materialize(ends.groupBy("v").agg(F.min("u").alias("u")).select("v", F.least("v", "u").alias("p")), "cc-parents")
        while True:
            up = parent.select(F.col("v").alias("p"), F.col("p").alias("q"))
            higher = materialize(parent.join(up, "p").select("v", F.col("q").alias("p"), (F.col("q") != F.col("p")).alias("moved")), "cc-parents")
            parent = higher.select("v", "p")
            if higher.where("moved").isEmpty():
                break
        if labels is None:
            labels = parent.select(F.col("v").alias("id"), F.col("p").alias("component"))
        else:
            step = parent.select(F.col("v").alias("component"), F.col("p").alias("root"))
            labels = labels.join(step, "component", "left").select("id", F.coalesce("root", "component").alias("component"))
            labels = materialize(labels, "cc-labels")
        roots_a, roots_b = parent.toDF("a", "ra"), parent.toDF("b", "rb")
        edges = edges.join(roots_a, "a").join(roots_b, "b").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
        edges = materialize(edges.where("a < b").distinct(), "cc-edges")
    if labels is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return labels
