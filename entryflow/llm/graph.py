"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from entryflow.llm.common import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, label``: the least node reachable, for every node in a link.

    Each round points every node at its least neighbour (or itself),
    shortens the pointers to their roots, and keeps the links between
    different roots; it ends when none is left. Links and pointers stay
    distributed and are written to the shared folder after each round. Nulls
    and self-links are ignored; an empty table has no components.
    """
    links = stage(links.select(F.col(a).alias("a"), F.col(b).alias("b"))
                  .where("a is not null and b is not null").distinct(), "links")
    nodes = links.select("a").union(links.select("b")).distinct()
    labels = nodes.select(F.col("a").alias("node"), F.col("a").alias("label"))
    links = links.where("a <> b")
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        roots = stage(both.groupBy("a").agg(F.min("b").alias("least"))
                      .select(F.col("a").alias("from"), F.least("a", "least").alias("to")), "roots")
        while True:
            step = roots.select(F.col("from").alias("to"), F.col("to").alias("next"))
            longer = roots.join(step, "to").select("from", "to", "next")
            if longer.where("`to` <> next").isEmpty():
                break
            roots = stage(longer.select("from", F.col("next").alias("to")), "roots")
        as_a = roots.select(F.col("from").alias("a"), F.col("to").alias("ra"))
        as_b = roots.select(F.col("from").alias("b"), F.col("to").alias("rb"))
        labels = stage(labels.join(roots, labels["label"] == roots["from"], "left")
                       .select("node", F.coalesce("to", "label").alias("label")), "labels")
        links = stage(links.join(as_a, "a").join(as_b, "b").where("ra <> rb")
                      .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
                      .distinct(), "links")
    return labels
