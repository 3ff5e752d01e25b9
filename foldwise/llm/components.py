"""Connected components of a link table, by repeated contraction with joins and minimum aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import kept


def contract(links: DataFrame) -> DataFrame | None:
    """``links``: ``a``, ``b`` (longs). Returns ``id``, ``root``: the smallest id reachable, for every id
    that has a link to another; None if there is no such link.

    Each round points every end to its smallest neighbour, follows the pointers twice, and rewrites the
    links between the pointed-to ids; links within one id go. The work of a round is a few joins and
    aggregates with map-side combine, so a star of any size is no hot group, and every end that is not
    the smallest around it goes, so the number of rounds is logarithmic.
    """
    edges = kept(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    if edges.isEmpty():
        return None
    roots = None
    while True:
        both = edges.select(F.col("a").alias("id"), F.col("b").alias("to")).unionByName(edges.select(F.col("b").alias("id"), F.col("a").alias("to")))
        least = both.groupBy("id").agg(F.min("to").alias("to")).select("id", F.least("id", "to").alias("to"))
        step = kept(least, "least")
        twice = step.join(step.select(F.col("id").alias("to"), F.col("to").alias("root")), "to", "left").select("id", F.coalesce("root", "to").alias("root"))
        twice = kept(twice, "step")
        if roots is None:
            roots = twice
        else:
            roots = kept(roots.join(twice.select(F.col("id").alias("root"), F.col("root").alias("next")), "root", "left").select("id", F.coalesce("next", "root").alias("root")), "roots")
        for end in ("a", "b"):
            edges = edges.join(twice.select(F.col("id").alias(end), F.col("root").alias(f"{end}_root")), end).drop(end).withColumnRenamed(f"{end}_root", end)
        edges = kept(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        if edges.isEmpty():
            return roots
