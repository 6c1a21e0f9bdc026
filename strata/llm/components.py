"""Connected components by repeated contraction, with every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored


def _rank(name: str) -> Column:
    """A hash-random order of nodes: along any chain a constant share of nodes contracts per round."""
    return F.struct(F.xxhash64(name).alias("hash"), F.col(name).alias("node"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); equal roots mean connected.

    Each round points every node at the first node among itself and its neighbours, in a random order
    that is the same in all tasks, and replaces both ends of every link by what they point at. Links that
    have become loops or repeats vanish, so rounds shrink fast and a chain of n links needs about log n of
    them. A busy node is reduced by partial aggregation; joins on it can be split by adaptive execution.
    """
    links = stored(_plain(links), "links")
    rounds = []
    while not links.isEmpty():
        ends = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = ends.groupBy("a").agg(F.min(_rank("b")).alias("first"))
        parents = first.select(
            F.col("a").alias("node"), F.least(F.col("first"), _rank("a"))["node"].alias("parent")
        )
        parents = stored(parents, "parents")
        rounds.append(parents)
        pa, pb = (parents.select(F.col("node").alias(c), F.col("parent").alias(f"p{c}")) for c in "ab")
        moved = links.join(pa, "a").join(pb, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b"))
        links = stored(_plain(moved), "links")
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = rounds[-1].withColumnRenamed("parent", "root")
    for parents in reversed(rounds[:-1]):
        above = roots.withColumnRenamed("node", "parent")
        roots = parents.join(above, "parent", "left").select("node", F.coalesce("root", "parent").alias("root"))
        roots = stored(roots, "roots")
    return roots


def _plain(links: DataFrame) -> DataFrame:
    """Every link between different nodes once."""
    ordered = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ordered.distinct()
