"""Connected components over links that may be too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskrisk.llm.workspace import Workspace


def components(edges: DataFrame, work: Workspace, name: str = "components") -> DataFrame:
    """``node``, ``root``: the smallest node of its component, for every node that has a link.

    ``edges`` has two comparable columns ``a`` and ``b``. Large-star and small-star steps
    alternate until nothing changes: each moves links to the smallest neighbour, so that the
    number of rounds grows with the logarithm of the nodes, not with the length of chains.
    Every step finds the smallest neighbour by an aggregate (combined before the shuffle) and
    joins it back, so a node with very many links is never gathered in one place.
    """
    now = _oriented(edges)
    round_, before = 0, None
    while True:
        stored = work.store(_small_star(_large_star(now)), f"{name}-{round_}")
        # The links are those of before if their number and the sum of their hashes are.
        state = stored.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if round_:
            work.drop(f"{name}-{round_ - 1}")
        if state == before:
            break
        now, before, round_ = stored, state, round_ + 1
    stars = stored.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root")).distinct()


def _oriented(edges: DataFrame) -> DataFrame:
    """Each link once, from the larger node to the smaller."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour (or itself)."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()
