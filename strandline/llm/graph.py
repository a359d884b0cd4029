"""Connected components of a link table, without ever gathering links in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(a long, b long) links -> (node long, root long): equal roots, and only those, are connected.

    Every round each node hooks to the neighbour (or itself) of least hashed rank, and links are
    carried over to the parents; what became one node leaves the table. The order is fixed, so stars
    end in two rounds, and hashed, so chains shrink by a constant factor: the number of rounds grows
    with the logarithm of the number of nodes. A hot node is reduced before the shuffle by min().
    Self links and null ends are ignored; nodes without a link do not appear.
    """
    links = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = materialise(links, f"{label}-links")
    parents: list[DataFrame] = []
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
        best = both.groupBy("a").agg(F.min(rank("b")).alias("best"))
        parent = best.select(F.col("a").alias("node"), F.least(rank("a"), F.col("best"))["v"].alias("parent"))
        parent = materialise(parent, f"{label}-parents")
        parents.append(parent)
        of = lambda side: parent.select(F.col("node").alias(side), F.col("parent").alias(f"p{side}"))
        moved = links.join(of("a"), "a").join(of("b"), "b").where("pa <> pb")
        moved = moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        used, links = links, materialise(moved, f"{label}-links")
        discard(used)
    if not parents:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = parents[0].select("node", F.col("parent").alias("root"))
    for parent in parents[1:]:
        step = parent.select(F.col("node").alias("root"), F.col("parent").alias("next"))
        found = found.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    found = materialise(found, f"{label}-found")
    discard(links, *parents)
    return found
