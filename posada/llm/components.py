"""Connected components of a table of links, by alternating large and small stars.

Each round replaces links by links to smaller neighbours; minima are aggregated before they are shuffled, and rounds are
written to the shared folder, so that no lineage grows and no link passes through the driver. The number of rounds grows
with the logarithm of the longest path.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posada.staging import Stage

ROUNDS = 60


def _mark(links: DataFrame) -> tuple:
    """A fingerprint of a set of links: two numbers."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to its smallest one."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, are linked to the smallest of them. Links run from a to a smaller b."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    rest = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, held: Stage, name: str) -> DataFrame:
    """(id, component) for every id that has a link; component is the smallest id that can be reached.
    links: columns a and b; loops, repeats and rows with null are passed over."""
    now = held.put(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                   f"{name}-0")
    before = _mark(now)
    for i in range(1, ROUNDS):
        now = held.put(_small_star(_large_star(now)), f"{name}-{i}")
        after = _mark(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")) \
        .union(now.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()
