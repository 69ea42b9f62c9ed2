"""Attaching a one-row-per-key table to a large one."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is frequent when it has more than this share of the rows, so there are fewer frequent keys than its inverse.
FREQUENT_SHARE = 200
_TRACKED = 10_000


def frequent_keys(df: DataFrame, on: list[str]) -> Column:
    """Hashes of the keys that hold more than a FREQUENT_SHARE-th of the rows, as a scalar array.

    They come from a frequent-items sketch of fixed size, merged over the tasks; a key that the sketch
    misses or counts too high only takes the other way of two that give the same rows.
    """
    counted = df.select(F.xxhash64(*on).alias("k")).agg(
        F.expr(f"approx_top_k(k, {FREQUENT_SHARE}, {_TRACKED})").alias("top"), F.count(F.lit(1)).alias("n"))
    often = F.filter("top", lambda t: t["count"] * FREQUENT_SHARE > F.col("n"))
    return counted.select(F.transform(often, lambda t: t["item"])).scalar()


def lookup_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left join to `right`, which has one row per key; its columns come after those of `left`.

    Rows with a frequent key stay where they are, as the few rows of `right` that they need are sent to
    every task. Only the others are shuffled, and no key among them is frequent. The plan is the same
    whatever the size of either side. `right` is read by both branches and should be a staged table.
    """
    frequent = F.array_contains(frequent_keys(left, on), F.xxhash64(*on))
    few = F.broadcast(right.where(frequent))
    return left.where(frequent).join(few, on, "left") \
        .unionByName(left.where(~frequent).join(right.where(~frequent), on, "left"))
