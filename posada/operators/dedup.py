"""Duplicates by natural key and by whole row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _nulls_last(order_by) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by]


def keep_first(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """One row per key: the first by order_by, by default by every other column.

    "Rank 1 of a partition" is planned with a group limit in front of the shuffle, so every map task
    sends at most one row per key: a key that holds most of the table does not end in one task.
    Null keys are equal to each other. The hash in front of the keys settles almost every comparison
    of the sort without looking at the row.
    """
    order = _nulls_last(order_by or [c for c in df.columns if c not in keys] or keys)
    return _first(df, [F.xxhash64(*keys), *keys], order)


def first_of_ranges(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key of a table that is already in ranges of the leading keys; the rows come in the order of the keys.

    No row is dropped before the exchange that made the ranges: a key that holds most of the table is sorted by one
    task, which spills.
    """
    return _first(df, keys, _nulls_last(order_by or keys))


def _first(df: DataFrame, partition: list, order: list[Column]) -> DataFrame:
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*partition).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def duplicate_count(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier key (or, without keys, an earlier whole row)."""
    sizes = df.groupBy(*(keys or df.columns)).agg(F.count(F.lit(1)).alias("_size"))
    return sizes.agg(F.coalesce(F.sum(F.col("_size") - 1), F.lit(0)).alias("duplicados"))
