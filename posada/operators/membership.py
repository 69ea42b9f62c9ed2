"""Referential checks between a child and its parent table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _key_sizes(child: DataFrame, key: str) -> DataFrame:
    # One row per key before any join: the frequent keys of the child cannot skew it.
    return child.groupBy(key).agg(F.count(F.lit(1)).alias("filas"))


def orphan_keys(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """key, filas: keys of the child that the parent lacks; a null key is an orphan."""
    ids = parent.select(F.col(parent_key).alias(key)).distinct()
    return _key_sizes(child, key).join(ids, key, "left_anti")


def matched_keys(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """key, filas: keys of the child that the parent has."""
    ids = parent.select(F.col(parent_key).alias(key)).distinct()
    return _key_sizes(child, key).join(ids, key, "left_semi")


def row_total(sizes: DataFrame, name: str) -> DataFrame:
    return sizes.agg(F.coalesce(F.sum("filas"), F.lit(0)).alias(name))
