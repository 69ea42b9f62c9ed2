"""Places of rows in an order, without any window over more than the partitions of one group."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from posada.staging import Stage

#: monotonically_increasing_id() holds the number of the partition above these bits.
_BITS = 33


def numbered(df: DataFrame, held: Stage, name: str, group: list[str], order: list) -> DataFrame:
    """df with `place` (from 0, by order inside its group) and `total` (rows of the group). Groups are never null.

    Rows are dealt to ranges of group and order, sorted there and written with a running number, so a group that holds
    most of the table is spread over many ranges. How many rows of a group lie in earlier ranges comes from one small row
    for each group and range. Rows that are equal in group and order get places in any order, but each its own.
    """
    sorted_rows = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order) \
        .withColumn("__at", F.monotonically_increasing_id())
    rows = held.put(sorted_rows, name).withColumn("__range", F.shiftright("__at", _BITS))
    ranges = rows.groupBy(*group, "__range").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    inside = W.partitionBy(*group)
    placed = ranges.withColumns({
        "total": F.sum("__n").over(inside),
        "__before": F.sum("__n").over(inside.orderBy("__range").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("__n")})
    return rows.join(placed.drop("__n"), [*group, "__range"]) \
        .withColumn("place", F.col("__at") - F.col("__first") + F.col("__before")) \
        .drop("__at", "__range", "__first", "__before")
