"""Binned counts; every bin is reported, also the empty ones."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _with_empty_bins(counts: DataFrame, labels: DataFrame) -> DataFrame:
    # labels has one row per bin, a fixed number.
    return (labels.join(F.broadcast(counts), "orden", "left")
            .withColumn("n", F.coalesce("n", F.lit(0).cast("long"))))


def fixed_bins(df: DataFrame, column: str, edges: list[int]) -> DataFrame:
    """orden, intervalo, n for right-closed bins (low, high]; values outside belong to none."""
    return labelled_bins(df.select(F.col(column).alias("v"), F.lit(1).cast("long").alias("n")), edges)


def labelled_bins(values: DataFrame, edges: list[int]) -> DataFrame:
    """As fixed_bins, from v and n, the rows that hold v."""
    spans = list(zip(edges[:-1], edges[1:]))
    bin_of: Column | None = None
    for i, (low, high) in enumerate(spans):
        inside = (F.col("v") > low) & (F.col("v") <= high)
        bin_of = F.when(inside, i) if bin_of is None else bin_of.when(inside, i)
    counts = (values.select(bin_of.cast("long").alias("orden"), "n").dropna()
              .groupBy("orden").agg(F.sum("n").alias("n")))
    labels = values.sparkSession.createDataFrame(
        [(i, f"({low}, {high}]") for i, (low, high) in enumerate(spans)],
        "orden long, intervalo string")
    return _with_empty_bins(counts, labels)


def equal_width_bins(df: DataFrame, value: Column, bins: int) -> DataFrame:
    """orden, desde, n for `bins` equal bins between minimum and maximum (the last one closed)."""
    return bin_counts(df.select(value.cast("double").alias("v"), F.lit(1).cast("long").alias("n")).dropna(), bins)


def bin_counts(values: DataFrame, bins: int) -> DataFrame:
    """As equal_width_bins, from v and n, the rows that hold v."""
    ends = values.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
    placed = values.select("v", "n", ends.alias("ends")).select("v", "n", "ends.lo", "ends.hi")
    index = F.when(F.col("hi") == F.col("lo"), 0).otherwise(
        F.least(F.width_bucket("v", "lo", "hi", F.lit(bins)) - 1, F.lit(bins - 1)))
    counts = (placed.select(index.cast("long").alias("orden"), "n")
              .groupBy("orden").agg(F.sum("n").alias("n")))
    span = values.sparkSession.range(bins).select(F.col("id").alias("orden"), ends.alias("ends"))
    width = (F.col("ends.hi") - F.col("ends.lo")) / bins
    labels = span.select("orden", (F.col("ends.lo") + width * F.col("orden")).alias("desde"))
    return _with_empty_bins(counts, labels)
