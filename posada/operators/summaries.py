"""Numeric and text summaries."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posada.functions.flags import certainly
from posada.operators.outliers import fences
from posada.operators.quantiles import exact_quantiles, quantile_scalar


def describe_numeric(df: DataFrame, columns: list[str],
                     probs: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """columna, count, mean, std, min, max and one p.. column per probability."""
    # All columns in one pass; the result has one row per column.
    moments = df.agg(*[F.struct(
        F.lit(c).alias("columna"), F.count(c).alias("count"), F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"), F.min(F.col(c).cast("double")).alias("min"),
        F.max(F.col(c).cast("double")).alias("max")).alias(c) for c in columns])
    rows = moments.select(F.inline(F.array(*columns)))
    quantiles = exact_quantiles(df, columns, list(probs)).select(
        "columna", *[F.col("q")[i].alias(f"p{p * 100:g}") for i, p in enumerate(probs)])
    return rows.join(quantiles, "columna", "left")


def describe_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """columna, count, unique, top (smallest text among equals), freq."""
    entries = F.array(*[F.struct(F.lit(c).alias("columna"), F.col(c).cast("string").alias("v"))
                        for c in columns])
    sizes = (df.select(F.inline(entries)).where(F.col("v").isNotNull())
             .groupBy("columna", "v").agg(F.count(F.lit(1)).alias("n")))
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("v")))
    return sizes.groupBy("columna").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        best.getField("v").alias("top"), F.max("n").alias("freq"))


def percentile_list(df: DataFrame, column: str, probs: list[float]) -> DataFrame:
    """One row per probability."""
    rows = exact_quantiles(df, [column], probs)
    pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("prob"),
                         F.col("q").alias("valor"))
    return rows.select(F.inline(pairs)).toDF("prob", "valor")


def price_metrics(df: DataFrame, column: str) -> DataFrame:
    """Median, mean, quartiles, p99, maximum, upper fence, counts above it and above 10 million."""
    q = quantile_scalar(df, column, [0.25, 0.5, 0.75, 0.99])
    priced = df.select(F.col(column).alias("v"), q.alias("q"))
    q1, q3 = F.col("q")[0], F.col("q")[2]
    limit = fences(q1, q3)[1]
    return priced.agg(
        F.max(F.col("q")[1]).alias("mediana"), F.avg("v").alias("media"),
        F.max(q1).alias("q1"), F.max(q3).alias("q3"), F.max(F.col("q")[3]).alias("p99"),
        F.max("v").alias("max"), F.max(limit).alias("limite_iqr"),
        F.count_if(certainly(F.col("v") > limit)).alias("atipicos_iqr"),
        F.count_if(certainly(F.col("v") > 1e7)).alias("mayor_10M"),
        F.count_if(F.col("v").isNull()).alias("sin_precio"))


def group_medians(df: DataFrame, column: str, by: str, min_count: int = 0) -> DataFrame:
    """by, n, mediana for groups with at least min_count values; n counts values, not rows."""
    return (exact_quantiles(df, [column], [0.5], [by]).where(F.col("n") >= min_count)
            .select(by, "n", F.col("q")[0].alias("mediana")))
