"""Extreme values."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posada.functions.flags import certainly
from posada.operators.lookup import lookup_join
from posada.operators.quantiles import exact_quantiles, quantile_scalar, quantile_struct
from posada.staging import Stage


def fences(q1: Column, q3: Column, factor: float = 1.5) -> tuple[Column, Column]:
    reach = (q3 - q1) * F.lit(factor)
    return q1 - reach, q3 + reach


def fence_scalar(df: DataFrame, column: str, factor: float = 1.5) -> Column:
    """(low, high) of the whole column as one scalar struct."""
    q = F.col(column)
    low, high = fences(q[0], q[1], factor)
    row = quantile_struct(df, [column], [0.25, 0.75])
    return row.select(F.struct(low.alias("low"), high.alias("high"))).scalar()


def iqr_outlier(df: DataFrame, column: str, factor: float = 1.5) -> Column:
    """Flag: strictly outside the quartile fences of the whole column, on either side."""
    fence = fence_scalar(df, column, factor)
    return certainly((F.col(column) < fence.getField("low"))
                     | (F.col(column) > fence.getField("high")))


def upper_outliers(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """Upper fence, number of values above it and their share of all rows."""
    fence = fence_scalar(df, column, factor)
    marked = df.select(F.col(column).alias("v"), fence.getField("high").alias("limite"))
    above = certainly(F.col("v") > F.col("limite"))
    return marked.agg(F.max("limite").alias("limite_iqr"), F.count_if(above).alias("atipicos"),
                      F.avg(above.cast("int")).alias("proporcion"))


def between_quantiles(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows whose value lies between two quantiles of the column, both included."""
    bounds = quantile_scalar(df, column, [low, high])
    return df.where(F.col(column).between(bounds[0], bounds[1]))


def threshold_counts(df: DataFrame, column: str, limits: dict[str, float]) -> DataFrame:
    """One column per named limit: rows strictly above it."""
    return df.agg(*[F.count_if(certainly(F.col(column) > F.lit(float(limit)))).alias(name)
                    for name, limit in limits.items()])


def box_stats(df: DataFrame, column: str, by: list[str] | None = None,
              factor: float = 1.5, stage: Stage | None = None) -> DataFrame:
    """Quartiles, whiskers (last value inside the fences) and number of outliers, per group.

    stage: where the quartiles of the groups are kept; without one they are computed twice.
    """
    by = list(by or [])
    quartiles = exact_quantiles(df, [column], [0.25, 0.5, 0.75], by).select(
        *by, *[F.col("q")[i].alias(name) for i, name in enumerate(("q1", "mediana", "q3"))])
    values = df.select(*by, F.col(column).cast("double").alias("v")).dropna()
    if by:
        quartiles = quartiles if stage is None else stage.put(quartiles, f"quartiles_{column}")
        rows = lookup_join(values, quartiles, by)
    else:
        only = quartiles.select(F.struct("q1", "mediana", "q3")).scalar()
        rows = values.select("v", only.alias("only")).select("v", "only.*")
    low, high = fences(F.col("q1"), F.col("q3"), factor)
    inside = (F.col("v") >= low) & (F.col("v") <= high)
    return rows.groupBy(*by, "q1", "mediana", "q3").agg(
        F.min(F.when(inside, F.col("v"))).alias("bigote_inferior"),
        F.max(F.when(inside, F.col("v"))).alias("bigote_superior"),
        F.count_if(~inside).alias("atipicos"))
