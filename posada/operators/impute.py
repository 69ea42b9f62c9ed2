"""Filling missing values."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posada.operators.columns import present
from posada.operators.quantiles import counted_quantiles
from posada.staging import Stage

_GROUP = "_grupo"


def group_counts(df: DataFrame, columns: list[str], group: str | None) -> DataFrame:
    """columna, _grupo, v, n: rows for each value of each column and group, missing values too. One read
    of df; medians and quartiles are made from this small table."""
    by = F.lit(None).cast("string") if group is None else F.col(group)
    entries = F.array(*[F.struct(F.lit(c).alias("columna"), F.col(c).cast("double").alias("v")) for c in columns])
    return df.select(by.alias(_GROUP), F.inline(entries)).groupBy("columna", _GROUP, "v").agg(F.count(F.lit(1)).alias("n"))


def group_medians(counts: DataFrame) -> DataFrame:
    """columna, _grupo, mediana; rows without a group belong to none."""
    known = counts.where(F.col("v").isNotNull() & F.col(_GROUP).isNotNull())
    return counted_quantiles(known.withColumnRenamed("n", "size"), ["columna", _GROUP], [0.5]).select(
        "columna", _GROUP, F.col("q")[0].alias("mediana"))


def filled_quantiles(counts: DataFrame, medians: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """columna, q: quantiles of each column, in which the missing values of `columns` have become the median
    of their group."""
    missing = counts.where(F.col("v").isNull() & F.col("columna").isin(columns)).drop("v")
    values = counts.where(F.col("v").isNotNull()).select("columna", "v", "n").unionByName(
        missing.join(medians, ["columna", _GROUP]).select("columna", F.col("mediana").alias("v"), "n"))
    return counted_quantiles(values.groupBy("columna", "v").agg(F.sum("n").alias("size")), ["columna"], probs).select("columna", "q")


def with_medians(df: DataFrame, columns: list[str], group: str, medians: DataFrame) -> DataFrame:
    """Null -> median of the row's group. The medians are few narrow rows: a staged table of them has a known size,
    by which Spark sends them to every task or shuffles, and splits groups that are too large."""
    wide = medians.groupBy(_GROUP).agg(*[F.max(F.when(F.col("columna") == c, F.col("mediana"))).alias(f"_median_{c}")
                                         for c in columns]).withColumnRenamed(_GROUP, group)
    joined = df.join(wide, group, "left")
    return joined.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"_median_{c}")) for c in columns}).select(*df.columns)


def impute_group_median(df: DataFrame, columns: list[str], group: str, stage: Stage | None = None) -> DataFrame:
    """Null -> median of its group, then -> median of the column as filled so far.

    stage: where counts and medians are kept; without one they are made for each use.
    """
    columns = present(df, columns)
    as_double = df.withColumns({c: F.col(c).cast("double") for c in columns})
    if not columns:
        return as_double
    keep = (lambda x, name: x) if stage is None else stage.put
    counts = keep(group_counts(df, columns, group if group in df.columns else None), "value_counts")
    medians = keep(group_medians(counts), "medians")
    filled = with_medians(as_double, columns, group, medians) if group in df.columns else as_double
    whole = filled_quantiles(counts, medians, columns, [0.5]).agg(
        *[F.max(F.when(F.col("columna") == c, F.col("q")[0])).alias(c) for c in columns])
    overall: Column = whole.select(F.struct("*")).scalar()
    return filled.withColumns({c: F.coalesce(F.col(c), overall.getField(c)) for c in columns})
