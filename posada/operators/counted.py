"""Summaries of values that are counted already: one row for each distinct value, n the rows that hold it.

A table is read once to count the values of all its columns (`count_values`); whatever is asked about
them afterwards reads that small table. Entries are columna, clave (a key, or the group of a number), v
(a number) and n.
"""

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posada.functions.flags import certainly
from posada.operators.histograms import bin_counts, labelled_bins
from posada.operators.outliers import fences
from posada.operators.quantiles import counted_quantiles

ENTRY = "columna string, clave string, v double"


def number(name: str, value: Column, group: Column | None = None) -> Column:
    """An entry for a number, by group if there is one."""
    return _entry(name, group, value.cast("double"))


def key(name: str, value: Column) -> Column:
    return _entry(name, value, None)


def _entry(name: str, group: Column | None, value: Column | None) -> Column:
    return F.struct(F.lit(name).alias("columna"),
                    (F.lit(None) if group is None else group).cast("string").alias("clave"),
                    (F.lit(None) if value is None else value).cast("double").alias("v"))


def count_values(df: DataFrame, entries: list[Column], lists: dict[str, Column] | None = None) -> DataFrame:
    """columna, clave, v, n. lists: columns of which every element is an entry."""
    whole = F.array(*entries)
    for name, items in (lists or {}).items():
        whole = F.concat(whole, F.transform(items, partial(key, name)))
    return df.select(F.inline(whole)).groupBy("columna", "clave", "v").agg(F.count(F.lit(1)).alias("n"))


def numbers(counts: DataFrame, name: str) -> DataFrame:
    """clave, v, n of a number column, without missing values."""
    return counts.where((F.col("columna") == name) & F.col("v").isNotNull() & ~F.isnan("v")).select("clave", "v", "n")


def keys(counts: DataFrame, name: str) -> DataFrame:
    """clave, n without the missing key."""
    return counts.where((F.col("columna") == name) & F.col("clave").isNotNull()).select("clave", "n")


def quantiles(values: DataFrame, probs: list[float], by: list[str] | None = None) -> DataFrame:
    """by..., n, q."""
    by = list(by or [])
    sized = values.dropna(subset=by) if by else values
    whole = [*by, "columna"]
    return counted_quantiles(sized.select(*by, F.lit("v").alias("columna"), "v", F.col("n").alias("size")), whole,
                             probs).drop("columna")


def describe(counts: DataFrame, columns: list[str], probs: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """columna, count, mean, std, min, max and one p.. column per probability."""
    values = counts.where(F.col("columna").isin(columns) & F.col("v").isNotNull() & ~F.isnan("v"))
    moments = values.groupBy("columna").agg(
        F.sum("n").alias("count"), (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("mean"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    # The mean comes first, as squares of large values would swallow a small spread. One row per column.
    off = F.col("v") - F.col("mean")
    spread = values.join(F.broadcast(moments.select("columna", "mean")), "columna").groupBy("columna").agg(
        F.sum(F.col("n") * off * off).alias("square"))
    found = counted_quantiles(values.select("columna", "v", F.col("n").alias("size")), ["columna"], list(probs))
    return moments.join(spread, "columna").join(found.drop("n"), "columna").select(
        "columna", "count", "mean", F.sqrt(F.try_divide(F.col("square"), F.col("count") - 1)).alias("std"), "min", "max",
        *[F.col("q")[i].alias(f"p{p * 100:g}") for i, p in enumerate(probs)])


def rows_where(predicate: Column) -> Column:
    """Aggregate: rows whose value passes."""
    return F.coalesce(F.sum(F.when(certainly(predicate), F.col("n"))), F.lit(0).cast("long"))


def metrics_of_price(values: DataFrame, rows: int) -> DataFrame:
    """The record of summaries.price_metrics; rows counts all rows, also those without a price."""
    q = quantiles(values, [0.25, 0.5, 0.75, 0.99]).select("q").scalar()
    marked = values.select("v", "n", q.alias("q"))
    limit = fences(F.col("q")[0], F.col("q")[2])[1]
    return marked.agg(
        F.max(F.col("q")[1]).alias("mediana"), (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("media"),
        F.max(F.col("q")[0]).alias("q1"), F.max(F.col("q")[2]).alias("q3"), F.max(F.col("q")[3]).alias("p99"),
        F.max("v").alias("max"), F.max(limit).alias("limite_iqr"),
        rows_where(F.col("v") > limit).alias("atipicos_iqr"), rows_where(F.col("v") > 1e7).alias("mayor_10M"),
        (F.lit(rows) - F.coalesce(F.sum("n"), F.lit(0))).alias("sin_precio"))


def upper_outliers(values: DataFrame, rows: int, factor: float = 1.5) -> DataFrame:
    """Upper fence, rows above it and their share of all rows."""
    q = quantiles(values, [0.25, 0.75]).select("q").scalar()
    limit = fences(F.col("q")[0], F.col("q")[1], factor)[1]
    found = values.select("v", "n", q.alias("q")).agg(
        F.max(limit).alias("limite_iqr"), rows_where(F.col("v") > limit).alias("atipicos"))
    return found.withColumn("proporcion", F.col("atipicos") / rows) if rows else found.withColumn(
        "proporcion", F.lit(None).cast("double"))


def box_stats(values: DataFrame, by: list[str] | None = None, factor: float = 1.5) -> DataFrame:
    """by..., quartiles, whiskers and number of outliers."""
    by = list(by or [])
    quartiles = quantiles(values, [0.25, 0.5, 0.75], by).select(
        *by, *[F.col("q")[i].alias(name) for i, name in enumerate(("q1", "mediana", "q3"))])
    if by:
        rows = values.join(quartiles, by)
    else:
        only = quartiles.select(F.struct("q1", "mediana", "q3")).scalar()
        rows = values.select("v", "n", only.alias("only")).select("v", "n", "only.*")
    low, high = fences(F.col("q1"), F.col("q3"), factor)
    inside = (F.col("v") >= low) & (F.col("v") <= high)
    return rows.groupBy(*by, "q1", "mediana", "q3").agg(
        F.min(F.when(inside, F.col("v"))).alias("bigote_inferior"),
        F.max(F.when(inside, F.col("v"))).alias("bigote_superior"), rows_where(~inside).alias("atipicos"))


def equal_width_bins(values: DataFrame, value: Column, bins: int) -> DataFrame:
    """orden, desde, n, as histograms.equal_width_bins gives them."""
    return bin_counts(values.select(value.cast("double").alias("v"), "n").dropna(), bins)


def fixed_bins(values: DataFrame, edges: list[int]) -> DataFrame:
    return labelled_bins(values.select("v", "n"), edges)


def describe_text(counts: DataFrame, columns: list[str]) -> DataFrame:
    """columna, count, unique, top (smallest text among equals), freq."""
    held = counts.where(F.col("columna").isin(columns) & F.col("clave").isNotNull())
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("clave")))
    return held.groupBy("columna").agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
                                       best.getField("clave").alias("top"), F.max("n").alias("freq"))


def rates(counts: DataFrame, name: str) -> DataFrame:
    """clave, pct: mean of a number between 0 and 1 by key, in percent."""
    return numbers(counts, name).groupBy("clave").agg((F.sum(F.col("v") * F.col("n")) * 100 / F.sum("n")).alias("pct"))


def host_concentration(sizes: DataFrame, rows: int, large: int = 10) -> DataFrame:
    """The record of hosts.host_concentration from the listings of each host (n)."""
    held = F.sum(F.when(F.col("n") >= large, F.col("n")).otherwise(0))
    return sizes.agg(F.count(F.lit(1)).alias("distintos"), F.count_if(F.col("n") == 1).alias("con_uno"),
                     F.coalesce(held, F.lit(0)).alias("alojamientos_grandes"), F.max("n").alias("max_alojamientos")) \
        .withColumns({"proporcion_con_uno": F.try_divide(F.col("con_uno"), F.col("distintos")),
                      "proporcion_grandes": F.try_divide(F.col("alojamientos_grandes"), F.lit(rows))})
