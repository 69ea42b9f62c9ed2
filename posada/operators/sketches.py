"""Approximate quantiles from mergeable sketches, for those who can do with a stated rank error.

A sketch has a bounded size whatever the number of rows, so a group is never in one place; sketches of
months can be stored and merged into those of years without reading a row again. A quantile found at p
has a rank within RANK_ERROR of p (with 99 % confidence for one query). The exact way is
`quantiles.exact_quantiles`.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posada.operators.quantiles import long_values

#: Size of a sketch, and the normalised rank error that goes with it (about 2.3 / K ** 0.9, two-sided).
K = 800
RANK_ERROR = 0.006


def quantile_sketches(df: DataFrame, columns: list[str], by: list[str] | None = None, k: int = K) -> DataFrame:
    """by..., columna, n, sketch: one row per group and column that has values."""
    by = list(by or [])
    return long_values(df, columns, by).groupBy(*by, "columna").agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("v", F.lit(k)).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: list[str] | None = None, k: int = K) -> DataFrame:
    """Sketches of finer groups as those of coarser ones: by is a part of the columns they were made by."""
    return sketches.groupBy(*(by or []), "columna").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probs: list[float]) -> DataFrame:
    """The sketches' rows with q[i], a value whose rank is about probs[i], in place of the sketch."""
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    kept = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(*kept, F.kll_sketch_get_quantile_double("sketch", wanted).alias("q"))


def approximate_quantiles(df: DataFrame, columns: list[str], probs: list[float], by: list[str] | None = None) -> DataFrame:
    """by..., columna, n, q, as exact_quantiles gives them."""
    return sketch_quantiles(quantile_sketches(df, columns, by), probs)
