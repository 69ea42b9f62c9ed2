"""Exact quantiles (linear interpolation) that never hold one group's values in one place.

The built-in exact percentile keeps a value -> count map per group in a single task. Here every value
belongs to a coarse and a fine cell, and rows are counted per cell: running totals over the coarse cells
tell which ones hold the wanted ranks, those are looked at in fine cells, and only the values of the fine
cells found are ranked one by one.

Cells are fixed, non-decreasing functions of the value, so no sampling is involved and every evaluation
of the plan agrees with every other. A coarse cell is about 0.1 % wide in relative terms, at any
magnitude, and is split into FINE_CELLS. A window over fine cells has that many rows at most. One over the
values of a fine cell has one row per different double in a range of 2 to the power of -26 in relative
terms: a few where values spread over the coarse cell, and never more than 2^27, whatever the number of rows.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CELLS = ["coarse", "fine"]
FINE_CELLS = 1 << 16

_PER_E_FOLD = 1024
_LOWEST_LOG = 746       # above minus the logarithm of the smallest positive double


def with_cells(df: DataFrame, value: str) -> DataFrame:
    """Add the cells of a value that is neither null nor NaN."""
    size, sign = F.abs(value), F.signum(value)
    step = F.floor(F.coalesce((F.log(size) + _LOWEST_LOG) * _PER_E_FOLD, F.lit(0.0)))
    # Position inside the coarse cell, from its lower edge; slightly less than 1 at the upper one.
    edge = F.exp(step / _PER_E_FOLD - _LOWEST_LOG)
    share = (F.coalesce(F.try_divide(size, edge), F.lit(1.0)) - 1) * (_PER_E_FOLD - 1)
    fine = F.least(F.greatest(F.floor(share * FINE_CELLS), F.lit(0)), F.lit(FINE_CELLS - 1))
    return df.withColumns({CELLS[0]: (sign * step).cast("long"), CELLS[1]: (sign * fine).cast("long")})


def held_per_cell(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per fine cell, from a table with cells and the column `size`."""
    return counted.groupBy(*keys, *CELLS).agg(F.sum("size").alias("held"))


def running_start(rows: DataFrame, inside: list[str], order: str, held: str = "held",
                  offset: str | None = None) -> DataFrame:
    """Add `start`: the rows before this one inside its partition, after those in `offset`."""
    so_far = (W.partitionBy(*inside).orderBy(order)
              .rowsBetween(W.unboundedPreceding, W.currentRow))
    start = F.sum(held).over(so_far) - F.col(held)
    return rows.withColumn("start", start + F.col(offset) if offset else start)


def long_values(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """by..., columna, v: one row per non-missing value; rows with a null group are left out."""
    entries = F.array(*[F.struct(F.lit(c).alias("columna"), F.col(c).cast("double").alias("v"))
                        for c in columns])
    rows = df.dropna(subset=by) if by else df
    return (rows.select(*by, F.explode(entries).alias("e")).select(*by, "e.columna", "e.v")
            .where(F.col("v").isNotNull() & ~F.isnan("v")))


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float],
                    by: list[str] | None = None) -> DataFrame:
    """by..., columna, n, q: one row per group and column, q[i] the quantile of probs[i].

    A group or column without values has no row.
    """
    by = list(by or [])
    keys = [*by, "columna"]
    values = long_values(df, columns, by)
    if by:
        # Counting equal values first makes the largest group as small as its distinct values.
        return counted_quantiles(values.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("size")), keys, probs)
    # At most two cells per probability and column are wanted, whatever the size of the data.
    values = with_cells(values, "v")
    coarse = values.groupBy(*keys, CELLS[0]).agg(F.count(F.lit(1)).alias("held"))
    wanted = F.broadcast(_wanted(_first_level(coarse, keys), probs))
    counted = (values.join(wanted, [*keys, CELLS[0]])
               .groupBy(*keys, *CELLS, "before", "n", "v").agg(F.count(F.lit(1)).alias("size")))
    cells = held_per_cell(counted, [*keys, "before", "n"])
    finer = running_start(cells, [*keys, CELLS[0]], CELLS[1], offset="before")
    return _picked(counted.drop("before", "n"), F.broadcast(_wanted(finer.drop("before"), probs)), keys, probs)


def counted_quantiles(counted: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """keys..., n, q, as exact_quantiles gives them, from keys..., v and size, the rows that hold v."""
    counted = with_cells(counted, "v")
    cells = held_per_cell(counted, keys)
    coarse = cells.groupBy(*keys, CELLS[0]).agg(F.sum("held").alias("held"))
    wanted = _wanted(_first_level(coarse, keys), probs)
    inside = [*keys, CELLS[0]]
    finer = running_start(cells.join(wanted, inside), inside, CELLS[1], offset="before")
    return _picked(counted, _wanted(finer.drop("before"), probs), keys, probs)


def _picked(counted: DataFrame, wanted: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """The quantiles, from the values of the fine cells that hold a rank asked for."""
    inside = [*keys, *CELLS]
    ranked = running_start(counted.join(wanted, inside), inside, "v", "size", "before")
    ranked = ranked.withColumnRenamed("size", "held")
    picks = []
    for i, p in enumerate(probs):
        for side, rank in zip(("lo", "hi"), _neighbours(p)):
            hit = _covers(rank, F.col("start"), F.col("held"))
            picks.append(F.max(F.when(hit, F.col("v"))).alias(f"{side}{i}"))
    picked = ranked.groupBy(*keys).agg(F.max("n").alias("n"), *picks)
    return picked.select(*keys, "n", F.array(*[_interpolate(i, p) for i, p in enumerate(probs)])
                         .alias("q"))


def quantile_struct(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """One row, one array column per input column (null where a column has no value)."""
    rows = exact_quantiles(df, columns, probs)
    return rows.agg(*[F.max(F.when(F.col("columna") == c, F.col("q"))).alias(c) for c in columns])


def quantile_scalar(df: DataFrame, column: str, probs: list[float]) -> Column:
    """The quantiles as a scalar array, to be compared with every row without any join."""
    return quantile_struct(df, [column], probs).scalar()


def _first_level(coarse: DataFrame, keys: list[str]) -> DataFrame:
    return running_start(coarse, keys, CELLS[0]).withColumn("n", F.sum("held").over(W.partitionBy(*keys)))


def _wanted(placed: DataFrame, probs: list[float]) -> DataFrame:
    """The cells that hold a rank asked for; `before` counts the rows ahead of the cell."""
    spans = [_covers(rank, F.col("start"), F.col("held")) for p in probs for rank in _neighbours(p)]
    return (placed.where(reduce(lambda a, b: a | b, spans)).drop("held")
            .withColumnRenamed("start", "before"))


def _position(p: float) -> Column:
    return (F.col("n") - 1) * F.lit(float(p))


def _neighbours(p: float) -> tuple[Column, Column]:
    return F.floor(_position(p)), F.ceil(_position(p))


def _covers(rank: Column, start: Column, held: Column) -> Column:
    return (start <= rank) & (rank < start + held)


def _interpolate(i: int, p: float) -> Column:
    low, high = F.col(f"lo{i}"), F.col(f"hi{i}")
    part = _position(p) - F.floor(_position(p))
    return F.when(low == high, low).otherwise(low + (high - low) * part)
