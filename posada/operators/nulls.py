"""Missing values per column."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _long(row: DataFrame, columns: list[str], name: str) -> DataFrame:
    """One-row aggregate -> (columna, name) rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("columna"), F.col(c).alias(name)) for c in columns])
    return row.select(F.inline(pairs))


def null_counts(df: DataFrame) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _long(counts, df.columns, "nulos")


def null_percentages(df: DataFrame, decimals: int = 2) -> DataFrame:
    """Columns with missing values, the emptiest first."""
    shares = df.agg(*[(F.avg(F.col(c).isNull().cast("int")) * 100).alias(c) for c in df.columns])
    return (_long(shares, df.columns, "pct").where(F.col("pct") > 0)
            .orderBy(F.desc("pct"), "columna")
            .select("columna", F.bround("pct", decimals).alias("pct")))


def null_cells_of_row(columns: list[str]) -> Column:
    return sum((F.col(c).isNull().cast("long") for c in columns), F.lit(0).cast("long"))


def null_cells(df: DataFrame) -> DataFrame:
    """Missing cells of the whole table."""
    return df.agg(F.coalesce(F.sum(null_cells_of_row(df.columns)), F.lit(0)).alias("celdas_nulas"))


def structure(df: DataFrame) -> DataFrame:
    """Columns in order with their type and number of values."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    entries = F.array(*[
        F.struct(F.lit(i).cast("long").alias("orden"), F.lit(f.name).alias("columna"),
                 F.lit(f.dataType.simpleString()).alias("tipo"), F.col(f.name).alias("no_nulos"))
        for i, f in enumerate(df.schema.fields)])
    return counts.select(F.inline(entries))


def shape(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("filas")).select(
        F.lit(name).alias("tabla"), "filas", F.lit(len(df.columns)).cast("long").alias("columnas"))
