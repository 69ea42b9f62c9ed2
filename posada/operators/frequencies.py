"""Counts of values and groups."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from posada.functions.dates import parse_date, year_month
from posada.functions.flags import certainly


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """column, n (nulls excluded)."""
    return (df.dropna(subset=[column]).groupBy(column).agg(F.count(F.lit(1)).alias("n")))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """column, proporcion of the non-null rows."""
    total = df.agg(F.count(column)).scalar()
    return value_counts(df, column).select(column, (F.col("n") / total).alias("proporcion"))


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    return value_counts(df, column).orderBy(F.desc("n"), column).limit(k)


def distinct_counts(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """One row. Several exact counts in one aggregate would multiply the rows by the columns, so the
    distinct values of each column are found on their own; the approximate counts share one pass."""
    if approximate:
        return df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
    first, *others = [df.select(c).dropna().distinct().agg(F.count(F.lit(1)).alias(c)) for c in columns]
    return first.select(columns[0], *[one.scalar().alias(c) for c, one in zip(columns[1:], others)])


def value_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("desde"), F.max(column).alias("hasta"))


def group_size_range(df: DataFrame, key: str) -> DataFrame:
    return value_counts(df, key).agg(F.min("n").alias("min"), F.max("n").alias("max"))


def group_count(df: DataFrame, keys: list[str | Column]) -> DataFrame:
    """Number of groups; rows with a null key belong to none. Keys are names or expressions."""
    return df.agg(F.count_distinct(*keys).alias("grupos"))


def per_year(df: DataFrame, date: Column) -> DataFrame:
    """anio, n in order of year."""
    return (df.select(F.year(date).cast("long").alias("anio"))
            .groupBy("anio").agg(F.count("anio").alias("n")).where("n > 0").orderBy("anio"))


def year_over_year(per_year_counts: DataFrame) -> DataFrame:
    """anio, n, cambio_pct against the calendar year before (null where that year has no rows)."""
    # One row per year, so a window without partitions is small whatever the size of the data.
    years = W.orderBy("anio")
    change = (F.col("n") / F.lag("n").over(years) - 1) * 100
    follows = F.lag("anio").over(years) == F.col("anio") - 1
    return per_year_counts.select("anio", "n", F.when(follows, change).alias("cambio_pct"))


def availability_rates(calendar: DataFrame, by: str) -> DataFrame:
    """Share of available days in percent by 'mes' (yyyy-mm), 'dia_semana' or 'total'."""
    date = parse_date(F.col("date"))
    days = calendar.select(date.alias("fecha"),
                           certainly(F.col("available") == "t").cast("int").alias("disponible"))
    rate = (F.avg("disponible") * 100).alias("pct")
    if by == "total":
        return days.agg(rate)
    labels = {"mes": year_month(F.col("fecha")), "dia_semana": F.weekday("fecha").cast("long")}
    return (days.groupBy(labels[by].alias(by)).agg(rate, F.count("fecha").alias("dias"))
            .where("dias > 0").drop("dias"))


def text_matches(df: DataFrame, column: str, tests: dict[str, Column]) -> DataFrame:
    """Rows that pass each named test."""
    return df.agg(*[F.count_if(certainly(test)).alias(name) for name, test in tests.items()])


def first_match(df: DataFrame, predicate: Column, order_by: list[str], column: str,
                max_chars: int) -> DataFrame:
    """Opening of one matching value, the first in order."""
    return (df.where(predicate).orderBy(*order_by).limit(1)
            .select(F.substring(column, 1, max_chars).alias("muestra")))


def first_rows(df: DataFrame, order_by: list[str], n: int) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def largest(df: DataFrame, column: str, n: int, tie_break: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(column), tie_break).limit(n)
