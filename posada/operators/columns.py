"""Choice of columns at plan-building time."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, FloatType, NumericType

from posada.fixed_values import HOST_PREFIXES, VALUELESS_COLUMNS
from posada.functions.numbers import nan_to_null


def is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, NumericType)


def is_boolean(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, BooleanType)


def present(df: DataFrame, names: list[str]) -> list[str]:
    return [c for c in names if c in df.columns]


def by_prefix(df: DataFrame, prefixes: list[str], excluded: tuple[str, ...] = ()) -> list[str]:
    return [c for c in df.columns if c.startswith(tuple(prefixes)) and c not in excluded]


def host_columns(df: DataFrame) -> list[str]:
    return by_prefix(df, HOST_PREFIXES, excluded=("host_id",))


def normalise_nan(df: DataFrame) -> DataFrame:
    """Floating NaN -> null, so that null is the only missing value from here on."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: nan_to_null(F.col(c)) for c in floating}) if floating else df


def empty_columns(df: DataFrame) -> list[str]:
    """Columns without any value (one aggregate job). An empty table reports none."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if counts[c] == 0] if counts["_rows"] else []


def drop_empty_columns(df: DataFrame, valueless: list[str] = VALUELESS_COLUMNS) -> DataFrame:
    """Without the columns that are null in every row and those listed as valueless."""
    return df.drop(*empty_columns(df), *valueless)
