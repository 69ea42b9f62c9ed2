"""Unnesting of JSON cells."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from posada.functions.documents import clean_list, quote_fields, raw_list


def _items(df: DataFrame) -> Column:
    """The elements of amenities, which may be read from its text already."""
    items = F.col("amenities")
    return items if isinstance(df.schema["amenities"].dataType, ArrayType) else clean_list(items)


def add_amenity_count(df: DataFrame) -> DataFrame:
    """amenities -> cantidad_amenities (repeats count, blanks do not)."""
    if "amenities" not in df.columns:
        return df.withColumn("cantidad_amenities", F.lit(0).cast("long"))
    count = F.size(_items(df)).cast("long")
    return df.withColumn("cantidad_amenities", count).drop("amenities")


def amenity_pairs(df: DataFrame, unique_ids: bool = False, raw: bool = False) -> DataFrame:
    """Long table listing_id, amenity without repeated pairs (raw=True keeps elements as they are).

    With unique_ids (one row per id) repeats can only occur inside a row, and no shuffle is needed.
    """
    if "amenities" not in df.columns:
        return df.sparkSession.createDataFrame([], "listing_id long, amenity string")
    items = raw_list(F.col("amenities")) if raw else _items(df)
    pairs = df.select(F.col("id").alias("listing_id"),
                      F.explode(items if raw else F.array_distinct(items)).alias("amenity"))
    return pairs if raw or unique_ids else pairs.distinct()


def flatten_quote(df: DataFrame) -> DataFrame:
    """price_quote_raw -> four flat columns."""
    if "price_quote_raw" not in df.columns:
        return df
    return df.withColumns(quote_fields(F.col("price_quote_raw"))).drop("price_quote_raw")
