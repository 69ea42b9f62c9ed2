"""Boolean columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_tf(text: Column) -> Column:
    """'t' / 'f' -> true / false, anything else null."""
    return F.when(text == "t", True).when(text == "f", False)


def certainly(predicate: Column) -> Column:
    """Null counts as false."""
    return F.coalesce(predicate, F.lit(False))
