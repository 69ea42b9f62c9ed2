"""Scans of landed collections."""

import logging
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DoubleType, FloatType, IntegerType, LongType, NullType,
                               ShortType, StringType)

from posada.staging import child_names

log = logging.getLogger(__name__)

_COMPARISONS: dict[str, Callable[[Column, object], Column]] = {
    "$eq": lambda c, v: c.eqNullSafe(F.lit(v)),
    "$ne": lambda c, v: ~c.eqNullSafe(F.lit(v)),
    "$gt": lambda c, v: c > F.lit(v),
    "$gte": lambda c, v: c >= F.lit(v),
    "$lt": lambda c, v: c < F.lit(v),
    "$lte": lambda c, v: c <= F.lit(v),
    "$in": lambda c, v: c.isin(list(v)),
}


def condition(where: dict | Column | str | None) -> Column | None:
    """{"date": {"$gte": "2026-07-01"}} (or a Column or SQL text) -> one predicate."""
    if isinstance(where, str):
        return F.expr(where)
    if not isinstance(where, dict):
        return where
    tests = []
    for name, wanted in where.items():
        operators = wanted if isinstance(wanted, dict) else {"$eq": wanted}
        for operator, value in operators.items():
            if operator not in _COMPARISONS:
                raise ValueError(f"unknown comparison {operator}")
            tests.append(_COMPARISONS[operator](F.col(name), value))
    return reduce(lambda a, b: a & b, tests) if tests else None


def scan(df: DataFrame, where: dict | Column | str | None = None,
         select: list[str] | dict[str, int] | None = None) -> DataFrame:
    """Filter and projection; both reach a Parquet scan. The internal _id never comes out."""
    predicate = condition(where)
    kept = df if predicate is None else df.where(predicate)
    if isinstance(select, dict):
        left_out = [c for c, flag in select.items() if not flag]
        select = [c for c, flag in select.items() if flag] or \
            [c for c in kept.columns if c not in left_out]
    return (kept.select(*select) if select else kept).drop("_id")


_EXACT_WHOLE = 1 << 53      # whole numbers up to here are doubles too


def union_batches(batches: list[DataFrame]) -> DataFrame:
    """All rows of all batches; a column that a batch lacks is null there.

    Where batches differ in the type of a column, all of them take the smallest type that holds every
    value: whole numbers become the wider whole type, or doubles if all of them are doubles exactly,
    and anything else becomes text.
    """
    types = common_types(batches)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [
        df.withColumns({c: F.col(f"`{c}`").cast(t) for c, t in types.items()
                        if c in df.columns and df.schema[c].dataType != t}) for df in batches])


def common_types(batches: list[DataFrame]) -> dict[str, DataType]:
    """The type of each column whose type differs between batches."""
    held: dict[str, list[DataType]] = {}
    for df in batches:
        for f in df.schema.fields:
            if not isinstance(f.dataType, NullType) and f.dataType not in held.setdefault(f.name, []):
                held[f.name].append(f.dataType)
    found = {c: join_types(types) for c, types in held.items() if len(types) > 1}
    for c in [c for c, t in found.items() if isinstance(t, DoubleType)]:
        if any(isinstance(t, LongType) for t in held[c]) and not _fit_doubles(batches, c):
            found[c] = StringType()
    return found


def join_types(types: list[DataType]) -> DataType:
    """The least upper bound in: byte, short, int, long < double (also above float) < text. Types that are
    not among these have only text above them. Whether longs fit doubles is for the caller to see."""
    whole = [ByteType(), ShortType(), IntegerType(), LongType()]
    real = [FloatType(), DoubleType()]
    if all(t == types[0] for t in types):
        return types[0]
    if all(t in whole for t in types):
        return max(types, key=whole.index)
    return DoubleType() if all(t in whole + real for t in types) else StringType()


def _fit_doubles(batches: list[DataFrame], column: str) -> bool:
    """No whole number of the column is too large for a double to hold exactly."""
    return not any(df.agg(F.max(~F.col(f"`{column}`").between(-_EXACT_WHOLE, _EXACT_WHOLE))).first()[0] for df in batches
                   if column in df.columns and isinstance(df.schema[column].dataType, LongType))


class Store:
    """A folder with one Parquet collection per entry.

    merge_schemas is for collections whose files differ in columns (a footer read of every file).
    """

    def __init__(self, spark: SparkSession, root: str, merge_schemas: bool = False):
        self.spark = spark
        self.root = root.rstrip("/")
        self.merge_schemas = merge_schemas

    def names(self) -> list[str]:
        return [n.removesuffix(".parquet") for n in child_names(self.spark, self.root)
                if not n.startswith(("_", "."))]

    def table(self, name: str) -> DataFrame:
        entries = child_names(self.spark, self.root)
        for entry in (name, f"{name}.parquet"):
            if entry in entries:
                reader = self.spark.read.option("mergeSchema", self.merge_schemas)
                return reader.parquet(f"{self.root}/{entry}")
        raise ValueError(f"no collection '{name}' in {self.root}")

    def scan(self, name: str, where=None, select=None) -> DataFrame:
        return scan(self.table(name), where, select)

    def scan_all(self, names: list[str]) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in names}

    def counts(self, names: list[str]) -> dict[str, int]:
        """Rows per collection, from file footers; an empty one is reported as a warning."""
        counts = {name: self.table(name).count() for name in names}
        for name, rows in counts.items():
            if not rows:
                log.warning("collection '%s' has no rows", name)
        log.info("%d rows in %d collections", sum(counts.values()), len(counts))
        return counts


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON document written by a previous run."""
    return spark.read.json(path, multiLine=True)
