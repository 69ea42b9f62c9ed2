"""Helpers that several operators share: staging folder, Arrow text buffers and 64-bit mixing."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from posada.staging import Stage

MIX_1, MIX_2, MIX_3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(spark: SparkSession) -> Stage:
    """A new private folder under the shared folder of the session."""
    return Stage(spark)


def text_or_empty(column: str) -> F.Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column in one array, and the n + 1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return held[ends[0]:ends[-1]] if len(ends) else held[:0], ends - ends[0]


def slices(batches, max_bytes: int, column: str = "text"):
    """Record batches cut so that the text of each has about max_bytes at most; one row is never cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(lengths) - lengths) // max_bytes
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers (the SplitMix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = values + MIX_1
        x = (x ^ (x >> np.uint64(30))) * MIX_2
        x = (x ^ (x >> np.uint64(27))) * MIX_3
    return x ^ (x >> np.uint64(31))


_ARROW = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
          "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}


def map_texts(df: DataFrame, text: str, fields: list[T.StructField], rows, batch_bytes: int,
              keep: list[str] | None = None) -> DataFrame:
    """df with further columns, made from the text column batch by batch.

    rows: from a text column to one tuple for each row. keep: the columns that stay (None: all). Columns that
    have the name of a new one give way to it; the text column itself is still read then."""
    new = {f.name.lower() for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    schema = T.StructType([df.schema[c] for c in kept] + fields)
    kinds = [_ARROW[f.dataType.simpleString()] for f in fields]

    def run(batches):
        for batch in slices(batches, batch_bytes, "__text"):
            made = list(zip(*rows(batch.column("__text")))) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *(pa.array(v, k) for v, k in zip(made, kinds))],
                names=[*kept, *(f.name for f in fields)])

    return df.select(*kept, text_or_empty(text).alias("__text")).mapInArrow(run, schema)
