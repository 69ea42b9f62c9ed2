"""CSV files -> typed Parquet collections."""

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from posada.audit import LandingCount
from posada.fixed_values import KNOWN_TEXT_COLUMNS, LANDING_ORDER, NA_TOKENS
from posada.operators.columns import normalise_nan
from posada.sinks.tables import laid_out
from posada.sources.store import union_batches
from posada.staging import Stage, path_exists

_WHOLE = r"^\s*[+-]?\d+\s*$"
_REAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def read_csv(spark: SparkSession, path: str, multi_line: bool = True,
             na_tokens: list[str] | None = NA_TOKENS) -> DataFrame:
    """Header CSV as text columns, missing-value tokens as null.

    A multi-line or gzip file is read by one task per file; multi_line=False splits uncompressed files
    and is for sources whose values hold no line breaks.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    df = spark.read.csv(path, header=True, multiLine=multi_line, escape='"', inferSchema=False,
                        enforceSchema=False)
    if not na_tokens:
        return df
    return df.withColumns({c: F.when(~F.col(f"`{c}`").isin(na_tokens), F.col(f"`{c}`"))
                           for c in df.columns})


def infer_types(df: DataFrame, known_text: list[str] = KNOWN_TEXT_COLUMNS) -> DataFrame:
    """Text columns -> long, double or text, without the columns that have no value.

    One aggregate over all columns: a column is a number only if every value is. Whole numbers of which
    one does not fit into a long stay text, as a double would merge neighbours. Of the columns known to
    be text only the values are counted.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    tests = df.agg(*[_kind_counts(c, c in known_text) for c in text]).first()
    chosen = []
    for name in df.columns:
        column = F.col(f"`{name}`")
        if name in text:
            found = tests[text.index(name)]
            if found["held"] == 0:
                continue
            if found["whole"] == found["held"]:
                if found["fits"] == found["held"]:
                    column = F.trim(column).cast("long").alias(name)
            elif found["real"] == found["held"]:
                column = F.trim(column).cast("double").alias(name)
        chosen.append(column)
    return df.select(*chosen) if chosen else df


def _kind_counts(name: str, is_text: bool) -> Column:
    """Values of a column, and how many of them are whole numbers, fit into a long, and are real numbers."""
    value = F.col(f"`{name}`")
    none = F.lit(0).cast("long")
    return F.struct(
        F.count(value).alias("held"),
        (none if is_text else F.count_if(value.rlike(_WHOLE))).alias("whole"),
        (none if is_text else F.count(F.trim(value).try_cast("long"))).alias("fits"),
        (none if is_text else F.count_if(value.rlike(_REAL))).alias("real"))


def land(spark: SparkSession, source: str | list[str], target: str, order: list[str] | None = None,
         multi_line: bool = True, max_records_per_file: int = 5_000_000,
         na_tokens: list[str] | None = NA_TOKENS, schema: StructType | None = None) -> LandingCount:
    """Replace the collection at `target` by the content of CSV files; returns both row counts.

    Several sources are batches of one collection: each is copied by tasks of its own, a column that one
    lacks is null there, and types are decided once over the values of all.

    With a schema its columns are cast to its types (values that do not fit become null) and nothing is
    inferred; other columns are left out.

    The text is first copied to splittable Parquet, as a compressed CSV gives one task per file; types
    are then inferred and written from that copy. Each file holds one range of the lookup columns and is
    sorted by them, so that readers skip files and row groups.
    """
    started = time.perf_counter()
    sources = [source] if isinstance(source, str) else list(source)
    with Stage(spark) as stage:
        # The count sits in the writing stage itself, where each row is counted exactly once.
        copied = [stage.put_measured(read_csv(spark, path, multi_line, na_tokens), f"text-{i}",
                                     {"rows": F.count(F.lit(1))}) for i, path in enumerate(sources)]
        copy = union_batches([df for df, _ in copied])
        typed = normalise_nan(infer_types(copy) if schema is None else copy.select(*[
            F.trim(F.col(f"`{f.name}`")).try_cast(f.dataType).alias(f.name)
            if not isinstance(f.dataType, StringType) else F.col(f"`{f.name}`") for f in schema.fields]))
        keys = [c for c in order or [] if c in typed.columns]
        (laid_out(typed, keys, []).write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
         .parquet(target))
    stored = spark.read.parquet(target).count()
    return LandingCount(", ".join(sources), sum(seen["rows"] for _, seen in copied), stored,
                        time.perf_counter() - started)


class LandingError(RuntimeError):
    """Rows of a file that are missing in the collection landed from it, or the other way round."""


def land_all(spark: SparkSession, sources: dict[str, str | list[str]], root: str,
             single_line: tuple[str, ...] = (), na_tokens: list[str] | None = NA_TOKENS,
             schemas: dict[str, StructType] | None = None) -> list[LandingCount]:
    """Land every named source under root; a missing file or differing row counts stop the landing.

    single_line: the sources whose values hold no line breaks."""
    counts = []
    for name, path in sources.items():
        counts.append(land(spark, path, f"{root.rstrip('/')}/{name}", LANDING_ORDER.get(name),
                           multi_line=name not in single_line, na_tokens=na_tokens,
                           schema=(schemas or {}).get(name)))
        if not counts[-1].ok:
            raise LandingError(f"{name}: {counts[-1]}")
    return counts
