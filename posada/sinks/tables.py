"""Publication of the output tables, extracts and verification."""

import logging
from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from posada.audit import Audit
from posada.fixed_values import EXPORT_GROUPS, LOOKUP_COLUMNS, PARTITION_COLUMNS, SHEET_MAX_ROWS
from posada.functions.text import truncate
from posada.operators.columns import present
from posada.staging import at_once, path_exists

log = logging.getLogger(__name__)

VERIFICATION_SCHEMA = "tabla string, esperado long, almacenado long, exportado long, ok boolean"
_PIECE = (1 << 22) - 1
CONTENT_SCHEMA = "tabla string, escrito decimal(38,0), leido decimal(38,0), igual boolean"


@dataclass(frozen=True)
class Written:
    """What the stage that wrote a table has counted: its rows and the digest of their content."""

    rows: int
    digest: Decimal
    schema: StructType


@dataclass(frozen=True)
class Summary:
    """A table that is made from another one, as that is stored."""

    source: str
    make: Callable[[DataFrame], DataFrame]


def content_digest(columns: list[str]) -> Column:
    """Aggregate: a number that depends on every cell, but not on the order of rows and columns.

    Row hashes are added up, so a row that is there twice counts twice. Which cells are null is hashed
    too, as the hash of a row passes over them.
    """
    names = sorted(columns)
    row = F.xxhash64(*names, *[F.col(c).isNull() for c in names])
    # Sums of pieces of 22 bits are whole numbers for 2^41 rows; a decimal for every row takes far longer.
    low, middle, high = row.bitwiseAND(F.lit(_PIECE)), F.shiftright(row, 22).bitwiseAND(F.lit(_PIECE)), F.shiftright(row, 44)
    pieces = [F.coalesce(F.sum(piece), F.lit(0)).cast("decimal(20,0)") * F.lit(Decimal(1 << shift)).cast("decimal(14,0)")
              for piece, shift in ((low, 0), (middle, 22), (high, 44))]
    return (pieces[0] + pieces[1] + pieces[2]).cast("decimal(38,0)")


def laid_out(df: DataFrame, order: list[str], partition_by: list[str]) -> DataFrame:
    """Rows in ranges of the lookup columns: each file holds one range, sorted, so readers pass over whole
    files and row groups; the rows of one partition folder lie in few files."""
    keys = [*partition_by, *[c for c in order if c not in partition_by]]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else df


def write_table(df: DataFrame, path: str, order: list[str] | None = None,
                partition_by: list[str] | None = None, only_these_partitions: bool = False,
                in_layout: bool = False) -> Written:
    """Replace the table at path, or only_these_partitions that df has rows for. in_layout: df is in ranges and sorted."""
    folders = present(df, partition_by or [])
    seen = Observation()
    counted = (df if in_layout else laid_out(df, present(df, order or []), folders)).observe(
        seen, F.count(F.lit(1)).alias("rows"), content_digest(df.columns).alias("digest"))
    writer = counted.write.mode("overwrite")
    if folders:
        mode = "dynamic" if only_these_partitions else "static"
        writer = writer.partitionBy(*folders).option("partitionOverwriteMode", mode)
    writer.parquet(path)
    return Written(seen.get["rows"], seen.get["digest"], df.schema)


def write_tables(tables: dict[str, DataFrame], root: str, audit: Audit | None = None,
                 partition_by: dict[str, list[str]] = PARTITION_COLUMNS, in_layout: set[str] = frozenset(),
                 summaries: dict[str, Summary] | None = None) -> dict[str, Written]:
    """Write every table under root in its layout, those in `summaries` from their sources as stored.

    in_layout: tables that are in ranges and sorted already.
    """
    audit = audit or Audit()
    made = {n: s for n, s in (summaries or {}).items() if n in tables and s.source in tables}

    def path(name: str) -> str:
        return f"{root.rstrip('/')}/{name}"

    def write(name: str) -> Written:
        df = tables[name]
        if name in made:
            source = made[name].source
            df = made[name].make(read_table(df.sparkSession, path(source), tables[source].schema)).select(*df.columns)
        with audit.timed("carga", name) as record:
            written = write_table(df, path(name), LOOKUP_COLUMNS.get(name), partition_by.get(name),
                                  in_layout=name in in_layout)
            record["rows"] = written.rows
        return written

    written = {}
    for names in ([n for n in tables if n not in made], list(made)):
        written |= zip(names, at_once([partial(write, name) for name in names]))
    return {name: written[name] for name in tables}


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A written table with its own columns, types and order: columns that became folders have neither
    type nor place in the files."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_tables(spark: SparkSession, root: str, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {n: read_table(spark, f"{root.rstrip('/')}/{n}", df.schema) for n, df in tables.items()}


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def truncate_texts(df: DataFrame, max_chars: int) -> DataFrame:
    return df.withColumns({c: truncate(F.col(c), max_chars) for c in text_columns(df)})


def truncation_counts(df: DataFrame, max_chars: int) -> DataFrame:
    """columna, recortados: texts longer than max_chars per text column."""
    columns = text_columns(df)
    if not columns:
        return df.sparkSession.createDataFrame([], "columna string, recortados long")
    counts = df.agg(*[F.count_if(F.length(c) > max_chars).alias(c) for c in columns])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("columna"), F.col(c).alias("recortados")) for c in columns])))


def export_extracts(tables: dict[str, DataFrame], root: str,
                    groups: dict[str, list[str]] = EXPORT_GROUPS,
                    max_rows: int = SHEET_MAX_ROWS, max_chars: int | None = None,
                    audit: Audit | None = None) -> dict[str, str]:
    """One CSV folder per table, with all its rows in files of at most max_rows; returns table -> folder.

    Texts are written whole unless max_chars is given; then every shortened column is an audit finding.
    A group without any table leaves no folder.
    """
    audit = audit or Audit()
    exported = {}
    for group, names in groups.items():
        for name in [n for n in names if n in tables]:
            df = tables[name]
            if max_chars is not None:
                for row in truncation_counts(df, max_chars).collect():
                    if row["recortados"]:
                        audit.finding(name, f"textos recortados en {row['columna']}", row["recortados"])
                df = truncate_texts(df, max_chars)
            path = f"{root.rstrip('/')}/{group}/{name}"
            with audit.timed("exportación", name):
                (df.write.mode("overwrite").option("maxRecordsPerFile", max_rows)
                 .csv(path, header=True, quote='"', escape='"', nullValue=""))
            exported[name] = path
    return exported


def verify(spark: SparkSession, expected: dict[str, int | Written], root: str,
           exported: dict[str, str] | None = None) -> DataFrame:
    """tabla, esperado, almacenado, exportado, ok. A table that is not there has a null count.

    Where the digest of the writing stage is given, ok needs equal content too, not only equal counts.
    """
    exported = exported or {}
    contents = {r["tabla"]: r["igual"] for r in verify_contents(
        spark, {n: w for n, w in expected.items() if isinstance(w, Written)}, root).collect()}
    records = []
    for name, wanted in expected.items():
        rows = wanted.rows if isinstance(wanted, Written) else wanted
        path = f"{root.rstrip('/')}/{name}"
        stored = spark.read.parquet(path).count() if path_exists(spark, path) else None
        extract = None
        if name in exported:
            extract = spark.read.csv(exported[name], header=True, multiLine=True,
                                     escape='"').count()
        ok = stored == rows and extract in (None, rows) and contents.get(name, True)
        records.append((name, rows, stored, extract, ok))
    return spark.createDataFrame(records, VERIFICATION_SCHEMA)


def verify_contents(spark: SparkSession, written: dict[str, Written], root: str) -> DataFrame:
    """tabla, escrito, leido, igual: the digest of what was written and of what is read back."""
    def record(name: str) -> tuple:
        table, path = written[name], f"{root.rstrip('/')}/{name}"
        found = None
        if path_exists(spark, path):
            back = read_table(spark, path, table.schema)
            found = back.agg(content_digest(back.columns).alias("digest")).first()["digest"]
        return name, table.digest, found, found == table.digest

    return spark.createDataFrame(at_once([partial(record, name) for name in written]), CONTENT_SCHEMA)


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str,
            extract_root: str | None = None, audit: Audit | None = None,
            write: Callable[[str, Audit | None], dict[str, Written]] | None = None) -> DataFrame:
    """Write, export (when extract_root is given) and verify; returns the verification table.

    write: how the tables are written, by default each in its layout.
    """
    written = write(root, audit) if write else write_tables(tables, root, audit)
    stored = read_tables(spark, root, tables)
    exported = export_extracts(stored, extract_root, audit=audit) if extract_root else {}
    report = verify(spark, written, root, exported)
    failing = [r["tabla"] for r in report.where("NOT ok").collect()]
    if failing:
        log.error("rows or content differ in %s", failing)
    return report


def write_json(df: DataFrame, path: str) -> None:
    """A small report as one JSON-lines file."""
    df.coalesce(1).write.mode("overwrite").json(path)
