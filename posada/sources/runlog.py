"""Run-log lines as data."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posada.fixed_values import LOG_FRAGMENTS, RUN_START
from posada.functions.text import holds

# A path with a drive is shortened to its last folder and the file.
_DRIVE_PATH = r"[A-Za-z]:\\(?:[^\\|]+\\)*([^\\|]+\\[^\\|]+)"
_LINE = r"^(.*?) \| (.*?) \| (.*?) \| (.*)$"


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """pos, value: pos orders the lines of all files (file, block of the file, line of the block)."""
    lines = spark.read.text(path)
    pos = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
                   F.monotonically_increasing_id().alias("line"))
    return lines.select(pos.alias("pos"), "value")


def parse_log(lines: DataFrame) -> DataFrame:
    """pos, momento, nivel, origen, mensaje; lines of another shape give nulls."""
    parts = {name: F.nullif(F.regexp_extract("value", _LINE, i), F.lit(""))
             for i, name in enumerate(("momento", "nivel", "origen", "mensaje"), start=1)}
    return lines.select("pos", *[part.alias(name) for name, part in parts.items()])


def log_excerpt(lines: DataFrame, max_lines: int = 48) -> DataFrame:
    """Telling lines of the last run: the first max_lines - 1 and always the last one.

    Without a run start the whole log counts as one run.
    """
    last_start = lines.where(holds(F.col("value"), RUN_START)).agg(F.max("pos")).scalar()
    in_run = lines.where(F.coalesce(F.col("pos") >= last_start, F.lit(True)))
    telling = F.col("value").rlike("|".join(LOG_FRAGMENTS))
    chosen = in_run.where(telling).select(
        "pos", F.regexp_replace("value", _DRIVE_PATH, "$1").alias("value"))
    head = chosen.orderBy("pos").limit(max_lines - 1)
    tail = chosen.orderBy(F.desc("pos")).limit(1)
    return head.union(tail).distinct().orderBy("pos")
