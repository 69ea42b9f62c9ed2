"""The shared folder of sessions that were started without one."""

import atexit
import functools
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from posada.staging import configured_folder


def set_folder(spark: SparkSession) -> None:
    """For a local session without a checkpoint folder, one of its own; a cluster must name one."""
    if configured_folder(spark) is None and spark.sparkContext.master.startswith("local["):
        folder = tempfile.mkdtemp(prefix="posada-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)


def with_folder(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        set_folder(spark)
        return query(spark, sf_dir)
    return run
