"""Intermediate tables that cut lineage and survive the loss of executors."""

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_SETTING = "spark.checkpoint.dir"
_AT_ONCE = 3

T = TypeVar("T")


def at_once(tasks: list[Callable[[], T]]) -> list[T]:
    """Results of independent actions in order. A few are submitted side by side, so that the last tasks of one
    stage and the planning of the next do not leave the other cores idle."""
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        return [f.result() for f in [pool.submit(task) for task in tasks]]


def configured_folder(spark: SparkSession) -> str | None:
    """The shared folder that the session names, by its setting or by setCheckpointDir."""
    return spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING) \
        or spark.sparkContext.getCheckpointDir()


def staging_folder(spark: SparkSession) -> str:
    folder = configured_folder(spark)
    if not folder:
        raise RuntimeError(f"set {_SETTING} to a folder that every executor can reach")
    return folder


def path_exists(spark: SparkSession, path: str) -> bool:
    """True for a file, a folder or a pattern that matches something."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, on whatever file system it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in system.listStatus(target)) \
        if system.exists(target) else []


class Stage:
    """A private folder under the staging folder; tables written there are read back as Parquet."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{staging_folder(spark).rstrip('/')}/posada-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def put(self, df: DataFrame, name: str, dictionary: bool = True) -> DataFrame:
        """Write once, read many: later readers only scan the columns they use. dictionary: False for wide rows of
        mostly different values, for which dictionaries take a third of the writing and are given up anyway."""
        writer = df.write.mode("overwrite")
        (writer if dictionary else writer.option("parquet.enable.dictionary", "false")).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def put_measured(self, df: DataFrame, name: str, measures: dict[str, Column],
                     carried: list[str] | None = None, dictionary: bool = True) -> tuple[DataFrame, dict]:
        """As put, with aggregates taken by the writing stage itself; `carried` columns are only for
        them and are not written. There is no exchange above the aggregates: a range exchange would read
        its input twice, and they would count twice."""
        seen = Observation()
        staged = self.put(df.observe(seen, *[c.alias(n) for n, c in measures.items()])
                          .drop(*(carried or [])), name, dictionary)
        return staged, seen.get

    def close(self) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)

    def __enter__(self) -> "Stage":
        return self

    def __exit__(self, *_) -> None:
        self.close()
