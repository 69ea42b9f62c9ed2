"""Exact duplicates of texts by a stateful stream, with DataFrame functions only.

Two texts are equal when they are identical after deleting every character of `[\\x20\\x09-\\x0D]`. A file stream reads the documents
and keeps one state row for each digest of such a text, on disk (RocksDB) and without expiry: how many rows had it, the key of
the row that stays, and where that row's content lies (file and row in the file). Rows meet their state after a map-side
aggregation, so a group with a third of all rows sends one row for each task. State and progress lie in a folder: files that
arrive later are read against the state kept there, earlier ones never again.

The state is read back as a table. Rows find their group in it by digest: groups above a thousandth of all rows, fewer than
1000, are broadcast, the others joined by shuffle. Digests alone decide nothing: for every digest that several rows share, the
smallest and the largest text are compared byte by byte, which tells whether all are identical. If they are not, the rows of that
digest are grouped by their texts. Texts without a shared digest take no part in the comparison, but for those that
agree with one in the first five hex digits.

Of equal texts the row with the most code points in its original text stays, then the smallest key (null last), then the first in
order of file and row. A null text is an empty one. Rows that repeat a key are rows of their own. An empty table gives an empty
result. Other columns are not read.
"""

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from posada.staging import Stage

WHITE = " \t\n\x0b\x0c\r"
_STATE = "spark.sql.streaming.stateStore"
#: State on disk; without room reserved ahead, which is 4 MB for each state partition however few rows it has.
_SETTINGS = {f"{_STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
             f"{_STATE}.rocksdb.allowFAllocate": "false"}
FREQUENT_SHARE = 1000
FILES_PER_BATCH = 100_000


def normal(text: str) -> Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), WHITE, "")


def sha256(body: Column) -> Column:
    return F.sha2(body, 256)


def located(documents: DataFrame, key: str, text: str, digest=sha256) -> DataFrame:
    """key, body (the text without white space), digest, and what the choice among equal texts goes by."""
    return documents.select(
        F.col(key).alias("key"), normal(text).alias("body"), F.length(F.coalesce(F.col(text), F.lit(""))).alias("length"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")) \
        .withColumn("digest", digest(F.col("body")))


def _best() -> Column:
    """The row that stays: the smallest of these."""
    return F.min(F.struct((-F.col("length")).alias("less"), F.col("key").isNull().alias("unnamed"), "key", "file", "row"))


@contextmanager
def state_settings(spark: SparkSession):
    """Settings under which state is written and read; those of the session come back afterwards."""
    before = {name: spark.conf.get(name, None) for name in _SETTINGS}
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def absorb(spark: SparkSession, path: str, folder: str, key: str, text: str, digest=sha256, files_per_batch: int = FILES_PER_BATCH) -> None:
    """Read the files of a Parquet table that the state in folder has not seen yet, and end."""
    path = path.rstrip("/")
    table = spark.read.parquet(path)
    # A pattern that only this path matches: the source takes a single file as well as a folder then.
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{path[:-1]}[{path[-1]}]")
    groups = located(stream, key, text, digest).groupBy("digest").agg(_best().alias("best"), F.count(F.lit(1)).alias("n"))
    with state_settings(spark):
        groups.writeStream.format("noop").outputMode("update").option("checkpointLocation", folder) \
            .trigger(availableNow=True).start().awaitTermination()


def registry(spark: SparkSession, folder: str) -> DataFrame:
    """The state: digest, keep_key, keep_file, keep_row and group_size for each digest."""
    best = "value.min"
    return spark.read.format("statestore").load(folder).select(
        "key.digest", F.col(f"{best}.key").alias("keep_key"), F.col(f"{best}.file").alias("keep_file"),
        F.col(f"{best}.row").alias("keep_row"), F.col("value.count").alias("group_size"))


def clashing(texts: DataFrame, groups: DataFrame) -> DataFrame:
    """Digests that different texts share."""
    start = F.conv(F.substring("digest", 1, 5), 16, 10).cast("int").alias("start")          # 2 ** 20 values at most
    shared = F.broadcast(groups.where("group_size > 1").select(start).distinct())
    return texts.select("digest", "body", start).join(shared, "start", "left_semi") \
        .groupBy("digest").agg(F.min("body").alias("least"), F.max("body").alias("most")) \
        .where("least <> most").select("digest")


def find_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """rows with the columns of their group."""
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    frequent = F.col("group_size") * FREQUENT_SHARE > total
    large = F.broadcast(groups.where(frequent))                                             # fewer than FREQUENT_SHARE rows
    return rows.join(large, "digest").unionByName(
        rows.join(large.select("digest"), "digest", "left_anti").join(groups.where(~frequent), "digest"))


def deduplicate(spark: SparkSession, path: str, held: Stage, key: str = "doc_id", text: str = "text", digest=sha256,
                files_per_batch: int = FILES_PER_BATCH, folder: str | None = None) -> DataFrame:
    """key, digest, keep_key, keep_file, keep_row, group_size and kept for each row of the Parquet table at path.

    folder: where state and progress are kept between calls; by default a new one."""
    folder = folder or held.path("state")
    absorb(spark, path, folder, key, text, digest, files_per_batch)
    with state_settings(spark):
        groups = held.put(registry(spark, folder), "registry")
    texts = located(spark.read.parquet(path), key, text, digest)
    rows = held.put(texts.select("key", "digest", "file", "row"), "rows")
    mixed = held.put(clashing(texts, groups), "clashing")
    found = find_groups(rows, groups)
    if not mixed.isEmpty():
        by_text = texts.join(mixed, "digest")
        apart = by_text.groupBy("digest", "body").agg(_best().alias("best"), F.count(F.lit(1)).alias("group_size"))
        exact = by_text.join(apart, ["digest", "body"]).select(
            "digest", "key", "file", "row", F.col("best.key").alias("keep_key"), F.col("best.file").alias("keep_file"),
            F.col("best.row").alias("keep_row"), "group_size")
        found = find_groups(rows, groups).join(mixed, "digest", "left_anti").unionByName(exact)
    kept = (F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))
    return found.select(F.col("key").alias(key), "digest", "keep_key", "keep_file", "keep_row", "group_size", kept.alias("kept"))
