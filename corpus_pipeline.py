"""The corpus pipeline: toxic documents go, one document of each group of near copies stays, repeated passages are cut,
and what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir), reads what the stage before has written, and returns a DataFrame. All but the last
return the columns of documents. Rows without a doc_id pass the deduplicating stages as they are; rows that share a doc_id
are one document, of which the near-duplicate stage keeps one row. Null texts count as empty.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from posada.llm import chunks, probminhash, toxicity
from posada.llm.common import stage
from posada.llm.queries import packed, toxicity_model

#: No SQL can express the stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    scored = toxicity.score(docs.withColumn("__row", F.struct(*docs.columns)), toxicity_model(spark, docs, sf_dir), keep=["__row"])
    return scored.where("predicted = 0").select("__row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of each group of near copies."""
    gone = probminhash.near_duplicates(docs, "doc_id").where(~F.col("kept")).select("doc_id").distinct()
    one_row = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    with_id = docs.where("doc_id IS NOT NULL").join(gone, "doc_id", "left_anti") \
        .withColumn("__row", F.row_number().over(one_row)).where("__row = 1").select(*docs.columns)
    return with_id.unionByName(docs.where("doc_id IS NULL"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that another place holds already."""
    cut = chunks.remove_repeats(docs, "doc_id")
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document, with its place in a sequence."""
    return packed(spark, docs)


STAGES = [("toxicity", drop_toxic), ("near duplicates", drop_near_duplicates), ("repeated passages", cut_repeats),
          ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each over what the one before has written."""
    held = stage(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, apply) in enumerate(STAGES):
        docs = held.put(apply(spark, docs, sf_dir), f"stage-{i}")
    return docs
