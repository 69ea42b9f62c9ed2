"""Registered queries of the corpus operators: each applies one to its whole table."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posada.llm import (byte_bpe, chunks, exact_dedup, forest, itq, licenses, merkle, packing, probminhash, resampling, token_counts,
                        toxicity, warc)
from posada.llm.common import stage, table

#: Labels of this fold (CRC-32 of the id as text, modulo 4) are never learned from.
HELD_OUT = 2


def fold(key: str = "doc_id") -> F.Column:
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4))


def toxicity_model(spark: SparkSession, documents: DataFrame, sf_dir: str) -> toxicity.Model:
    return toxicity.fit(documents, table(spark, sf_dir, "labels"), fold() != HELD_OUT)


def op1_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = stage(spark)
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), held)
    return warc.read_archives(manifest, held, payload=False) \
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                     keep=["doc_id"])


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity_model(spark, documents, sf_dir), keep=["doc_id"]) \
        .select("doc_id", F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"), "score", "predicted")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(spark, table(spark, sf_dir, "documents"))


def packed(spark: SparkSession, documents: DataFrame) -> DataFrame:
    pieces = packing.token_pieces(documents, public_tokenizers.path("word_bpe_49k.json"), digest=True)
    return packing.pack(stage(spark).put(pieces, "pieces"), ["doc_id", "piece", "start", "ids_crc32"])


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op6_near_duplicate_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op7_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.repeated_spans(table(spark, sf_dir, "documents"), "doc_id") \
        .withColumnRenamed("first_key", "first_doc_id")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(table(spark, sf_dir, "documents"), "doc_id")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.round_trip_digests(table(spark, sf_dir, "documents"), path, keep=["doc_id"])


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, fields = table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    claimed = F.when(tampered, merkle.leaf_digest([lowered if f == "text" else F.col(f) for f in fields]))
    proved = merkle.manifest(documents, stage(spark), "doc_id", "source", fields, claimed)
    path = F.array_join(F.zip_with("lefts", "rights", lambda x, y: F.concat(x, y)), "")
    return proved.select("doc_id", "leaf", "subroot", "root", F.sha2(path, 256).alias("proof_sha256"), "folded_root", "verified")


def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), stage(spark))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.deduplicate(spark, f"{sf_dir}/documents.parquet", stage(spark))
    return found.select("doc_id", F.col("keep_key").alias("keep_id"), "group_size", "kept", F.col("digest").alias("text_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_warc_archives, op2_token_counts, op3_toxicity, op4_best_fit_packing, op5_license_scan, op6_near_duplicate_vectors,
    op7_nearest_vectors, op8_repeated_spans, op9_near_duplicates, op10_byte_bpe, op11_merkle_manifest, op12_target_resampling,
    op13_exact_dedup)}
