"""Drawing documents that resemble a target set: hashed n-gram weights, Gumbel noise, and an exact cut-off by bisection.

Words are runs of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` after A-Z have become lower-case; the features of a text are its runs of 1 to 3
consecutive words, each counted in one of `BUCKETS` buckets by CRC-32. A first pass counts the buckets of all texts (each task
sends one row for each bucket at most), the gains of the buckets, one small array, are then looked up by the tasks that score
each text. The CRC of a longer run is that of the shorter one carried on, so no run is ever built.

Scores are written once. Counting jobs over them find the score of the last row drawn, and, among rows of that score, its key:
each job counts at the `THRESHOLDS` places which the next bisection steps can ask for. Only the rows drawn are sorted,
by ranges. Nothing but counts comes to the driver.

Null and empty texts have no features and weight 0. Keys are integers; a null key is drawn as an empty one and stands last among
equal scores. Rows that share score and key are drawn in order of their number of features, else in any order, but
exactly as many as wanted. An empty table, or a share that comes to no row, gives no ranks. Of the table only key
and text are read, so further columns may have any name.
"""

import math
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from posada.llm.common import map_texts, slices, text_or_empty, utf8
from posada.llm.ranks import numbered
from posada.staging import Stage

BUCKETS = 10_000
LONGEST = 3
THRESHOLDS = 15
BLOCK_BYTES = 1 << 20
_BATCH_BYTES = 4 << 20

_WORD_BYTE = re.compile(rb"[0-9a-z\x80-\xff]")
_FOLD = bytes(b if _WORD_BYTE.match(bytes([b])) else 32 for b in bytes(range(256)).lower())


def runs(text: bytes):
    """(words, checksums of all runs of words that end there) for each block of a text in UTF-8."""
    text, at = text.translate(_FOLD), 0
    before: list[int] = []                         # checksums of the runs of 1, 2, ... words that end at the block's border
    while at < len(text):
        end = text.find(b" ", at + BLOCK_BYTES) if len(text) > at + BLOCK_BYTES else -1
        words = text[at:end if end >= 0 else len(text)].split()
        at = end if end >= 0 else len(text)
        if not words:
            continue
        spaced = [b" " + w for w in words]
        found = [list(map(crc32, words))]
        for n in range(1, LONGEST):
            # A run of n + 1 words carries on the run of n words that ends at the word before.
            carried = before[n - 1:n] + found[-1][:-1]
            found.append(list(map(crc32, spaced[len(spaced) - len(carried):], carried)))
        before = [f[-1] for f in found if f]
        yield len(words), np.array([c for f in found for c in f], np.int64)


def bucket_counts(table: DataFrame, text: str) -> np.ndarray:
    """How many features of all texts fall in each bucket."""
    def count(batches):
        held = np.zeros(BUCKETS, np.int64)
        for part in slices(batches, _BATCH_BYTES):
            for data in texts_of(part.column("text")):
                for _, sums in runs(data):
                    held += np.bincount(sums % BUCKETS, minlength=BUCKETS)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(held[used])], names=["bucket", "n"])

    rows = table.select(text_or_empty(text).alias("text")).mapInArrow(count, "bucket int, n bigint") \
        .groupBy("bucket").agg(F.sum("n").alias("n")).collect()             # BUCKETS rows at most
    counts = np.zeros(BUCKETS, np.int64)
    for row in rows:
        counts[row["bucket"]] = row["n"]
    return counts


def texts_of(column: pa.Array):
    data, ends = utf8(column)
    held = data.tobytes()
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        yield held[a:b]


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """How much likelier a feature of each bucket is in the target, in thousandths of a nat, rounded down."""
    all_source, all_target = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_source / ((s + 1.0) * all_target)))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weighted(table: DataFrame, text: str, gain: np.ndarray, keep: list[str]) -> DataFrame:
    """keep..., n_words, n_features and weight of each row."""
    sent = table.sparkSession.sparkContext.broadcast(gain)

    def rows(column):
        for data in texts_of(column):
            words = features = weight = 0
            for count, sums in runs(data):
                words, features = words + count, features + len(sums)
                weight += int(sent.value[sums % BUCKETS].sum())
            yield words, features, weight

    fields = [T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]
    return map_texts(table, text, fields, rows, _BATCH_BYTES, keep)


def noise(key: str, seed: int) -> F.Column:
    """Gumbel noise of a key, in thousandths, rounded down."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def _bisect(rows: DataFrame, passes, low: int, high: int, wanted: int) -> tuple[int, int]:
    """The largest number x from low to high whose passes(x) holds for `wanted` rows at least, and how many rows pass at x + 1.
    passes holds for fewer rows as x grows, for enough of them at low, and for too few above high."""
    high, above = high + 1, 0
    while high - low > 1:
        tried = sorted({low + (high - low) * i // (THRESHOLDS + 1) for i in range(1, THRESHOLDS + 1)} - {low})
        counts = rows.agg(*[F.count_if(passes(x)) for x in tried]).first()
        for x, n in zip(tried, counts):
            if n >= wanted:
                low = x
            else:
                high, above = x, n
                break
    return low, above


def drawn(scored: DataFrame, key: str, wanted: int) -> F.Column:
    """A condition for the `wanted` rows of highest score, ties to smaller keys, plus rows equal to the last one in both."""
    if wanted <= 0:
        return F.lit(False)
    low, high = scored.agg(F.min("score"), F.max("score")).first()
    cut, above = _bisect(scored, lambda x: F.col("score") >= x, low, high, wanted)
    tied, missing = scored.where(F.col("score") == cut), wanted - above
    known, least, most = tied.agg(F.count(key), F.min(key), F.max(key)).first()
    if known < missing:
        return F.col("score") >= cut
    # Keys are bisected downwards: the smallest one up to which enough of the tied rows lie.
    last, _ = _bisect(tied, lambda x: F.col(key) <= -x, -most, -least, missing)
    return (F.col("score") > cut) | ((F.col("score") == cut) & F.coalesce(F.col(key) <= -last, F.lit(False)))


def resample(table: DataFrame, target: DataFrame, held: Stage, key: str = "doc_id", text: str = "text", share: tuple[int, int] = (5, 100),
             least_words: int = 20, seed: int = 42) -> DataFrame:
    """key, n_words, n_features, weight, score and rank (null where not drawn) of each row.

    Of the rows with least_words words at least, share[0] of share[1] are drawn, rounded down."""
    gain = gains(bucket_counts(table, text), bucket_counts(target, text))
    named = table.select(F.col(key).alias("__key"), F.col(text).alias("__body"))
    scored = held.put(weighted(named, "__body", gain, ["__key"]).withColumnRenamed("__key", key)
                      .withColumns({"score": F.col("weight") + noise(key, seed), "__row": F.monotonically_increasing_id()}), "scored")
    able = scored.where(F.col("n_words") >= least_words)
    wanted = able.count() * share[0] // share[1]
    chosen = (F.col("n_words") >= least_words) & drawn(able, key, wanted)
    order = [F.col("score").desc(), F.col(key).asc_nulls_last(), "n_features", "__row"]
    ranked = numbered(scored.where(chosen), held, "drawn", [], order) \
        .withColumn("rank", F.when(F.col("place") < wanted, F.col("place") + 1)).drop("place", "total")
    rest = scored.where(~chosen).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).drop("__row")
