"""Token counts of whole texts under a byte-level BPE of the tokenizers library, without moving any pre-token.

Two tiers on the map side. First, a compact table of the lengths (in tokens) of frequent pre-tokens, broadcast: it is
counted on a bounded sample of the texts (the first `TASK_TEXTS` of each of `SAMPLE_TASKS` tasks, which read no further and
send `TASK_PIECES` pre-tokens at most) and holds `FREQUENT` entries at most, whatever the input. No text and no pre-token is shuffled.
Second, a cache in each worker for pre-tokens outside the table, which the library encodes when first met. Both only
save work; every text is counted whole. Special strings inside texts count as the library counts them, one token each.

Null and empty texts have 0 bytes and 0 tokens. Columns named like a new one give way to it.
"""

import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from posada.llm.byte_bpe import Cache
from posada.llm.common import map_texts, slices, text_or_empty, utf8
from posada.llm.scan import splitter

SAMPLE_TASKS, TASK_TEXTS, TASK_PIECES = 32, 64, 5_000
FREQUENT = 50_000
BATCH_BYTES = 4 << 20


@lru_cache(maxsize=2)
def load(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def special_strings(path: str) -> re.Pattern | None:
    """What the library takes for a special token wherever it stands in a text."""
    found = [t.content for t in load(path).get_added_tokens_decoder().values()]
    return re.compile("|".join(map(re.escape, sorted(found, key=len, reverse=True)))) if found else None


def length(path: str, piece: bytes) -> int:
    return len(load(path).encode(piece.decode("utf-8", "replace"), add_special_tokens=False).ids)


class Frequent:
    """Lengths of frequent pre-tokens: their bytes end to end, and one byte of length each (compact to send)."""

    def __init__(self, path: str, counts: Counter):
        pieces = [p for p, _ in counts.most_common(FREQUENT) if len(p) < 256]
        found = [(p, length(path, p)) for p in pieces]
        self.path, self.held = path, b"".join(p for p, _ in found)
        self.sizes = np.array([len(p) for p, _ in found], np.uint8)
        self.lengths = np.array([n for _, n in found], np.uint8)

    def table(self) -> dict[bytes, int]:
        ends = np.cumsum(self.sizes, dtype=np.int64).tolist()
        return {self.held[e - n:e]: k for e, n, k in zip(ends, self.sizes.tolist(), self.lengths.tolist())}


class Lengths(Cache):
    """The worker's side: the broadcast table first, then what the worker has met."""

    def __init__(self, frequent: Frequent):
        super().__init__(lambda piece: length(frequent.path, piece))
        self.table = frequent.table()

    def __missing__(self, piece):
        found = self.table.get(piece)
        return super().__missing__(piece) if found is None else found


_workers: dict[int, Lengths] = {}


def _lengths(sent) -> Lengths:
    """One cache for each broadcast table and worker process."""
    if sent.value is not None and id(sent.value) not in _workers:
        _workers.clear()
        _workers[id(sent.value)] = Lengths(sent.value)
    return _workers[id(sent.value)]


def sample_counts(df: DataFrame, text: str) -> Counter:
    """Pre-tokens of SAMPLE_TASKS * TASK_TEXTS texts at most, each task's TASK_PIECES most frequent ones."""
    def count(batches):
        found, left = Counter(), TASK_TEXTS
        if TaskContext.get().partitionId() >= SAMPLE_TASKS:
            return
        for batch in slices(batches, BATCH_BYTES, "__text"):
            data, ends = utf8(batch.slice(0, left).column("__text"))
            starts, stops, _ = splitter(True).split(data, ends)
            held = data.tobytes()
            found.update([held[a:b] for a, b in zip(starts.tolist(), stops.tolist())])
            left -= min(left, batch.num_rows)
            if not left:
                break
        top = found.most_common(TASK_PIECES)
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.binary()),
                                          pa.array([n for _, n in top], pa.int64())], names=["piece", "n"])

    total = Counter()
    for row in df.select(text_or_empty(text).alias("__text")).mapInArrow(count, "piece binary, n bigint").collect():
        total[bytes(row["piece"])] += row["n"]
    return total


def count_batch(column: pa.Array, path: str, known) -> list[tuple[int, int]]:
    """Bytes and tokens of each text."""
    data, ends = utf8(column)
    special, held = special_strings(path), data.tobytes()
    sizes = np.diff(ends).tolist()
    mixed = {}
    if special and special.search(held.decode("utf-8", "replace")):
        for i, value in enumerate(column.to_pylist()):
            if value and (parts := special.split(value))[1:]:
                mixed[i] = len(parts) - 1 + sum(n for _, n in count_batch(pa.array(parts), path, known))
    starts, stops, first = splitter(True).split(data, ends)
    lengths = [known[held[a:b]] for a, b in zip(starts.tolist(), stops.tolist())]
    sums = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
    counts = (sums[first[1:]] - sums[first[:-1]]).tolist()
    return [(sizes[i], mixed.get(i, counts[i])) for i in range(len(sizes))]


def token_counts(df: DataFrame, path: str, text: str = "text", limit: int = 1024, keep: list[str] | None = None) -> DataFrame:
    """Adds n_bytes, n_tokens and over_limit (n_tokens > limit)."""
    spark = df.sparkSession
    sent = spark.sparkContext.broadcast(Frequent(path, sample_counts(df, text)))
    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    kept = [c for c in (keep or df.columns) if c.lower() != "over_limit"]
    return map_texts(df, text, fields, lambda column: count_batch(column, path, _lengths(sent)), BATCH_BYTES, kept) \
        .withColumn("over_limit", F.col("n_tokens") > limit)
