"""Byte-level BPE, encoding and decoding, from a rank file.

Texts are cut by the vectorised splitter of `scan`; each slice goes through cached pair merging. Row-wise: no
shuffle. A worker keeps two generations of at most `CACHE` slices; what it forgets is merged again.
Null and empty texts have no tokens. Very long slices are merged with a heap, so cost grows as n log n.
Output columns are added to the given ones; a column of such a name that is already there is replaced.
"""

import base64
import hashlib
import heapq
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from posada.llm.common import map_texts, utf8
from posada.llm.scan import splitter

CACHE = 400_000
SHORT = 48
BATCH_BYTES = 4 << 20


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def vocabulary(path: str) -> list[bytes]:
    """Bytes of each id."""
    ranks = load_ranks(path)
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Ids of one slice: the adjacent pair of lowest rank is joined, the leftmost first, until none is left."""
    whole = ranks.get(piece)
    if whole is not None:
        return (whole,)
    return merge_short(piece, ranks) if len(piece) <= SHORT else merge_long(piece, ranks)


def merge_short(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    none, get = len(ranks) + 256, ranks.get
    parts = [piece[i:i + 1] for i in range(len(piece))]
    joint = [get(piece[i:i + 2], none) for i in range(len(piece) - 1)] + [none]
    while (least := min(joint)) != none:
        i = joint.index(least)
        parts[i] += parts.pop(i + 1)
        del joint[i + 1]
        joint[i] = get(parts[i] + parts[i + 1], none) if i + 1 < len(parts) else none
        if i:
            joint[i - 1] = get(parts[i - 1] + parts[i], none)
    return tuple([ranks[x] for x in parts])


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The same with a heap of pairs and a linked list of parts."""
    n = len(piece)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))     # of the part that begins at i
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if middle in (-1, n) or end[middle] != stop:                # one of the two parts has changed
            continue
        end[i], end[middle] = stop, -1
        if stop < n:
            before[stop] = i
            rank = ranks.get(piece[i:end[stop]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[stop]))
        if before[i] >= 0:
            rank = ranks.get(piece[before[i]:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, before[i], stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return tuple(out)


class Cache(dict):
    """Results for the slices that this worker has met, in two generations of `size` entries: when the young one
    is full it becomes the old one, and what is asked for again moves back."""

    def __init__(self, make, size: int = CACHE, longest: int = 64):
        super().__init__()
        self.make, self.size, self.longest, self.old = make, size, longest, {}

    def __missing__(self, piece):
        found = self.old.get(piece)
        if found is None:
            found = self.make(piece)
            if len(piece) > self.longest:
                return found
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[piece] = found
        return found


@lru_cache(maxsize=2)
def worker_cache(path: str) -> Cache:
    ranks = load_ranks(path)
    return Cache(lambda piece: merge(piece, ranks))


def encode_texts(column: pa.Array, path: str) -> list[tuple[list[int], list[int]]]:
    """For each text its ids, and for each slice of it the number of ids up to its end."""
    data, ends = utf8(column)
    starts, stops, first = splitter(True).split(data, ends)
    held, known = data.tobytes(), worker_cache(path)
    ids = [known[held[a:b]] for a, b in zip(starts.tolist(), stops.tolist())]
    edges = first.tolist()
    out = []
    for a, b in zip(edges, edges[1:]):
        mine = ids[a:b]
        out.append((list(chain.from_iterable(mine)), np.cumsum([len(x) for x in mine]).tolist()))
    return out


def decode_ids(ids, path: str) -> bytes:
    return b"".join(map(vocabulary(path).__getitem__, ids))


def _added(df: DataFrame, text: str, fields: list[T.StructField], path: str, row, keep=None) -> DataFrame:
    return map_texts(df, text, fields, lambda column: [row(ids, edges, path) for ids, edges in
                                                       encode_texts(column, path)], BATCH_BYTES, keep)


def _ids_row(ids, edges, path):
    return ids, edges


def encode(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Adds `ids`, and `slice_ends`: how many ids lie before the end of each pre-token, for decoding any slice."""
    return _added(df, text, [T.StructField("ids", T.ArrayType(T.IntegerType())),
                             T.StructField("slice_ends", T.ArrayType(T.IntegerType()))], path, _ids_row)


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Adds `decoded`: the bytes of the ids; null ids decode to no bytes."""
    kept = [c for c in df.columns if c.lower() != "decoded"]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField("decoded", T.BinaryType())])

    def run(batches):
        for batch in batches:
            found = [decode_ids(x or [], path) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.select(kept).columns, pa.array(found, pa.binary())],
                                             names=[*kept, "decoded"])

    return df.select(*kept).mapInArrow(run, schema)


@lru_cache(maxsize=2)
def decimals(path: str) -> list[str]:
    return [str(i) for i in range(len(vocabulary(path)))]


def _digest_row(ids, edges, path):
    numbers = " ".join(map(decimals(path).__getitem__, ids)).encode()
    return len(ids), hashlib.sha256(numbers).hexdigest(), hashlib.sha256(decode_ids(ids, path)).hexdigest()


def round_trip_digests(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds `n_tokens`, `ids_sha256` (of the decimal ids joined by blanks) and `decoded_sha256`, in one pass."""
    return _added(df, text, [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                             T.StructField("decoded_sha256", T.StringType())], path, _digest_row, keep)
