"""Nearest neighbours with a hash-prefix forest.

Vectors are dealt into shards of about `SHARD` rows by hashed key, so that equal vectors, however many, are dealt apart. Each
shard holds `TREES` trees: a tree hashes a vector to a string of 64 bits (its side of 64 planes through
the shard's mean, each square to the line between two random rows) and keeps the strings in a sorted array. A query descends to the longest prefix that it shares with each tree, then
all trees ascend together, one bit at a time, until the rows under the common prefixes are at least `SHARE` of the shard.
Those rows are ranked by exact distance, and the best of all shards are merged.

Queries are a stated set and go to every shard in blocks of `BLOCK`; a task holds one shard and one block. Distances are
Euclidean, in double precision, on the original vectors; equal distances go by smaller key. Unusable vectors
(`vectors.usable`) and rows without a key take no part; vectors are compared with those of their own length only.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from posada.llm.vectors import usable

SHARD = 2_000
BLOCK = 2_000
TREES = 16
SHARE = 0.75
_DEPTH = 64


class Forest:
    """The trees of one shard."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, seed: int = 0):
        draw = np.random.default_rng(seed)
        self.mean = vectors.mean(0)
        a, b = draw.integers(0, len(vectors), (2, trees * _DEPTH))
        self.planes = (vectors[a] - vectors[b]).reshape(trees, _DEPTH, -1).transpose(0, 2, 1)
        self.orders, self.sorted = [], []
        for strings in self.strings(vectors):
            order = np.argsort(strings, kind="stable")
            self.orders.append(order)
            self.sorted.append(strings[order])

    def strings(self, vectors: np.ndarray) -> list[np.ndarray]:
        """The hash string of each vector in each tree, first bit on top."""
        powers = np.uint64(1) << np.arange(_DEPTH - 1, -1, -1, dtype=np.uint64)
        centred = vectors - self.mean
        return [((centred @ p > 0) * powers).sum(1, dtype=np.uint64) for p in self.planes]

    def candidates(self, queries: np.ndarray, least: int):
        """For each query the rows under the deepest common prefix length at which there are enough."""
        strings, n = self.strings(queries), len(queries)
        low = np.zeros((len(strings), n), np.int64)
        high = np.tile(np.array([[len(s)] for s in self.sorted], np.int64), (1, n))
        open_ = np.arange(n)
        for depth in range(_DEPTH, 0, -1):
            tail = np.uint64((1 << (_DEPTH - depth)) - 1)
            found = [(np.searchsorted(s, q[open_] & ~tail, "left"), np.searchsorted(s, q[open_] | tail, "right"))
                     for s, q in zip(self.sorted, strings)]
            enough = np.zeros(len(open_), bool)
            reach = sum(b - a for a, b in found)
            for i in np.flatnonzero(reach >= least).tolist():     # the same row may be found by several trees
                rows = np.unique(np.concatenate([o[a[i]:b[i]] for o, (a, b) in zip(self.orders, found)]))
                if len(rows) >= least:
                    enough[i] = True
                    for t, (a, b) in enumerate(found):
                        low[t, open_[i]], high[t, open_[i]] = a[i], b[i]
            open_ = open_[~enough]
            if not open_.size:
                break
        for i in range(n):
            yield np.unique(np.concatenate([o[low[t, i]:high[t, i]] for t, o in enumerate(self.orders)]))


def nearest_in_shard(keys: np.ndarray, vectors: np.ndarray, query_keys: np.ndarray, queries: np.ndarray, k: int,
                     trees: int = TREES, share: float = SHARE) -> list[tuple]:
    forest, least = Forest(vectors, trees), max(k + 1, int(np.ceil(share * len(vectors))))
    out = []
    for i, rows in enumerate(forest.candidates(queries, least)):
        rows = rows[keys[rows] != query_keys[i]]
        distance = np.sqrt(((vectors[rows] - queries[i]) ** 2).sum(1))
        best = np.lexsort((keys[rows], distance))[:k]
        out += [(query_keys[i], keys[r], d) for r, d in zip(rows[best].tolist(), distance[best].tolist())]
    return out


def nearest(vectors: DataFrame, queries: F.Column, k: int = 10, key: str = "vec_id", embedding: str = "embedding",
            trees: int = TREES, share: float = SHARE) -> DataFrame:
    """query_id, rank from 1, vec_id and score (distance) of the k nearest rows to each row where `queries` holds."""
    used = vectors.where(usable(embedding) & F.col(key).isNotNull()) \
        .select(F.col(key).cast("bigint").alias("key"), F.col(embedding).cast("array<double>").alias("v"), queries.alias("asks"))
    n, asked = used.agg(F.count("*"), F.count_if("asks")).first()
    shards, blocks = max(1, round(n / SHARD)), max(1, -(-asked // BLOCK))
    rows = used.select("key", "v", F.size("v").alias("size"), F.pmod(F.xxhash64("key", F.lit(1)), F.lit(shards)).alias("shard")) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    wanted = used.where("asks").dropDuplicates(["key"]) \
        .select("key", "v", F.size("v").alias("size"), F.pmod(F.xxhash64("key", F.lit(2)), F.lit(blocks)).cast("int").alias("block")) \
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<bigint>")))

    def search(held: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(held) and len(asks):
            found = nearest_in_shard(held["key"].to_numpy(np.int64), np.array(held["v"].tolist(), np.float64),
                                     asks["key"].to_numpy(np.int64), np.array(asks["v"].tolist(), np.float64), k, trees, share)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    cell = ["size", "shard", "block"]
    best = rows.groupBy(*cell).cogroup(wanted.groupBy(*cell)).applyInPandas(search, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
