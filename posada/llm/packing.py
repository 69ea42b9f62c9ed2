"""Packing of token pieces into sequences of at most `capacity` tokens, by a configuration linear program.

A configuration says how many pieces of each length share one sequence. The program asks for amounts of
configurations that together hold every piece and are as few as can be. Only the histogram of lengths goes to the
driver: at most `capacity` rows, whatever the input. Lengths that hold less than 1 / `GROUPS` of all tokens are put into
groups of neighbours, each counted as its longest, so that no rare length holds the program up. It is solved by
multiplicative weights: in each step a length's price is its size times a weight that falls with the share of it that is
covered already, a knapsack dynamic program finds the best fillings under these prices, each is given a small amount, and
the weights follow. Amounts are summed over the steps and rounded with the fraction carried on. A slot of a configuration
takes the longest piece that its own length and the slack before it allow, and what room is left is topped up.

What the rounding leaves is filled largest piece first, each time with the largest that fits. That plain filling is also
tried for all pieces, and taken if it needs fewer sequences: for many short lengths it is within 0.1 % of the bound, which
the groups miss by about as much.

Pieces of one length are alike to the plan, so each piece needs only its rank among those of its length. Ranks are
taken in `SLOTS` hashed parts of each length and shifted by the sizes of the parts before, so a length that holds a third of all
pieces is ranked by many tasks. The plan that tasks look places up in is bounded by the capacity, not by the data.

Null and empty texts are one piece: the end id. Only documents longer than the capacity are cut.
"""

import re
import unicodedata
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from posada.llm.byte_bpe import Cache
from posada.llm.common import slices, text_or_empty

CAPACITY = 4096
END_ID = 1
GROUPS = 64
STEPS = 400
SHARE = 0.05          # of a length, the most that one step covers
STRENGTH = 0.15       # a weight falls by exp(-STRENGTH) for each SHARE
SLACK = 0.02          # columns may be worth so much less than the best
SLOTS = 256
BATCH_BYTES = 8 << 20

# the splitting pattern of the vocabulary file (fixed value)
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_SEPARATORS = re.compile(r"[\x1c-\x1f]")
_CHUNKS = regex.compile(r"[^\p{White_Space}]+")
# byte-level vocabularies spell a byte as its Latin-1 character if that is visible, else as one of U+0100 on
_VISIBLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_SPELLING = {b: chr(0x100 + i) for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}


# --- tokens ---------------------------------------------------------------------------------------------------

class WordTokenizer:
    """A lower-casing vocabulary with word ends: its pre-tokens never hold white space, so a text's ids are those of
    its chunks between white space, one after the other. Both chunks and pre-tokens are cached."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.words = Cache(self._word, 300_000)
        self.chunks = Cache(self._chunk, 500_000)

    def _word(self, word: str) -> bytes:
        """One pre-token straight through the library's merges; bytes are spelt as the vocabulary spells them."""
        spelt = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(_SPELLING)
        return np.array([t.id for t in self.library.model.tokenize(spelt)], "<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if not chunk.isascii():
            chunk = unicodedata.normalize("NFC", chunk)
            if "Σ" in chunk:                                      # the library lower-cases letter by letter
                chunk = chunk.replace("Σ", "σ")
        chunk = chunk.lower()
        if chunk.isalpha():                                       # nearly all chunks are a word, or a word and a mark
            return self.words[chunk]
        if chunk[-1] in ".," and chunk[:-1].isalpha():
            return self.words[chunk[:-1]] + self.words[chunk[-1]]
        return b"".join(map(self.words.__getitem__, _PIECES.findall(chunk)))

    def packed(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if self.special and self.special.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        chunks = text.split() if not _SEPARATORS.search(text) else _CHUNKS.findall(text)
        return b"".join(map(self.chunks.__getitem__, chunks))


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def token_pieces(df: DataFrame, path: str, text: str = "text", keep=("doc_id",), capacity: int = CAPACITY,
                 end_id: int = END_ID, digest: bool = False) -> DataFrame:
    """A row for each piece of each document: the kept columns, piece, start, length, and ids (with digest: their
    CRC-32 as ids_crc32 instead, which spares moving them)."""
    made = [T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()) if digest else T.StructField("ids", T.ArrayType(T.IntegerType()))]
    taken = {f.name.lower() for f in made}
    kept = [c for c in keep if c.lower() not in taken]
    schema = T.StructType([df.schema[c] for c in kept] + made)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        tokenizer = word_tokenizer(path)
        for batch in slices(batches, BATCH_BYTES, "__text"):
            rows, piece, start, length, last = [], [], [], [], []
            for i, value in enumerate(batch.column("__text").to_pylist()):
                held = tokenizer.packed(value) + end
                for k, a in enumerate(range(0, len(held), 4 * capacity)):
                    part = held[a:a + 4 * capacity]
                    rows.append(i)
                    piece.append(k)
                    start.append(a // 4)
                    length.append(len(part) // 4)
                    last.append(zlib.crc32(part) if digest else np.frombuffer(part, "<i4"))
            source = batch.select(kept).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*source.columns, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(last, pa.int64() if digest else pa.list_(pa.int32()))], names=[*kept, *(f.name for f in made)])

    return df.select(*kept, text_or_empty(text).alias("__text")).mapInArrow(run, schema)


# --- the plan -------------------------------------------------------------------------------------------------

def knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each room up to the capacity the best value, and the length to take first (0: leave one token free).
    sizes: ascending; of lengths that are worth the same the largest is taken."""
    best, take = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    sizes, prices = sizes[::-1].copy(), prices[::-1].copy()
    first = np.searchsorted(-sizes, -np.arange(capacity + 1))
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        a = first[room]
        if a < len(sizes):
            values = best[room - sizes[a:]] + prices[a:]
            at = int(values.argmax())
            if values[at] > best[room]:
                best[room], take[room] = values[at], sizes[a + at]
    return best, take


def filling(take: np.ndarray, room: int) -> dict[int, int]:
    """Lengths and how often each, of the best way to fill a room."""
    out: dict[int, int] = {}
    while room > 0:
        length = int(take[room])
        if length:
            out[length] = out.get(length, 0) + 1
            room -= length
        else:
            room -= 1
    return out


def grouped(counts: np.ndarray) -> np.ndarray:
    """Counts with the rare lengths moved up to the longest of their group. The last, shortest ones that fill no group are
    left out; they top sequences up."""
    out, top, held = np.zeros_like(counts), 0, 0
    least = (counts * np.arange(len(counts))).sum() / GROUPS
    for length in np.flatnonzero(counts)[::-1].tolist():
        n = int(counts[length])
        if n * length >= least:
            out[length] += n
            continue
        top, held = top or length, held + n
        if held * top >= least:
            out[top] += held
            top, held = 0, 0
    return out


def cover(counts: np.ndarray, capacity: int, steps: int) -> dict[tuple[tuple[int, int], ...], float]:
    """Configurations, as (length, how often) from the longest on, with amounts that together cover the counts."""
    sizes = np.flatnonzero(counts)
    total, amounts = counts[sizes].astype(float), {}
    left, at_size = total.copy(), np.zeros(capacity + 1, np.int64)
    at_size[sizes] = np.arange(len(sizes))
    for _ in range(steps):
        gone, open_ = 1 - left / total, left > 1e-9 * total
        if not open_.any():
            break
        weights = np.exp(-STRENGTH / SHARE * (gone - gone[open_].min()))
        prices = np.where(open_, sizes * weights, 0.0)
        best, take = knapsack(sizes[open_], prices[open_], capacity)
        good = open_ & (prices + best[capacity - sizes] >= (1 - SLACK) * best[capacity])
        quota, used = np.minimum(left, SHARE * total), 0
        for at in np.lexsort((-sizes, gone)).tolist():             # least covered first
            if not good[at]:
                continue
            length = int(sizes[at])
            column = filling(take, capacity - length)
            column[length] = column.get(length, 0) + 1
            ks, ns = at_size[list(column)], np.array(list(column.values()))
            amount = float((quota[ks] / ns).min())
            if amount <= 1e-9:
                continue
            quota[ks] -= ns * amount
            left[ks] = np.maximum(0.0, left[ks] - ns * amount)
            key = tuple(sorted(column.items(), reverse=True))
            amounts[key] = amounts.get(key, 0.0) + amount
            used += 1
            if used == max(4, len(sizes) // 2):
                break
    return amounts


def realise(slots: list[int], times: int, left: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """`times` sequences by one configuration, with pieces that are left; these are taken off."""
    out, free = [], capacity - sum(slots)
    while times and (there := np.flatnonzero(left)).size:
        column, room, spare = {}, capacity, free

        def longest(limit: int) -> int:
            at = int(np.searchsorted(there, limit, side="right")) - 1
            while at >= 0 and left[there[at]] <= column.get(int(there[at]), 0):
                at -= 1
            return int(there[at]) if at >= 0 else 0

        for slot in slots:
            if not (length := longest(slot + spare)):
                break
            column[length] = column.get(length, 0) + 1
            spare, room = spare + slot - length, room - length
        while room > 0 and (length := longest(room)):
            n = min(room // length, int(left[length]) - column.get(length, 0))
            column[length], room = column.get(length, 0) + n, room - n * length
        n = min(times, *(int(left[k]) // m for k, m in column.items()))
        for k, m in column.items():
            left[k] -= m * n
        out.append((column, n))
        times -= n
    return out


def fill_rest(counts: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """The last pieces, largest first; each sequence is topped up with the largest pieces that fit."""
    left, out = counts.astype(np.int64).copy(), []
    while (there := np.flatnonzero(left)).size:
        column, room = {}, capacity
        while room > 0:
            fits = there[:np.searchsorted(there, room, side="right")]
            fits = fits[left[fits] > 0]
            if not fits.size:
                break
            length = int(fits[-1])
            n = min(int(left[length]), room // length)
            column[length], room = n, room - n * length
            left[length] -= n
        for k, n in column.items():
            left[k] += n
        times = min(int(left[k]) // n for k, n in column.items())
        for k, n in column.items():
            left[k] -= n * times
        out.append((column, times))
    return out


def covering_plan(counts: np.ndarray, capacity: int, steps: int) -> tuple[list[tuple[dict[int, int], int]], np.ndarray]:
    """Configurations of the program in whole amounts, and the counts that the rounding leaves."""
    left, out, carry = counts.astype(np.int64).copy(), [], 0.0
    for key, amount in sorted(cover(grouped(left), capacity, steps).items(), key=lambda x: (-x[1], x[0])):
        carry += amount
        times = int(carry + 1e-6)
        carry -= times
        out += realise([k for k, n in key for _ in range(n)], times, left, capacity)
    return out, left


def plan(counts: np.ndarray, capacity: int = CAPACITY, steps: int = STEPS) -> list[tuple[dict[int, int], int]]:
    """Configurations and whole amounts that hold exactly counts[l] pieces of each length l."""
    columns, left = covering_plan(counts, capacity, steps)
    return min(columns + fill_rest(left, capacity), fill_rest(counts, capacity), key=lambda x: sum(n for _, n in x))


class Places:
    """Where the piece of a given length and rank goes. Arrays by (length, first rank)."""

    def __init__(self, columns: list[tuple[dict[int, int], int]], capacity: int):
        rows, sequence, ranks = [], 0, np.zeros(capacity + 1, np.int64)
        for column, times in columns:
            offset = 0
            for length in sorted(column, reverse=True):
                n = column[length]
                rows.append((length, int(ranks[length]), n, sequence, offset))
                ranks[length] += n * times
                offset += n * length
            sequence += times
        self.sequences = sequence
        rows.sort()
        self.rows = np.array(rows, np.int64).reshape(-1, 5)
        self.first = np.searchsorted(self.rows[:, 0], np.arange(capacity + 2))

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.empty(len(lengths), np.int64)
        order = np.argsort(lengths, kind="stable")
        edges = np.flatnonzero(np.diff(lengths[order])) + 1
        for part in np.split(order, edges):
            if len(part):
                a, b = self.first[lengths[part[0]]], self.first[lengths[part[0]] + 1]
                at[part] = a + np.searchsorted(self.rows[a:b, 1], ranks[part], side="right") - 1
        _, start, copies, sequence, offset = self.rows[at].T
        within = ranks - start
        return sequence + within // copies, offset + within % copies * lengths


# --- on Spark -------------------------------------------------------------------------------------------------

def pack(pieces: DataFrame, order: list[str], length: str = "length", capacity: int = CAPACITY, steps: int = STEPS) -> DataFrame:
    """Adds sequence_id and offset. pieces should be a written table: it is read for the histogram, the part sizes and
    the places. order: columns that tell the pieces of one length apart; rows that agree in all of them may swap places."""
    spark = pieces.sparkSession
    pieces = pieces.select(*[c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")])
    slotted = pieces.withColumn("__slot", F.pmod(F.xxhash64(*order), F.lit(SLOTS)).cast("int"))
    histogram = slotted.groupBy(length).count().collect()          # at most `capacity` rows
    counts = np.zeros(capacity + 1, np.int64)
    for row in histogram:
        if row[0] is None or not 0 < row[0] <= capacity:
            raise ValueError(f"piece of {row[0]} tokens does not fit into {capacity}")
        counts[row[0]] = row[1]
    sent = spark.sparkContext.broadcast(Places(plan(counts, capacity, steps), capacity))
    sizes = slotted.groupBy(length, "__slot").count() \
        .withColumn("__before", F.sum("count").over(Window.partitionBy(length).orderBy("__slot")) - F.col("count")) \
        .select(length, "__slot", "__before")
    ranked = slotted.withColumn("__within", F.row_number().over(
        Window.partitionBy(length, "__slot").orderBy(*order)) - 1)
    placed = ranked.join(sizes, [length, "__slot"]).withColumn("__rank", F.col("__before") + F.col("__within"))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def find(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        sequence, offset = sent.value.find(lengths.to_numpy(np.int64), ranks.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return placed.withColumn("__place", find(F.col(length).cast("bigint"), F.col("__rank"))) \
        .select(*pieces.columns, "__place.sequence_id", "__place.offset")
