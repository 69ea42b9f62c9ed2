"""Substring deduplication by content-defined chunks.

A gear hash rolls over the UTF-8 bytes of a text: h = 2 h + gear[byte], cut to the last `GEAR` bytes. A place is a border
where the hash is the smallest of some `REACH` places in a row and the border before it is at least `SHORT` bytes away.
Both depend on the bytes nearby only, so text that is inserted or removed shifts none but the borders near it. Borders move
back to the begin of a UTF-8 character. In periodic text, where hashes repeat, the smallest place modulo `TURN` counts.

The variable chunks between borders are deduplicated by their digest. The first occurrence of a digest, by smallest key and then place, stays.
Others are repeats; chunks that touch and that lie as far from their first occurrence make a run, and each run is extended at
both ends, by `LEAST` bytes at most, by comparing its bytes with those of the first occurrence. Runs of at least `LEAST` bytes
count; those that touch make a span, which is reported or cut out. Shorter repeats are ordinary phrases and stay, and so do
fewer than `SHORT` bytes that a run adds to a longer one (two texts go on with the same letters behind a passage by chance).
A repeat is missed only if no whole chunk lies in it, or if each of its chunks occurs still earlier elsewhere.
Where a text repeats itself with overlap (periodic text), its first period stays and the run of chunks behind it goes.

The rows of one digest are pre-aggregated before their shuffle, and the join back is one that Spark splits when skewed, so
a passage that a third of all documents share does not meet in one task. Its bytes are read once for all its copies.
Null and empty texts have no chunks and come back as they are, and so do rows without a key. Rows that share a key count
as one document that stands first.
"""

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from posada.llm.common import mix, slices, stage, text_or_empty, utf8

GEAR = 16
REACH = 40
SHORT = 12
TURN = 32
LEAST = 120
BATCH_BYTES = 4 << 20


@lru_cache(maxsize=1)
def gear() -> np.ndarray:
    """One random number for each byte value."""
    return (mix(np.arange(256, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def sliding(values: np.ndarray, size: int, least) -> np.ndarray:
    """The least (or, by np.maximum, greatest) of each `size` values in a row."""
    width = 1
    while 2 * width <= size:
        values, width = least(values[:-width], values[width:]), 2 * width
    return least(values[:len(values) - size + width], values[size - width:]) if size > width else values


def borders(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Byte offsets where chunks begin or end, for texts laid end to end; includes all ends."""
    n = len(data)
    if not n:
        return np.unique(ends)
    h, width = gear()[data], 1
    while width < GEAR:                            # the window doubles: h(i, 2w) = h(i, w) + 2^w h(i - w, w)
        more = h.copy()
        more[width:] += h[:-width] << np.uint32(width)
        h, width = more, 2 * width
    place = np.arange(n) - np.repeat(ends[:-1], np.diff(ends))
    order = (h.astype(np.uint64) << np.uint64(8)) | (place % TURN).astype(np.uint64)
    never = np.uint64((1 << 64) - 1)
    order[place < GEAR - 1] = never                # the hash must lie within the text
    pad = np.full(REACH - 1, never)
    least = sliding(np.concatenate([pad, order, pad]), REACH, np.minimum)
    cuts = np.flatnonzero((sliding(least, REACH, np.maximum) == order) & (order != never)) + 1
    cuts = cuts[np.diff(cuts, prepend=-SHORT) >= SHORT]
    for _ in range(3):                             # not inside a character
        inside = (cuts < n) & ((data[np.minimum(cuts, n - 1)] & 0xC0) == 0x80)
        if not inside.any():
            break
        cuts = cuts - inside
    return np.union1d(cuts, ends)


def chunked(data: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """A row for each chunk: text, start, size, digest, and whether the same bytes are a chunk further ahead in the same text."""
    cuts, held = borders(data, ends), data.tobytes()
    starts, stops = cuts[:-1], cuts[1:]
    text = np.searchsorted(ends, stops, side="left") - 1
    digest = np.array([xxhash.xxh3_64_intdigest(held[a:b]) for a, b in zip(starts.tolist(), stops.tolist())], np.uint64).view(np.int64)
    order = np.lexsort((starts, digest, text))
    again = np.zeros(len(starts), bool)
    again[order[1:]] = (text[order[1:]] == text[order[:-1]]) & (digest[order[1:]] == digest[order[:-1]])
    return {"text": text, "start": starts - ends[text], "size": (stops - starts).astype(np.int32), "digest": digest, "again": again}


def chunk_table(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The chunks of all texts that have a key, with the key in place of the text."""
    def run(batches):
        for batch in slices(batches, BATCH_BYTES, "__text"):
            found = chunked(*utf8(batch.column("__text")))
            keys = batch.column("__key").take(pa.array(found.pop("text")))
            yield pa.RecordBatch.from_arrays([keys, *map(pa.array, found.values())], names=["key", *found])

    kind = df.schema[key].dataType.simpleString()
    return keyed(df, key, text).mapInArrow(run, f"key {kind}, start bigint, size int, digest bigint, again boolean")


def keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).select(F.col(key).alias("__key"), text_or_empty(text).alias("__text"))


def shared(one: bytes, other: bytes) -> int:
    """How many bytes at the begin are the same."""
    n = min(len(one), len(other))
    return next((i for i in range(n) if one[i] != other[i]), n)


def extended(data: bytes, found: list[dict], least: int, edge: int) -> list[tuple]:
    """Spans (start, end, chunks, first) of one text from its runs, each with the bytes around its first occurrence."""
    grown = []
    for x in found:
        a, b = x["a"], x["b"]
        room = max(0, x["delta"] - (b - a)) if x["own"] else 2 * edge    # the first occurrence itself stays
        left = min(room, shared(data[max(0, a - edge):a][::-1], (x["before"] or b"")[::-1]))
        right = min(room - left, shared(data[b:b + edge], x["after"] or b""))
        a, b = a - left, b + right
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if b - a >= least:
            grown.append((a, b, x["chunks"], x["first"]))
    out, begin = [], 0
    for a, b, n, first in sorted(grown, key=lambda x: x[:2]):
        if not out or a > out[-1][1]:
            out.append((a, b, n, first))
            begin = a
            continue
        start, end, held, least_first = out[-1]
        if b - end >= SHORT:
            start, end = a if a - begin < SHORT and b - a > end - start else start, b
        out[-1] = (start, end, held + n, min(first, least_first))
    return out


def repeated_spans(df: DataFrame, key: str, text: str = "text", least: int = LEAST) -> DataFrame:
    """Spans that repeat an earlier place: key, start and end in bytes, chunks (that agree), and first_key, the
    smallest key of those that hold a part of the span first."""
    held, edge = stage(df.sparkSession), max(least, LEAST)
    kind, documents = df.schema[key].dataType.simpleString(), keyed(df, key, text)
    chunks = chunk_table(df, key, text)
    repeated = chunks.groupBy("digest").agg(
        F.min("key").alias("first"), F.min_by(F.col("start"), F.when(~F.col("again"), F.col("key"))).alias("first_start"),
        F.count("*").alias("n")).where("n > 1").select("digest", "first", "first_start")
    marked = chunks.join(repeated, "digest").where(F.col("again") | (F.col("key") != F.col("first"))) \
        .withColumn("delta", F.col("start") - F.col("first_start"))
    in_row = Window.partitionBy("key", "first", "delta").orderBy("start")
    found = held.put(marked.withColumn("gap", F.coalesce(F.col("start") > F.lag(F.col("start") + F.col("size")).over(in_row), F.lit(True)))
                     .withColumn("island", F.sum(F.col("gap").cast("int")).over(in_row))
                     .groupBy("key", "first", "delta", "island")
                     .agg(F.min("start").alias("a"), F.max(F.col("start") + F.col("size")).alias("b"), F.count("*").alias("chunks"))
                     .drop("island").withColumn("fa", F.col("a") - F.col("delta")).withColumn("fb", F.col("b") - F.col("delta")), "runs")

    def around(batches):
        for batch in batches:
            rows = []
            for name, value, places in zip(*(batch.column(c).to_pylist() for c in ("__key", "__text", "places"))):
                data = value.encode()
                rows += [(name, p["fa"], p["fb"], data[max(0, p["fa"] - edge):p["fa"]], data[p["fb"]:p["fb"] + edge]) for p in places]
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [batch.column("__key").type, pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["first", "fa", "fb", "before", "after"])

    places = found.select("first", "fa", "fb").distinct().groupBy(F.col("first").alias("__key")) \
        .agg(F.collect_list(F.struct("fa", "fb")).alias("places"))
    edges = documents.join(places, "__key").mapInArrow(around, f"first {kind}, fa bigint, fb bigint, before binary, after binary") \
        .dropDuplicates(["first", "fa", "fb"])

    def grow(batches):
        for batch in batches:
            rows = []
            for name, value, own in zip(*(batch.column(c).to_pylist() for c in ("__key", "__text", "own"))):
                rows += [(name, *x) for x in extended(value.encode(), own, least, edge)]
            columns = list(zip(*rows)) or [[]] * 5
            name = batch.column("__key").type
            kinds = [name, pa.int64(), pa.int64(), pa.int64(), name]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                             names=["key", "start", "end", "chunks", "first_key"])

    own = found.join(edges, ["first", "fa", "fb"], "left").withColumn("own", F.col("key") == F.col("first")) \
        .groupBy(F.col("key").alias("__key")) \
        .agg(F.collect_list(F.struct("a", "b", "delta", "chunks", "first", "own", "before", "after")).alias("own"))
    return documents.join(own, "__key").mapInArrow(
        grow, f"key {kind}, start bigint, end bigint, chunks bigint, first_key {kind}").dropDuplicates() \
        .select(F.col("key").alias(key), "start", "end", "chunks", "first_key")


def cut_out(texts: pa.Array, spans: pa.Array) -> list[str | None]:
    """Texts without their spans of bytes; spans: "start-end" joined by blanks."""
    out = []
    for value, held in zip(texts.to_pylist(), spans.to_pylist()):
        if value is None or not held:
            out.append(value)
            continue
        data, last, parts = value.encode(), 0, []
        for a, b in sorted(tuple(map(int, s.split("-"))) for s in held.split(" ")):
            parts.append(data[last:a])
            last = max(last, b)
        out.append(b"".join([*parts, data[last:]]).decode("utf-8", "replace"))
    return out


def remove_repeats(df: DataFrame, key: str, text: str = "text", least: int = LEAST) -> DataFrame:
    """df with the repeated spans cut out of the text; all rows and other columns stay."""
    held = stage(df.sparkSession).put(repeated_spans(df, key, text, least), "spans")
    spans = held.groupBy(F.col(key).alias("__key")).agg(
        F.array_join(F.collect_list(F.concat_ws("-", "start", "end")), " ").alias("__spans"))
    joined = df.join(spans, df[key].eqNullSafe(spans["__key"]), "left").drop("__key")

    columns = df.columns

    def run(batches):
        for batch in batches:
            cut = pa.array(cut_out(batch.column(text), batch.column("__spans")), pa.string())
            yield pa.RecordBatch.from_arrays([cut if c == text else batch.column(c) for c in columns], names=columns)

    return joined.mapInArrow(run, df.schema)
