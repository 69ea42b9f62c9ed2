"""Near-duplicate documents by ProbMinHash signatures, bands and exact verification.

Texts are sequences of words (ASCII white space apart, A-Z in lower case); a shingle is five words, or all words of a
shorter text. A shingle that occurs n times weighs 1 + ln n. Each shingle sends arrivals of a Poisson process whose rate is
its weight to random places of the signature; a place keeps the shingle that arrives first. Two signatures agree in a
place with the probability Jaccard similarity of the weighted shingle sets. A text's shingles stop as soon as their next
arrival is later than the latest place, so most of them send one arrival.

Steps: texts of the same words are one class from the start (digest, pre-aggregated). Signatures are cut into `BANDS` bands of
`ROWS` places. Within a band value, first all members are compared with the smallest (a star, not all pairs), found links
are joined to components, and then only members that are in different components are compared, pair by pair, unless bitmaps of their
shingles rule the pair out. So a large group of near copies costs a star, and no link between components is lost. Each candidate pair is verified: the plain Jaccard similarity
of the two shingle sets must be at least `SIMILARITY`.

Null, empty and white-space texts have no shingles and are kept, each on its own.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posada.llm.common import MIX_1, MIX_2, MIX_3, mix, slices, stage, text_or_empty, utf8
from posada.llm.components import components
from posada.staging import Stage

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
WORDS = 16
BATCH_BYTES = 2 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = mix(np.arange(256, dtype=np.uint64) + np.uint64(1 << 32))
_STEP = np.uint64(0xD1342543DE82EF95)


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word and the text that it belongs to. The hash sums the numbers of the bytes, each times a power
    by its place in the word."""
    n = len(data)
    solid = ~_SPACE[data]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    first = ends[:-1][ends[:-1] < n]
    begin[first] = solid[first]
    starts = np.flatnonzero(begin)
    if not starts.size:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    number = np.cumsum(begin) - 1
    place = np.arange(n) - starts[np.maximum(number, 0)]
    longest = int(place[solid].max()) + 1
    with np.errstate(over="ignore"):
        powers = np.multiply.accumulate(np.full(longest, _STEP, np.uint64))
        value = np.where(solid, _BYTE[_LOWER[data]] * powers[np.minimum(place, longest - 1)], np.uint64(0))
        return mix(np.add.reduceat(value, starts)), np.searchsorted(ends, starts, side="right") - 1


def shingles(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes by text: (text, hash, count), ordered by text and hash."""
    words, text = word_hashes(data, ends)
    counts = np.bincount(text, minlength=len(ends) - 1) if len(text) else np.zeros(len(ends) - 1, np.int64)
    with np.errstate(over="ignore"):
        rolled, n = np.zeros(len(words), np.uint64), len(words)
        for k in range(SHINGLE):
            near = np.zeros(n, np.uint64)
            near[:max(0, n - k)] = words[k:]
            near[np.append(text[k:], np.full(min(k, n), -1)) != text] = np.uint64(0)
            rolled = mix(rolled * MIX_2 + near)
    first = np.cumsum(counts) - counts
    place = np.arange(len(words)) - first[text] if len(words) else np.empty(0, np.int64)
    whole = (place + SHINGLE <= counts[text]) | (place == 0) if len(words) else np.empty(0, bool)
    text, rolled = text[whole], rolled[whole]
    order = np.lexsort((rolled, text))
    text, rolled = text[order], rolled[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (rolled[1:] != rolled[:-1])
    at = np.flatnonzero(new)
    return text[at], rolled[at], np.diff(np.append(at, len(text)))


def signatures(text: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n: int, places: int) -> np.ndarray:
    """n signatures of shingle hashes; rows of texts without shingles are 0."""
    out, least = np.zeros(n * places, np.uint64), np.full(n * places, np.inf)
    now, active, round_ = np.zeros(len(text)), np.arange(len(text)), 0
    while active.size:
        with np.errstate(over="ignore"):
            random = mix(hashes[active] ^ (np.uint64(round_) * MIX_1 + MIX_3))
            other = mix(random + MIX_2)
        uniform = ((random >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
        now[active] += -np.log(uniform) / weights[active]
        at = text[active] * places + (other % np.uint64(places)).astype(np.int64)
        time = now[active]
        np.minimum.at(least, at, time)
        won = least[at] == time
        out[at[won]] = hashes[active[won]]
        latest = least.reshape(n, places).max(1)
        active = active[time < latest[text[active]]]              # later arrivals come later still
        round_ += 1
    return out.reshape(n, places)


def band_values(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        value = np.zeros(signature.shape[:1] + (bands,), np.uint64)
        for r in range(rows):
            value = mix(value * MIX_2 + signature[:, r::rows][:, :bands])
        return mix(value + np.arange(bands, dtype=np.uint64) * MIX_1).view(np.int64)


def sketch(df: DataFrame, key: str, text: str, bands: int, rows: int) -> DataFrame:
    """Key, words digest (null without words) and band values of each text."""
    def run(batches):
        for batch in slices(batches, BATCH_BYTES, "__text"):
            data, ends = utf8(batch.column("__text"))
            words, of = word_hashes(data, ends)
            edges = np.searchsorted(of, np.arange(len(ends))).tolist()
            held = words.tobytes()
            digest = [xxhash.xxh3_128_digest(held[8 * a:8 * b]) if b > a else None for a, b in zip(edges, edges[1:])]
            owner, hashes, counts = shingles(data, ends)
            found = band_values(signatures(owner, hashes, 1 + np.log(counts), len(batch), bands * rows), bands, rows)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(batch) * bands + 1, bands), pa.int32()),
                                             pa.array(found.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("__key"), pa.array(digest, pa.binary()), lists],
                                             names=["key", "digest", "bands"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("__key"), text_or_empty(text).alias("__text")).mapInArrow(
        run, f"key {kind}, digest binary, bands array<bigint>")


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    owner, hashes, _ = shingles(*utf8(texts))
    edges = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
    return [hashes[a:b] for a, b in zip(edges, edges[1:])]


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) with the plain Jaccard similarity of their shingle sets, where it is high enough.
    texts: one row (id, text) for each id."""
    with_a = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    with_both = with_a.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    kind = pairs.schema["a"].dataType.simpleString()

    def run(batches):
        for batch in slices(batches, BATCH_BYTES, "text_a"):
            left, right = shingle_sets(batch.column("text_a")), shingle_sets(batch.column("text_b"))
            found = []
            for x, y in zip(left, right):
                both = len(np.intersect1d(x, y, assume_unique=True))
                found.append(both / max(1, len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found, pa.float64())],
                                             names=["a", "b", "similarity"])

    return with_both.select("a", "b", "text_a", "text_b").mapInArrow(run, f"a {kind}, b {kind}, similarity double") \
        .where(F.col("similarity") >= similarity)


def bitmaps(texts: DataFrame) -> DataFrame:
    """(id, n, bits, w0, w1, ...): the number of a text's shingles, a bit for each hash value that some shingle has, and their number."""
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in slices(batches, BATCH_BYTES, "text"):
            owner, hashes, _ = shingles(*utf8(batch.column("text")))
            bits = np.zeros((len(batch), 64 * WORDS), bool)
            bits[owner, (hashes % np.uint64(64 * WORDS)).astype(np.int64)] = True
            held = np.packbits(bits, axis=1).view(np.int64)
            n = np.bincount(owner, minlength=len(batch)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n), pa.array(bits.sum(1).astype(np.int64)),
                                              *(pa.array(held[:, i].copy()) for i in range(WORDS))],
                                             names=["id", "n", "bits", *(f"w{i}" for i in range(WORDS))])

    return texts.select("id", "text").mapInArrow(run, f"id {kind}, n bigint, bits bigint, " + ", ".join(f"w{i} bigint" for i in range(WORDS)))


def can_be_similar(left: str, right: str, similarity: float) -> F.Column:
    """False for pairs that cannot reach the similarity: a bit that only one text has stands for a shingle that only it has."""
    common = F.expr(" + ".join(f"bit_count({left}.w{i} & {right}.w{i})" for i in range(WORDS)))
    most = F.least(*(F.col(f"{x}.n") - F.col(f"{x}.bits") for x in (left, right))) + common
    return most * (1 + similarity) >= (F.col(f"{left}.n") + F.col(f"{right}.n")) * similarity - 1e-6


def links(buckets: DataFrame, texts: DataFrame, similarity: float, held: Stage) -> DataFrame:
    """(id, component) of all ids with a link. buckets: (band, value, id), one row for each member of a band value.

    Three rounds of candidates: every member with the smallest one of its band value; where a band value then still holds
    several components, every other member with one of the last component; and then all pairs of members in different
    components, but for those whose bitmaps tell that they cannot be similar."""
    shared = buckets.groupBy("band", "value").agg(F.count("*").alias("n"), F.min("id").alias("least")).where("n > 1")
    members = held.put(buckets.join(shared.select("band", "value", "least"), ["band", "value"])
                       .select("band", "value", "id", "least"), "members")
    pairs = members.where("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()
    found = held.put(verified(pairs, texts, similarity), "links-0")
    rest = members.select("band", "value", "id")
    for k in (1, 2):
        parts = held.put(components(found, held, f"parts-{k}"), f"components-{k}")
        placed = rest.select("band", "value", "id").join(parts, "id", "left") \
            .withColumn("part", F.coalesce("component", "id")).drop("component")
        # only band values whose members are not all in one component
        open_ = placed.groupBy("band", "value").agg(F.min("part").alias("low"), F.max("part").alias("high")) \
            .where("low <> high").select("band", "value")
        rest = held.put(placed.join(open_, ["band", "value"]).select("band", "value", "id", "part"), f"rest-{k}")
        known = bitmaps(texts.join(rest.select("id").distinct(), "id", "left_semi"))
        known = held.put(rest.join(known, "id"), f"known-{k}")
        left, right = known.alias("l"), known.alias("r")
        if k == 1:
            last = known.groupBy("band", "value").agg(F.max(F.struct("part", "id")).alias("last")) \
                .select("band", "value", "last.id")
            right = known.join(last, ["band", "value", "id"]).alias("r")
        order = F.lit(True) if k == 1 else F.col("l.id") < F.col("r.id")
        candidates = left.join(right, (F.col("l.band") == F.col("r.band")) & (F.col("l.value") == F.col("r.value")) & order
                               & (F.col("l.part") != F.col("r.part")) & can_be_similar("l", "r", similarity)) \
            .select(F.least("l.id", "r.id").alias("a"), F.greatest("l.id", "r.id").alias("b")).distinct()
        found = found.unionByName(held.put(verified(candidates, texts, similarity), f"links-{k}"))
    return components(found, held, "parts-last")


def near_duplicates(df: DataFrame, key: str, text: str = "text", similarity: float = SIMILARITY, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """One row for each row of df that has a key: key, class_id (the smallest key of its group of near copies, itself
    included), copies (rows of the same words), kept (it is the one that stays). Rows without a key are left out."""
    held = stage(df.sparkSession)
    source = df.where(F.col(key).isNotNull())
    sketched = held.put(sketch(source, key, text, bands, rows), "sketch")
    classes = held.put(sketched.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("key").alias("id"), F.count("*").alias("copies")), "classes")
    # the bands of one member of each class: equal words have equal bands
    one = sketched.where("digest IS NOT NULL").select("digest", F.col("key").alias("id"), "bands") \
        .join(classes, ["digest", "id"], "left_semi").dropDuplicates(["id"])
    buckets = one.select("id", F.posexplode("bands").alias("band", "value"))
    wanted = held.put(buckets, "buckets")
    texts = source.select(F.col(key).alias("id"), text_or_empty(text).alias("text"))
    shared = wanted.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1")
    involved = wanted.join(shared, ["band", "value"], "left_semi").select("id").distinct()
    texts = held.put(texts.join(involved, "id", "left_semi").groupBy("id").agg(F.min("text").alias("text")), "texts")
    parts = links(wanted, texts, similarity, held)
    named = classes.join(parts, "id", "left").select("digest", "copies", F.coalesce("component", "id").alias("class_id"))
    joined = sketched.select("key", "digest").join(named, "digest", "left")
    return joined.select(F.col("key").alias(key), F.coalesce("class_id", "key").alias("class_id"),
                         F.coalesce("copies", F.lit(1)).cast("bigint").alias("copies")) \
        .withColumn("kept", F.col(key) == F.col("class_id"))
