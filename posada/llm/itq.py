"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

Fitting, on at most `SAMPLE` vectors: of vectors as similar as those that are looked for one is taken, so that a cluster
counts once however many rows it has. These are centred and turned onto their principal axes, then a rotation is learned that
brings them close to the corners of a cube, by turns of taking signs and solving for the best rotation. A bit is set above the
median of its axis, which balances the code. With too few vectors to learn from, rotations are random and planes pass through
the origin, where a bit of two vectors differs with a chance of their angle by pi, whatever the others are.

Codes are cut into substrings, one table each, as wide as the number of vectors asks for (`BITS` at least). Two vectors are
candidates if some substring differs in at most one bit; the full codes of candidates must agree up to a share of the bits,
and the original vectors decide. How many rotations are used, and that share, come from the sample: `PROBES` of its vectors are
compared with all others exactly, and rotations are added until `FOUND` of the pairs are candidates, after `LEARNED` of them
random ones through the origin, `MOST` at most.

Equal vectors of one label are one class from the start, counted and never compared with each other. A class has a number of
its own, so rows that share an id but not a vector are vectors of their own; `component_id` is the smallest id reached, and every
row that has it is kept. Only vectors of equal, known labels and equal length are compared; unusable vectors
(`vectors.usable`), and rows without id, link with nothing. An empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posada.llm.common import stage
from posada.llm.components import components
from posada.llm.vectors import matrix, usable

SAMPLE = 10_000
PROBES = 300
FOUND = 0.998
LEARNED, MOST = 4, 16
BITS, WIDEST = 16, 30
ITERATIONS = 30
RADIUS = 0.35
SIMILARITY = 0.93


def leaders(unit: np.ndarray, similarity: float) -> np.ndarray:
    """Vectors of which no two are as similar as that, and each other vector is to one of them."""
    taken, chosen = np.zeros(len(unit), bool), []
    for start in range(0, len(unit), 500):
        near = unit[start:start + 500] @ unit.T >= similarity
        for i in range(len(near)):
            if not taken[start + i]:
                chosen.append(start + i)
                taken |= near[i]
    return unit[chosen]


class Codes:
    """Learned codes for vectors of one length."""

    def __init__(self, sample: np.ndarray, size: int, similarity: float = SIMILARITY, width: int = BITS):
        self.width, self.planes, self.radius = width, [], RADIUS
        unit = np.unique(sample / np.linalg.norm(sample, axis=1, keepdims=True), axis=0) if len(sample) else np.empty((0, size))
        unit = unit[np.random.default_rng(0).permutation(len(unit))]
        apart = leaders(unit, similarity)
        probes = unit[:PROBES] @ unit.T >= similarity
        left, right = np.nonzero(probes)
        left, right = left[left != right], right[left != right]
        missed, differing = np.ones(len(left), bool), np.zeros(len(left))
        for start in range(MOST):
            learn = start < LEARNED and len(apart) > 2 * size
            self.planes.append(self._learned(apart, size, start) if learn else self._through_origin(size, start))
            found = self._one(unit, *self.planes[-1]) if len(unit) else np.empty((0, 0), np.int64)
            bits = np.bitwise_count(found[left] ^ found[right])
            missed &= (bits > 1).all(axis=1) if len(left) else missed
            differing += bits.sum(axis=1) / (found.shape[1] * width) if len(left) else 0
            if start and missed.sum() <= (1 - FOUND) * len(left) and (len(left) or len(unit) > 2 * size or start + 1 >= LEARNED):
                break
        if len(left):
            self.radius = max(RADIUS, float((differing / len(self.planes)).max()) + 0.05)

    def _bits(self, size: int) -> int:
        return -(-size // self.width) * self.width               # shorter vectors get further random axes

    def _learned(self, unit: np.ndarray, size: int, start: int) -> tuple:
        draw = np.random.default_rng(start)
        mean = unit.mean(0)
        centred = unit - mean
        principal = np.linalg.eigh(centred.T @ centred)[1][:, ::-1]
        rotation = np.linalg.qr(draw.standard_normal((size, size)))[0]
        turned = centred @ principal
        for _ in range(ITERATIONS):
            left, _, right = np.linalg.svd(np.sign(turned @ rotation).T @ turned)
            rotation = (left @ right).T
        axes = np.hstack([principal @ rotation, draw.standard_normal((size, self._bits(size) - size))])
        return mean, axes, np.median(centred @ axes, axis=0)

    def _through_origin(self, size: int, start: int) -> tuple:
        draw = np.random.default_rng(start)
        axes = np.hstack([np.linalg.qr(draw.standard_normal((size, size)))[0], draw.standard_normal((size, self._bits(size) - size))])
        return np.zeros(size), axes, np.zeros(axes.shape[1])

    def _one(self, unit: np.ndarray, mean, axes, medians) -> np.ndarray:
        bits = (unit - mean) @ axes > medians
        return (bits.reshape(len(unit), -1, self.width) * (1 << np.arange(self.width, dtype=np.int64))).sum(2)

    def substrings(self, vectors: np.ndarray) -> np.ndarray:
        """A row of numbers of `width` bits for each vector."""
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return np.hstack([self._one(unit, *p) for p in self.planes])


def fit(vectors: DataFrame, key: str, embedding: str, similarity: float = SIMILARITY, width: int = BITS) -> dict[int, Codes]:
    """Codes by vector length, from the usable vectors of lowest hashed key."""
    rows = vectors.where(usable(embedding)).orderBy(F.xxhash64(key), key).limit(SAMPLE).select(embedding).collect()
    by_size: dict[int, list] = {}
    for row in rows:
        by_size.setdefault(len(row[0]), []).append(row[0])
    return {size: Codes(np.array(held, np.float64), size, similarity, width) for size, held in by_size.items()}


def coded(classes: DataFrame, codes: dict[int, Codes], width: int = BITS) -> DataFrame:
    """id, label and substrings of each class, and how many bits of the whole code may differ."""
    sent = classes.sparkSession.sparkContext.broadcast(codes)     # a few matrices of the vectors' length squared

    def run(batches):
        known = dict(sent.value)
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size))
                if size not in known:
                    known[size] = Codes(np.empty((0, size)), size, width=width)
                found = known[size].substrings(matrix(part.column("embedding"), size))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("label"), part.column("size"), pa.array(found.tolist(), pa.list_(pa.int32())),
                     pa.array([int(found.shape[1] * width * known[size].radius)] * len(found), pa.int32())],
                    names=["id", "label", "size", "code", "radius"])

    kinds = {c: classes.schema[c].dataType.simpleString() for c in ("id", "label")}
    return classes.select("id", "label", "size", "embedding").mapInArrow(
        run, f"id {kinds['id']}, label {kinds['label']}, size int, code array<int>, radius int")


def candidates(codes: DataFrame, width: int = BITS) -> DataFrame:
    """Pairs (a, b), a < b, that share a substring up to one bit and agree in enough bits of the whole code."""
    one_bit = F.array(F.lit(0), *(F.lit(1 << i) for i in range(width)))
    rows = codes.select("id", "label", "size", "code", "radius", F.posexplode("code").alias("part", "value"))
    probes = rows.withColumn("flip", F.explode(one_bit)).withColumn("value", F.col("value").bitwiseXOR(F.col("flip"))).drop("flip")
    left, right = probes.alias("l"), rows.alias("r")
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("label", "size", "part", "value")]
    differing = F.aggregate(F.zip_with("l.code", "r.code", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return left.join(right, same).where(F.col("l.id") < F.col("r.id")) \
        .where(differing <= F.col("l.radius")) \
        .select(F.col("l.id").alias("a"), F.col("r.id").alias("b")).distinct()


def verified(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """Pairs whose original vectors have at least the similarity, cosine in double precision."""
    left = classes.select(F.col("id").alias("a"), F.col("embedding").alias("left"), "size")
    right = classes.select(F.col("id").alias("b"), F.col("embedding").alias("right"))
    kind = pairs.schema["a"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size))
                x, y = matrix(part.column("left"), size), matrix(part.column("right"), size)
                cosine = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(cosine)], names=["a", "b", "cosine"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right", "size") \
        .mapInArrow(run, f"a {kind}, b {kind}, cosine double").where(F.col("cosine") >= similarity)


def near_duplicate_vectors(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", label: str = "label",
                           similarity: float = SIMILARITY) -> DataFrame:
    """key, n_links, component_id and kept for each row of vectors."""
    held = stage(vectors.sparkSession)
    named = vectors.select(F.col(key).alias("id"), F.col(embedding).cast("array<double>").alias("embedding"), F.col(label).alias("label"),
                           usable(embedding).alias("fit")) \
        .withColumn("fit", F.col("fit") & F.col("label").isNotNull() & F.col("id").isNotNull()) \
        .withColumn("k1", F.xxhash64("embedding")).withColumn("k2", F.xxhash64(F.lit(1), "embedding", F.lit(2)))
    grouped = named.where("fit").groupBy("label", "k1", "k2").agg(
        F.min("id").alias("least"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    # Classes are ordered by their smallest id, so the smallest class that is reached names the component.
    numbered = grouped.withColumns({"size": F.size("embedding"), "id": F.struct("least", F.monotonically_increasing_id().alias("n"))})
    classes = held.put(numbered.drop("least"), "classes")
    width = min(WIDEST, max(BITS, classes.count().bit_length()))
    codes = fit(classes, "id", "embedding", similarity, width)
    pairs = held.put(candidates(held.put(coded(classes, codes, width), "codes"), width), "pairs")
    links = held.put(verified(pairs, classes, similarity), "links")
    parts = components(links, held, "parts")
    copies = classes.select(F.col("id").alias("b"), "copies")
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = both.join(copies, "b").groupBy("a").agg(F.sum("copies").alias("others"))
    found = classes.select("label", "k1", "k2", "id", "copies").join(parts, "id", "left") \
        .join(linked.withColumnRenamed("a", "id"), "id", "left") \
        .select("label", "k1", "k2", F.coalesce("component", "id").getField("least").alias("component_id"),
                (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.lit(True).alias("fit"))
    return named.select("id", "label", "k1", "k2", "fit").join(found, ["label", "k1", "k2", "fit"], "left") \
        .select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                F.coalesce("component_id", "id").alias("component_id")) \
        .withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
