"""Toxicity by compression distance: which of two zstandard dictionaries shortens the windows of a text more.

Fitting, on a bounded sample of labelled texts (at most `TOXIC_TEXTS` and `ORDINARY_TEXTS`, those of lowest hashed id,
so the choice is the same in every run):
* the ordinary dictionary is trained on stretches of ordinary text and topped with its frequent words;
* the toxic dictionary knows ordinary language too, and is trained besides on the words that set toxic texts apart.
  Words are counted by different neighbours, not by texts, so that copies and shared passages count once; a word
  counts if its log-likelihood ratio against ordinary text is at least `CONTRAST`.
Scoring: a window is one word between two fixed marks that both dictionaries know (compressors do not look for matches
in the last bytes of a block). Its distance is the compressed length under the ordinary dictionary less that under the
toxic one. Windows are spelt with three bytes for each byte, so that a byte without a match costs about as much as a match.
How many windows of a text reach each of several distances, as counts and shares, goes into a logistic
calibration fitted on the same sample; it gives the score from 0 to 1.

Distances are cached by word in each worker. Row-wise apart from fitting: no shuffle of texts. Null and empty texts are
scored as texts without any match. Without toxic or without ordinary labels nothing can be learned and all scores are 0.
"""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from posada.llm.byte_bpe import Cache
from posada.llm.common import map_texts, text_or_empty

TOXIC_TEXTS, ORDINARY_TEXTS = 1_000, 2_000
CONTRAST = 12.0
DICTIONARY_BYTES = 100_000
STRETCH_WORDS, STRETCHES = 8, 30_000
DISTANCES = (1, 2, 3, 4, 6, 8, 10)
THRESHOLD = 0.3
BATCH_BYTES = 8 << 20
WORD = re.compile(r"[^\W\d_]+")
_MARK = b"=window= "
_SPELT = [bytes((b, (b * 37 + 101) % 256, (b * 74 + 202) % 256)) for b in range(256)]


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def spell(held: bytes) -> bytes:
    return b"".join([_SPELT[b] for b in held])


def contexts(texts: list[list[str]]) -> Counter:
    """For each word the smaller number of its different left and right neighbours."""
    pairs = set()
    for w in texts:
        pairs.update(zip(["", *w], [*w, ""]))
    left, right = Counter(b for _, b in pairs), Counter(a for a, _ in pairs)
    return Counter({w: min(n, right[w]) for w, n in left.items() if w})


def telling_words(toxic: list[list[str]], ordinary: list[list[str]]) -> list[str]:
    """Words typical of toxic texts, most frequent first."""
    a, b = contexts(toxic), contexts(ordinary)
    n_a, n_b = sum(map(len, toxic)), sum(map(len, ordinary))
    share, out = n_a / (n_a + n_b), []
    for w, n in a.items():
        m, expected = b[w], (n + b[w]) * share
        if n < 3 or len(w) < 3 or n * n_b < 8 * (m + 0.5) * n_a:
            continue
        ratio = 2 * (n * math.log(n / expected) + (m * math.log(m / (n + m - expected)) if m else 0))
        if ratio >= CONTRAST:
            out.append(w)
    return sorted(out, key=lambda w: (-a[w], w))


def trained(samples: list[bytes], size: int, segment: int) -> bytes:
    """A dictionary from the library's trainer; nothing where the samples are too few for it."""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=6).as_bytes()
    except zstandard.ZstdError:
        return b""


class Model:
    """Two dictionaries and the calibration."""

    def __init__(self, toxic: list[str], ordinary: list[str]):
        self.weights = None
        bad, good = [words(t) for t in dict.fromkeys(toxic)], [words(t) for t in dict.fromkeys(ordinary)]
        if not any(bad) or not any(good):
            return
        telling = telling_words(bad, good)
        frequent = [w for w, _ in Counter(w for x in good for w in x).most_common(2000)]
        stretches = [f" {' '.join(w[i:i + STRETCH_WORDS])} ".encode() for w in good for i in range(0, len(w), STRETCH_WORDS)]
        pick = random.Random(7)
        pick.shuffle(stretches)
        samples = [f" {w} ".encode() for i, w in enumerate(telling) for _ in range(max(2, 20 - i // 20))]
        pick.shuffle(samples)
        self.ordinary = trained(stretches[:STRETCHES], DICTIONARY_BYTES, 200) + f" {' '.join(reversed(frequent))}".encode()
        self.toxic = self.ordinary + trained(samples, 8192, 32) + "".join(f" {w}" for w in reversed(telling)).encode()
        worker = Scorer(self)
        rows = [worker.features(w) for w in bad + good]
        self.fit(np.array(rows), np.array([1.0] * len(bad) + [0.0] * len(good)))

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        """Logistic regression with a small ridge, by Newton steps."""
        self.mean, self.spread = x.mean(0), x.std(0) + 1e-6
        z = np.c_[(x - self.mean) / self.spread, np.ones(len(x))]
        w, ridge = np.zeros(z.shape[1]), np.append(np.ones(x.shape[1]), 1e-6)
        for _ in range(30):
            p = self._logistic(z @ w)
            w -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge), z.T @ (p - y) + ridge * w)
        self.weights = w

    @staticmethod
    def _logistic(v: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(v, -40, 40)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self._logistic(np.c_[(x - self.mean) / self.spread, np.ones(len(x))] @ self.weights)


class Scorer:
    """The worker's side of a model: its compressors and the distances of words met so far."""

    def __init__(self, model: Model):
        self.model = model
        compress_a, compress_b = self._compressor(model.ordinary), self._compressor(model.toxic)

        def distance(word: str) -> int:
            window = spell(_MARK + word.encode() + b" " + _MARK)
            return len(compress_a(window)) - len(compress_b(window))

        self.distances = Cache(distance, 300_000)

    @staticmethod
    def _compressor(content: bytes):
        settings = zstandard.ZstdCompressionParameters(
            compression_level=12, window_log=20, chain_log=16, hash_log=17, search_log=6, min_match=3, target_length=64,
            strategy=zstandard.STRATEGY_BTOPT, write_content_size=0, write_checksum=0, write_dict_id=0,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS)
        held = zstandard.ZstdCompressionDict(spell(content + _MARK), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=settings)
        return zstandard.ZstdCompressor(dict_data=held, compression_params=settings).compress

    def features(self, text: list[str]) -> list[float]:
        n, seen = max(1, len(text)), Counter(map(self.distances.__getitem__, text))
        reach = [sum(k for d, k in seen.items() if d >= least) for least in DISTANCES]
        return [*(math.log1p(k) for k in reach), *(math.log1p(100 * k / n) for k in reach), math.log(n)]

    def scores(self, texts: list[str]) -> list[float]:
        return self.model.probability(np.array([self.features(words(t)) for t in texts])).tolist()


def fit(df: DataFrame, labels: DataFrame, allowed: F.Column, key: str = "doc_id", label: str = "toxic", text: str = "text") -> Model:
    """Learn from labelled rows of df where `allowed` (of the key) holds. Rows without label or key are passed over;
    of contradicting labels of one key the higher counts."""
    marked = labels.select(F.col(key).alias("__key"), F.col(label).alias("__label")).where("__key IS NOT NULL AND __label IS NOT NULL") \
        .withColumnRenamed("__key", key).where(allowed).groupBy(key).agg(F.max("__label").alias("__label")) \
        .withColumn("__hash", F.xxhash64(key))
    ids = [marked.where(F.col("__label") == value).orderBy("__hash", key).limit(n).select(key, "__label")
           for value, n in ((1, TOXIC_TEXTS), (0, ORDINARY_TEXTS))]
    chosen = ids[0].unionByName(ids[1])                               # at most TOXIC_TEXTS + ORDINARY_TEXTS rows
    rows = df.select(key, text_or_empty(text).alias("__text")).join(F.broadcast(chosen), key) \
        .groupBy(key, "__label").agg(F.min("__text").alias("__text")).orderBy(F.xxhash64(key), key).collect()
    return Model([r["__text"] for r in rows if r["__label"] == 1], [r["__text"] for r in rows if r["__label"] == 0])


_scorers: dict[str, Scorer] = {}


def score(df: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """Adds score and predicted (1 from the threshold on)."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def rows(column: pa.Array):
        held = sent.value
        if held.weights is None:
            return [(0.0,)] * len(column)
        if id(held) not in _scorers:
            _scorers.clear()
            _scorers[id(held)] = Scorer(held)
        return [(s,) for s in _scorers[id(held)].scores(column.to_pylist())]

    kept = [c for c in (keep or df.columns) if c.lower() != "predicted"]
    return map_texts(df, text, [T.StructField("score", T.DoubleType())], rows, BATCH_BYTES, kept) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
