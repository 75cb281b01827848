"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network.

Words (and their shapes: case, digits, marks, length, repeats) fall into ``BUCKETS`` buckets. Each bucket has a
sparse random index vector; a bucket's word vector is the sum of the index vectors of its neighbours over
the whole corpus, counted exactly in integers, so that it does not depend on how the input is split. A
document is pooled to the mean and spread of its words' vectors and the mean of its shapes' vectors. A
network with one hidden layer is trained with numpy on at most ``MAX_LABELLED`` labelled documents (chosen
by hash of their id), and its probabilities are calibrated by a temperature fitted on a part of them that
training does not see.

Bounds: the vectors and the network are of constant size and go to every task; labelled ids are
broadcast under the same bound of ``MAX_LABELLED`` rows. Labels, language, source and id are no inputs.

Defined results: null, empty and word-free texts pool to zeros and get a score like any other. With
labels of one kind or none, the score is their share, kept off 0 and 1, or 0.5. Several labels of one
document count by their mean, null labels not at all. Repeated rows get equal scores; a null ``doc_id`` is
never held out and carries through; empty tables give no rows. Extra columns are kept by ``score``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillscope.llm.shipping import bound_batches, ship
from skillscope.llm.words import WordBatch, mixed, portions

BUCKETS, SHAPES, SIZE = 8192, 256, 32
NEIGHBOURS, NONZEROS = 2, 2
MAX_LABELLED = 20_000
HIDDEN, EPOCHS, STEP, DECAY = 32, 60, 0.003, 1e-4
CALIBRATION_SHARE = 5  # one labelled document in five


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _tokens(words: WordBatch, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word, case folded, and bucket of its shape, after those of the words.

    A shape tells case, digits, marks, length, and whether the word repeats the one before.
    """
    def inside(which: np.ndarray) -> np.ndarray:
        running = np.concatenate([[0], np.cumsum(which, dtype=np.int32)])
        return running[words.ends] - running[words.starts]

    length = words.ends - words.starts
    upper = inside((raw >= 65) & (raw <= 90))
    digits = inside((raw >= 48) & (raw <= 57))
    marks = inside((raw < 128) & ~(((raw | 32) >= 97) & ((raw | 32) <= 122)) & ~((raw >= 48) & (raw <= 57)) & (raw > 32))
    case = np.where(upper == 0, 0, np.where(2 * upper > length, 2, 1))
    shape = ((case * 2 + (digits > 0)) * 4 + np.minimum(marks, 3)) * 4 + np.searchsorted([3, 6, 11], length, "right")
    hashes = words.hashes()
    again = np.zeros(len(hashes), bool)
    again[1:] = hashes[1:] == hashes[:-1]
    again[words.first[:-1][words.counts > 0]] = False
    return (hashes % np.uint64(BUCKETS)).astype(np.int64), BUCKETS + shape + 128 * again


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of every bucket's index vector."""
    draws = mixed(np.arange(1, BUCKETS * NONZEROS + 1, dtype=np.uint64)).reshape(NONZEROS, BUCKETS)
    return (draws % np.uint64(SIZE)).astype(np.int64), np.where(draws >> np.uint64(63), 1.0, -1.0)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the neighbours add to every bucket's vector, for all texts of a task."""
    places, signs = _index_vectors()
    total = np.zeros((BUCKETS + SHAPES) * SIZE)
    for batch in batches:
        for _, texts in portions(batch.column(0)):
            words = WordBatch(texts, fold_ascii=True)
            if not len(words.starts):
                continue
            ids, shapes = _tokens(words, WordBatch(texts).data)
            owner = np.repeat(np.arange(len(words.counts)), words.counts)
            for step in range(1, NEIGHBOURS + 1):
                same = np.flatnonzero(owner[step:] == owner[:-step])
                for here, there in ((same, same + step), (same + step, same)):
                    near = ids[there]
                    for place, sign in zip(places, signs, strict=True):
                        for base in (ids[here], shapes[here]):
                            total += np.bincount(base * SIZE + place[near], weights=sign[near], minlength=len(total))
    sums = total.astype(np.int64).reshape(-1, SIZE)
    used = np.flatnonzero(sums.any(axis=1))
    for low in range(0, len(used), 1024):
        rows = used[low:low + 1024]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows), *(pa.array(np.ascontiguousarray(sums[rows, i])) for i in range(SIZE))],
            ["bucket", *(f"v{i}" for i in range(SIZE))])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vectors of all buckets, from the neighbours of every word of the corpus."""
    ship()
    bound_batches(docs.sparkSession)
    names = [f"v{i}" for i in range(SIZE)]
    parts = docs.selectExpr("CAST(text AS string) AS text").mapInArrow(
        _contexts, "bucket long, " + ", ".join(f"{n} long" for n in names))
    sums = parts.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]).collect()  # at most one row per bucket
    vectors = np.zeros((BUCKETS + SHAPES, SIZE))
    for row in sums:
        vectors[row[0]] = row[1:]
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Per text: mean and spread of its words' vectors, and mean of its shapes' vectors."""
    out = np.zeros((len(texts), 3 * SIZE))
    for low, portion in portions(texts, 1 << 18):
        words = WordBatch(portion, fold_ascii=True)
        some = np.flatnonzero(words.counts)
        if not len(some):
            continue
        ids, shapes = _tokens(words, WordBatch(portion).data)
        starts, n = words.first[some], words.counts[some][:, None]
        of_words = vectors[ids]
        mean = np.add.reduceat(of_words, starts, axis=0, dtype=np.float64) / n
        square = np.add.reduceat(of_words * of_words, starts, axis=0, dtype=np.float64) / n
        shape = np.add.reduceat(vectors[shapes], starts, axis=0, dtype=np.float64) / n
        out[low + some] = np.hstack([mean, np.sqrt(np.maximum(square - mean * mean, 0)), shape])
    return out


@dataclass
class Network:
    """Two layers over standardised inputs, with a temperature."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def _constant(share: float) -> Network:
    zero = np.zeros(3 * SIZE)
    share = min(max(share, 0.01), 0.99)
    return Network(zero, zero + 1, np.zeros((3 * SIZE, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm.

    Targets are smoothed by one count of each label, as a part that the network separates without
    error would otherwise ask for a temperature of zero.
    """
    ones = y.sum()
    goal = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (len(y) - ones + 2))

    def loss(t: float) -> float:
        z = logits / np.exp(t)
        return float(np.mean(np.logaddexp(0, z) - goal * z))

    low, high, ratio = -3.0, 3.0, (np.sqrt(5) - 1) / 2
    while high - low > 1e-4:
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(x: np.ndarray, y: np.ndarray, calibrate: np.ndarray, seed: int = 7) -> Network:
    """Adam on the log loss over the rows outside ``calibrate``; the others set the temperature."""
    if len(y) == 0 or y.min() == y.max():
        return _constant(float(y.mean()) if len(y) else 0.5)
    if y[~calibrate].size == 0 or y[~calibrate].min() == y[~calibrate].max():
        calibrate = np.zeros(len(y), bool)
    rng = np.random.default_rng(seed)
    xt, yt = x[~calibrate], y[~calibrate]
    scale = xt.std(axis=0)
    net = Network(xt.mean(axis=0), np.where(scale > 1e-9, scale, 1.0), rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)),
                  np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), 0.0)
    z = (xt - net.centre) / net.scale
    params = [net.w1, net.b1, net.w2, np.array([net.b2])]
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(yt))
        for low in range(0, len(order), 256):
            rows = order[low:low + 256]
            hidden = np.tanh(z[rows] @ params[0] + params[1])
            error = (1 / (1 + np.exp(-(hidden @ params[2] + params[3][0]))) - yt[rows]) / len(rows)
            back = error[:, None] * params[2] * (1 - hidden * hidden)
            grads = [z[rows].T @ back + DECAY * params[0], back.sum(axis=0), hidden.T @ error + DECAY * params[2], np.array([error.sum()])]
            t += 1
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= STEP * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = params[0], params[1], params[2], float(params[3][0])
    if calibrate.any():
        net.temperature = _temperature(net.logits(x[calibrate]), y[calibrate])
    return net


@dataclass
class QualityModel:
    vectors: np.ndarray
    network: Network

    def scores(self, texts: pa.Array) -> np.ndarray:
        return self.network.scores(pooled(texts, self.vectors))


def fit_quality(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> QualityModel:
    """Word vectors from all of ``docs``, and a network from labelled documents outside the held-out third."""
    vectors = word_vectors(docs)
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("double").alias("quality"))
    known = known.where(F.col("id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.avg("quality").alias("quality"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(max_labelled)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pooled(batch.column(2), vectors)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([r.tobytes() for r in rows], pa.binary())], ["id", "quality", "x"])

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(known), "id").select("id", "quality", "text").mapInArrow(features, "id long, quality double, x binary")
    rows = rows.dropDuplicates(["id"]).orderBy("id").collect()  # at most max_labelled
    x = np.array([np.frombuffer(r["x"]) for r in rows]).reshape(len(rows), 3 * SIZE)
    y = np.array([float(r["quality"] >= 0.5) for r in rows])
    ids = np.array([r["id"] for r in rows], np.int64).view(np.uint64)
    return QualityModel(vectors, train(x, y, mixed(ids) % np.uint64(CALIBRATION_SHARE) == 0))


def score(docs: DataFrame, model: QualityModel, column: str = "score") -> DataFrame:
    """``docs`` with the probability of good quality in ``column``, which replaces one of that name."""
    ship()
    bound_batches(docs.sparkSession)
    docs = docs.drop(column)
    at = docs.columns.index("text")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array(model.scores(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*batch.columns, values], [*batch.schema.names, column])

    schema = docs.withColumn(column, F.lit(None).cast("double")).schema
    return docs.mapInArrow(scored, schema)
