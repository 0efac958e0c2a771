"""Quality classifier: random-indexing word vectors and a small network.

1. *Word vectors.* A word (as written, case and marks included) falls into one
   of ``VOCABULARY`` slots by hash, and each slot has a sparse random index
   vector: a few +1 and -1 among ``SIZE`` places. A slot's word vector is the
   sum of the index vectors of the words around it, over all documents, scaled
   to length 1. A task sums its own matrix, and the matrices are summed by
   block of slots, so the result has one size for any corpus.
2. *Pooling.* A document is the mean and the spread of its words' vectors.
3. *Network.* One hidden layer and a logistic output, trained in numpy on at
   most ``TRAIN_ROWS`` labelled rows (least hash of the id first), none of them
   held out. A fifth fold, not trained on, sets the temperature that divides
   the output before the logistic function, so scores are probabilities.

Only texts are inputs. Counts and vectors use every document; the label sample
is the one bounded part.

Defined results: a null or empty text pools to zeros and is scored like any; a
null id is never learned from nor held out; repeated rows count each and score
alike; contradicting labels of one id are each a row; without labels of both
kinds every score is the share of 1 among them, 0.5 without any; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import SLICE_BYTES, mix, saved, slices, text_bytes, word_hashes

VOCABULARY = 1 << 14
SIZE = 48
#: Non-zero places of an index vector, and words to either side that count.
SEEDS, REACH = 4, 2
BLOCKS = 64
#: Labelled rows that the network is trained and calibrated on, at most.
TRAIN_ROWS = 20_000
FOLDS, HELD_OUT, CALIBRATE = 5, 0, 1
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 256, 0.005, 1e-4
CUT = 0.3


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """(places, signs) of each slot's index vector."""
    h = mix(np.arange(VOCABULARY * SEEDS, dtype=np.uint64) + np.uint64(1)).reshape(VOCABULARY, SEEDS)
    return (h % np.uint64(SIZE)).astype(np.int64), np.where(h >> np.uint64(63) == 1, 1.0, -1.0)


def _slots(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words, count = word_hashes(data, offsets, lower=False)
    return (words & np.uint64(VOCABULARY - 1)).astype(np.int64), count


def word_vectors(texts: DataFrame) -> np.ndarray:
    """VOCABULARY x SIZE matrix of unit rows, from all rows of column text."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = index_vectors()
        total = np.zeros(VOCABULARY * SIZE)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for i, j in slices(offsets, SLICE_BYTES // 2):
                slot, count = _slots(data, offsets[i:j + 1])
                doc = np.repeat(np.arange(j - i), count)
                for step in range(1, REACH + 1):
                    pair = np.flatnonzero(doc[:-step] == doc[step:]) if len(doc) > step else np.zeros(0, np.int64)
                    for one, other in ((slot[pair], slot[pair + step]), (slot[pair + step], slot[pair])):
                        for s in range(SEEDS):
                            total += np.bincount(one * SIZE + place[other, s], sign[other, s], VOCABULARY * SIZE)
        parts = total.astype(np.float32).reshape(BLOCKS, -1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BLOCKS, dtype=np.int32)), pa.array([p.tobytes() for p in parts], pa.binary())], names=["block", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                got = np.frombuffer(part, np.float32).astype(np.float64)
                total[block] = total[block] + got if block in total else got
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["block", "sums"])

    shape = "block int, sums binary"
    rows = texts.select("text").mapInArrow(sums, shape).repartition("block").mapInArrow(add, shape).collect()
    matrix = np.zeros((BLOCKS, VOCABULARY * SIZE // BLOCKS))
    for block, part in rows:
        matrix[block] = np.frombuffer(part)
    matrix = matrix.reshape(VOCABULARY, SIZE)
    return (matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pool(data: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the word vectors of each text."""
    slot, count = _slots(data, offsets)
    n = len(count)
    out = np.zeros((n, 2 * SIZE), np.float32)
    for low in range(0, len(slot), 200_000):  # bounded, also within a long text
        part = slot[low:low + 200_000]
        ends = np.cumsum(count)
        doc = np.searchsorted(ends, np.arange(low, low + len(part)), "right")
        first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        x = vectors[part]
        out[doc[first], :SIZE] += np.add.reduceat(x, first, axis=0)
        out[doc[first], SIZE:] += np.add.reduceat(x * x, first, axis=0)
    out /= np.maximum(count, 1)[:, None].astype(np.float32)
    out[:, SIZE:] = np.sqrt(np.maximum(out[:, SIZE:] - out[:, :SIZE] ** 2, 0))
    return out


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Network:
    """Two layers: tanh, then one output. Inputs are standardised."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-4
        x = (x - self.mean) / self.scale
        self.w = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
        self.temperature = 1.0
        first, second = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w]
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for low in range(0, len(x), BATCH):
                at = order[low:low + BATCH]
                hidden = np.tanh(x[at] @ self.w[0] + self.w[1])
                error = (_logistic(hidden @ self.w[2] + self.w[3]) - y[at]) / len(at)
                back = error[:, None] * self.w[2] * (1 - hidden ** 2)
                step += 1
                for i, g in enumerate((x[at].T @ back, back.sum(0), hidden.T @ error, error.sum(keepdims=True))):
                    g = g + DECAY * self.w[i]
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    self.w[i] -= RATE * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)

    def output(self, x: np.ndarray) -> np.ndarray:
        x = (x - self.mean) / self.scale
        return np.tanh(x @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3]

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature with the least log loss, of a fine grid."""
        z = self.output(x)
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 141))
        loss = [np.logaddexp(0, np.where(y == 1, -z, z) / t).mean() for t in grid]
        self.temperature = float(grid[int(np.argmin(loss))])

    def score(self, x: np.ndarray) -> np.ndarray:
        return _logistic(self.output(x) / self.temperature)


def fold_of(id_col: str):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
             train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    vectors = spark.sparkContext.broadcast(word_vectors(texts))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for i, j in slices(offsets):
                x = pool(data, offsets[i:j + 1], vectors.value)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "x"])

    pooled = saved(texts.mapInArrow(features, "doc_id long, x binary"))
    known = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
             .withColumn("fold", fold_of("doc_id")).where(F.col("fold") != HELD_OUT).orderBy(F.xxhash64("doc_id"), "y").limit(train_rows))
    # the bounded sample of labelled rows; repeated ids do not enlarge it much
    got = pooled.join(F.broadcast(known), "doc_id").select("x", "y", "fold").limit(4 * train_rows).collect()
    y = np.array([r["y"] for r in got], float)
    share = float(y.mean()) if len(y) else 0.5
    network = None
    if len(y) and 0 < share < 1:
        x = np.stack([np.frombuffer(r["x"], np.float32) for r in got]).astype(np.float64)
        tune = np.array([r["fold"] == CALIBRATE for r in got])
        if tune.all() or len(set(y[~tune])) < 2:
            tune[:] = False
        order = np.lexsort((y, *x.T[:4]))  # the same network whatever order rows come in
        order = order[~tune[order]]
        network = Network(x[order], y[order])
        if tune.any():
            network.calibrate(x[tune], y[tune])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float32).reshape(-1, 2 * SIZE).astype(np.float64)
            made = network.score(x) if network is not None else np.full(len(x), share)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made)], names=["doc_id", "score"])

    scored = pooled.mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(fold_of("doc_id") == HELD_OUT, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= CUT).cast("int").alias("predicted"))
