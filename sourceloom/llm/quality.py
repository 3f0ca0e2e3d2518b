"""Quality classifier: random-indexing word vectors, pooled per document, and a small calibrated network."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sourceloom.llm.common import ship, small
from sourceloom.llm.kernels import Words, raw, steps

#: Length of a word vector; neighbours on each side that count; entries of an index vector that are not 0.
DIMS, REACH, MARKS = 32, 2, 4
#: Rows of the signed sketch that holds the word vectors (fixed size: 9 MB), and the blocks that it is summed in.
SLOTS, BLOCKS = 1 << 15, 64
#: Labelled documents that the network is fitted on, at most.
FIT_DOCS = 20_000
#: Bytes of text handled at once.
STEP = 1 << 20
HIDDEN, ROUNDS, DECAY, RATE = 24, 400, 1e-3, 0.02
#: Share of the labelled sample that sets the temperature, one of so many.
CALIBRATE = 5

_U = np.uint64
_WIDTH = DIMS + 1
# Letters, digits and multi-byte characters make one class of word, other printable characters another.
_CLASSES = np.full(256, 2, dtype=np.uint8)
_CLASSES[:33] = 0
_CLASSES[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def _marks(h: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and sign of the ``j``-th entry of the words' index vectors."""
    bits = (h >> _U(20 + 8 * j)).astype(np.int64)
    return bits & (DIMS - 1), 1 - 2 * ((bits >> 7) & 1)


def _slots(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = h.astype(np.int64)
    return low & (SLOTS - 1), 1 - 2 * ((low >> 17) & 1)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sums of neighbours' index vectors, per slot of the sketch, with the words' count behind."""
    total = np.zeros(SLOTS * _WIDTH)
    some = False
    for batch in batches:
        data, offsets = raw(batch.column("_text"))
        for a, b in steps(offsets, STEP):
            words = Words(data, offsets[a:b + 1], _CLASSES, fold=False)
            if not len(words.hash):
                continue
            some = True
            slot, sign = _slots(words.hash)
            total += np.bincount(slot * _WIDTH + DIMS, minlength=len(total))
            for j in range(MARKS):
                place, mark = _marks(words.hash, j)
                for away in range(1, REACH + 1):
                    near = words.row[away:] == words.row[:-away]
                    left, right = slice(None, -away), slice(away, None)
                    for own, other in ((left, right), (right, left)):
                        at = (slot[own] * _WIDTH + place[other])[near]
                        total += np.bincount(at, weights=(sign[own] * mark[other])[near], minlength=len(total))
    if some:
        parts = total.astype(np.int64).reshape(BLOCKS, -1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BLOCKS, dtype=np.int32)), pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())],
                                         names=["block", "data"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up blocks as they stream by; a task holds the sums of its blocks only."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, data in zip(batch.column("block"), batch.column("data")):
            part = np.frombuffer(zlib.decompress(data.as_py()), np.int64)
            sums[block.as_py()] = sums[block.as_py()] + part if block.as_py() in sums else part
    for block, total in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], names=["block", "data"])


def word_vectors(texts: DataFrame) -> np.ndarray:
    """Word vectors of all of ``texts(_text)`` as a sketch of fixed size: unit vectors, and the log of the count behind.

    A word's vector is the sum of the index vectors (``MARKS`` entries of 1 or -1, set by its hash) of the words up to ``REACH`` places
    away.  A word is added to a slot with a sign of its own, so words that share a slot cancel out on average.
    """
    parts = texts.mapInArrow(_contexts, "block int, data binary").repartition(BLOCKS, "block").mapInArrow(_summed, "block int, data binary")
    table = np.zeros((BLOCKS, SLOTS * _WIDTH // BLOCKS))
    for block, data in parts.collect():  # fixed size
        table[block] = np.frombuffer(zlib.decompress(data), np.int64)
    table = table.reshape(SLOTS, _WIDTH)
    size = np.linalg.norm(table[:, :DIMS], axis=1, keepdims=True)
    return np.hstack([table[:, :DIMS] / np.maximum(size, 1), np.log1p(table[:, DIMS:])]).astype(np.float32)


def _pooled(text: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Means and spreads of the words' vectors per text; zeros without words."""
    words = Words(text, offsets, _CLASSES, fold=False)
    out = np.zeros((len(offsets) - 1, 2 * _WIDTH))
    if len(words.hash):
        slot, sign = _slots(words.hash)
        value = table[slot]
        value[:, :DIMS] *= sign[:, None].astype(np.float32)
        some = words.count > 0
        edge = (np.cumsum(words.count) - words.count)[some]
        n = words.count[some][:, None]
        mean = np.add.reduceat(value, edge, axis=0, dtype=np.float64) / n
        np.square(value, out=value)
        square = np.add.reduceat(value, edge, axis=0, dtype=np.float64) / n
        out[some] = np.hstack([mean, np.sqrt(np.maximum(square - mean ** 2, 0))])
    return out


def _features(batches: Iterator[pa.RecordBatch], table) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = raw(batch.column("_text"))
        for a, b in steps(offsets, STEP):
            x = _pooled(data, offsets[a:b + 1], table.value)
            lists = pa.ListArray.from_arrays(pa.array((np.arange(b - a + 1) * x.shape[1]).astype(np.int32)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("_draw").slice(a, b - a), batch.column("quality").slice(a, b - a), lists], names=["draw", "quality", "x"])


class Network:
    """Inputs brought to one scale, ``tanh`` units, one output, and a temperature that makes it a probability."""

    def __init__(self, x: np.ndarray, y: np.ndarray) -> None:
        """Fits ``y`` in {0, 1}; every ``CALIBRATE``-th row is kept for the temperature.  Without both labels the share of 1 is the score."""
        self.share = (float(y.sum()) + 1) / (len(y) + 2)
        self.fitted = len(np.unique(y)) == 2
        if not self.fitted:
            return
        aside = np.arange(len(y)) % CALIBRATE == 0
        if len(np.unique(y[aside])) < 2 or len(np.unique(y[~aside])) < 2:
            aside = np.zeros(len(y), bool)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        inputs, target = (x[~aside] - self.mean) / self.scale, y[~aside]
        draw = np.random.default_rng(7)
        self.weights = [draw.normal(0, inputs.shape[1] ** -0.5, (inputs.shape[1], HIDDEN)), np.zeros(HIDDEN), draw.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
        first, second = ([np.zeros_like(w) for w in self.weights] for _ in range(2))
        for t in range(1, ROUNDS + 1):
            hidden = np.tanh(inputs @ self.weights[0] + self.weights[1])
            error = (_sigmoid(hidden @ self.weights[2] + self.weights[3][0]) - target) / len(target)
            inner = error[:, None] * self.weights[2] * (1 - hidden ** 2)
            slopes = [inputs.T @ inner + DECAY * self.weights[0], inner.sum(0), hidden.T @ error + DECAY * self.weights[2], np.array([error.sum()])]
            for w, g, m, v in zip(self.weights, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        kept = aside if aside.any() else ~aside
        self.temperature = _temperature(self.outputs(x[kept]), y[kept])

    def outputs(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.weights[0] + self.weights[1]) @ self.weights[2] + self.weights[3][0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.outputs(x) / self.temperature) if self.fitted else np.full(len(x), self.share)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _temperature(outputs: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the outputs at which the labels are likeliest, by golden sections of its logarithm."""
    loss = lambda t: float(np.mean(np.logaddexp(0, np.where(y == 1, -outputs, outputs) / np.exp(t))))
    low, high, part = np.log(0.2), np.log(20.0), (5 ** 0.5 - 1) / 2
    for _ in range(60):
        a, b = high - part * (high - low), low + part * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _scored(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    table, network = model.value
    for batch in batches:
        data, offsets = raw(batch.column("_text"))
        for a, b in steps(offsets, STEP):
            score = network.score(_pooled(data, offsets[a:b + 1], table))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), batch.column("held_out").slice(a, b - a), pa.array(score)],
                                             names=["doc_id", "held_out", "score"])


def quality_scores(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "quality",
                   threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``; only the text decides.

    Words are runs of letters, digits and multi-byte characters, or of other visible characters; letter case counts.  Word vectors come
    from all texts (``word_vectors``); a text is the mean and spread of its words' vectors.  The network learns from labelled rows that
    are not held out (crc32 of the id as text, modulo 4, is 2), at most ``FIT_DOCS`` drawn by a hash of the id, and gives every whole text a
    probability of label 1; ``predicted`` is 1 from ``threshold`` on.

    Null, empty and wordless texts share one score, from a vector of zeros.  Null ids are not held out and have no label.  Labels other
    than 0 and 1 do not count, nor do ids labelled both.  Repeated rows are scored each.  If labels of one kind are missing, every
    score is (label-1 rows + 1) / (rows + 2).  The word table and the sample have fixed bounds; nothing else reaches the driver.
    """
    spark = docs.sparkSession
    ship(spark)
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    table = word_vectors(base.select("_text"))
    known = labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("quality")).where("quality IN (0, 1) AND doc_id IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("_most")).where("quality = _most").drop("_most")
    known = known.where(~held_out(F.col("doc_id"))).join(base.select("doc_id"), "doc_id", "left_semi")
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_DOCS)
    sample = base.join(small(known, FIT_DOCS), "doc_id").withColumn("_draw", F.xxhash64("doc_id", "_text"))
    shared = spark.sparkContext.broadcast(table)
    rows = sample.mapInArrow(partial(_features, table=shared), "draw bigint, quality int, x array<double>")
    fit = rows.orderBy("draw", "x").limit(FIT_DOCS).collect()
    x = np.array([r.x for r in fit]).reshape(len(fit), 2 * _WIDTH)
    model = spark.sparkContext.broadcast((table, Network(x, np.array([r.quality for r in fit]))))
    scored = base.mapInArrow(partial(_scored, model=model), "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
