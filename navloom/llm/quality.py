"""Quality classifier: hashed word n-grams, logistic regression, follow the regularised leader.

Features of a text are hashed unigrams and bigrams of its lower-cased words and of
their shapes (letters, digits and marks folded), as counts divided by the square root of their
number.  Training runs the per-coordinate FTRL-Proximal update over shards of a
bounded labelled sample, one group per shard, and averages the shards' weights.  The
shard of a row follows from its id alone, so the model is the same on any cluster.
Scoring is a sparse dot product over the whole text, row by row.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navloom.llm.common import append_columns, as_bytes, held_out, staged

BITS = 18
# Bound of the labelled sample: the rows of least id hash, alike for every input size.
TRAIN_ROWS = 16_000
SHARDS = 8
PASSES = 3
# FTRL-Proximal: learning rate, smoothing, L1 and L2 penalty.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1

_MASK = (1 << BITS) - 1
# Letters become a or A, digits 0, characters outside ASCII a; marks and white space stay.
_SHAPE = bytes(97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c
               for c in range(256))
_RUNS = re.compile(rb"([aA0])\1+")


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, words), np.int64, len(words))


def _grams(values: np.ndarray, salt: int) -> list[np.ndarray]:
    one = (values * 2654435761 + salt) >> 7 & _MASK
    two = (values[:-1] * 1000003 + values[1:] * 2654435761 + salt * 97 + 1) >> 7 & _MASK
    return [one, two]


def features(text: bytes) -> tuple[np.ndarray, float]:
    """Feature numbers with repeats, and the value each occurrence counts."""
    words = _hashes(text.lower().split())
    shapes = _hashes(_RUNS.sub(rb"\1", text.translate(_SHAPE)).split())
    index = np.concatenate(_grams(words, 11) + _grams(shapes, 5003))
    return index, 1.0 / np.sqrt(max(len(index), 1))


class Leader:
    """Per-coordinate FTRL-Proximal for logistic loss; the last coordinate is the constant."""

    def __init__(self):
        self.z = np.zeros(_MASK + 2)
        self.n = np.zeros(_MASK + 2)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, index: np.ndarray, value: float, label: int) -> None:
        at, counts = np.unique(index, return_counts=True)
        at, x = np.append(at, _MASK + 1), np.append(counts * value, 1.0)
        w = self.weights(at)
        error = _sigmoid(w @ x) - label
        g = error * x
        squared = self.n[at] + g * g
        self.z[at] += g - (np.sqrt(squared) - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] = squared


def _sigmoid(t):
    return 1.0 / (1.0 + np.exp(-np.clip(t, -30, 30)))


SHARD_MODEL = "rows long, at array<int>, weight array<double>"


def _fit_shard(shard: pa.Table) -> pa.Table:
    """One row: the shard's row count and the weights that are not zero."""
    rows = [(row["doc_id"], row["label"], row["text"] or b"") for row in shard.to_pylist()]
    rows.sort(key=lambda r: (crc32(str(r[0]).encode()), r[0], r[1], r[2]))
    model = Leader()
    examples = [(*features(text), label) for _, label, text in rows]
    for _ in range(PASSES):
        for index, value, label in examples:
            model.learn(index, value, label)
    weights = model.weights(np.arange(_MASK + 2))
    at = np.flatnonzero(weights)
    return pa.table({"rows": pa.array([len(rows)], pa.int64()), "at": pa.array([at.astype(np.int32)], pa.list_(pa.int32())),
                     "weight": pa.array([weights[at]], pa.list_(pa.float64()))})


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights from the ``max_rows`` labelled rows of least id hash.

    Rows without a label, text or id teach nothing, repeated rows count once.
    Without any labelled row all weights are zero.  Each shard sends
    one row of at most ``2 ** BITS + 1`` weights to the driver.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(
        "label in (0, 1) and doc_id is not null").where(~held_out()).groupBy("doc_id").agg(F.max("label").alias("label"))
    # The sample is drawn on ids alone, so no text moves before its bound holds.
    ids = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id")).join(marked, "doc_id").distinct()
    texts = docs.where("text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    sample = texts.join(F.broadcast(_least(staged(ids), max_rows)), "doc_id").groupBy("doc_id").agg(
        F.max("label").alias("label"), F.max("text").alias("text"))
    shards = sample.withColumn("shard", F.expr(f"pmod(xxhash64(doc_id), {SHARDS})")).groupBy("shard").applyInArrow(
        _fit_shard, SHARD_MODEL).collect()
    total = np.zeros(_MASK + 2)
    for shard in sorted(shards):  # sums of one order, so that the last bit is the same in every run
        total[shard["at"]] += np.array(shard["weight"]) * shard["rows"]
    return total / max(1, sum(shard["rows"] for shard in shards))


def _least(ids: DataFrame, max_rows: int) -> DataFrame:
    """The ``max_rows`` ids of least hash; a bound on the hash, from the count, keeps the sort short."""
    reach = min(1.0, 1.5 * (max_rows + 1000) / max(1, ids.count()))
    bound = int(reach * 2 ** 63)
    mixed = F.expr("xxhash64(doc_id) & 9223372036854775807L")
    return ids.where(mixed < F.lit(bound) if reach < 1 else F.lit(True)).orderBy(mixed, "doc_id").limit(max_rows)


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text", column: str = "score") -> DataFrame:
    """Append the probability of a good text to every row.

    A null or empty text has the constant as its only feature.  Rows are scored one
    by one; further columns pass through.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def factory():
        w = shared.value

        def step(batch: pa.RecordBatch):
            out = []
            for text in as_bytes(batch, text_col):
                index, value = features(text)
                out.append(float(_sigmoid(float(w[index].sum()) * value + float(w[-1]))))
            return [pa.array(out, pa.float64())]

        return step

    return append_columns(docs, [T.StructField(column, T.DoubleType())], factory, text_col)
