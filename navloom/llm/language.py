"""Language identification by nearest centroid.

A text is a vector of hashed byte n-gram counts, weighted by inverse document
frequency, counted over all learnable rows, and normalised.  Each language has several centroids, found by spherical
k-means on a bounded sample of its labelled rows, one task per language.  A text
takes the language of the nearest centroid by cosine; ``rejected`` marks texts
whose distance from it exceeds a bound.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navloom.llm.common import append_columns, as_bytes, held_out, staged

BITS = 13
DIMS = 1 << BITS
# Bound of the labelled sample: rows of least id hash for each language.
ROWS_PER_LANGUAGE = 400
CENTROIDS = 3
ROUNDS = 8
# Sampled ids that may be broadcast: some tens of megabytes.
BROADCAST_IDS = 1_000_000
# Cosine distance beyond which a prediction is marked as rejected. Measured on the given documents of 20 words or
# more: held-out texts of learned languages have a cosine of 0.2 or more but for one in a thousand; of texts in a
# language left out of training 99 in 100 have 0.13 at most.
MAX_DISTANCE = 0.85

# ASCII letters in lower case, bytes outside ASCII as they are, everything else a blank.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_LATIN = re.compile(rb"[A-Za-z]")
FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
          T.StructField("rejected", T.BooleanType())]


def fold(text: bytes) -> bytes:
    """Words in lower case with one blank around each."""
    if not text.isascii():
        text = text.decode("utf-8", "replace").lower().encode()
    return b" " + b" ".join(text.translate(_LETTERS).split()) + b" "


def counts(text: bytes) -> np.ndarray:
    """Hashed counts of the byte n-grams of two and three."""
    b = np.frombuffer(fold(text), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(DIMS)
    two = b[:-1] * np.uint32(40503) + b[1:] * np.uint32(2654435761)
    three = two[:-1] * np.uint32(2246822519) + b[2:] * np.uint32(3266489917) + np.uint32(374761393)
    grams = np.concatenate([two, three])
    return np.bincount(grams >> np.uint32(32 - BITS), minlength=DIMS).astype(np.float64)


def vectors(texts: list[bytes], idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF rows with damped counts; a text without n-grams is a zero row."""
    rows = np.array([counts(t) for t in texts]).reshape(len(texts), DIMS)
    rows = np.log1p(rows) * idf
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norms == 0, 1, norms)


def has_letter(text: bytes) -> bool:
    if _LATIN.search(text):
        return True
    return not text.isascii() and any(c.isalpha() for c in text.decode("utf-8", "replace"))


@dataclass
class Centroids:
    """idf weights, one centroid per row and the language of each row."""

    idf: np.ndarray
    rows: np.ndarray
    langs: list[str]


def _frequencies(batches):
    total, docs = np.zeros(DIMS, np.int64), 0
    for batch in batches:
        for text in as_bytes(batch, "text"):
            total += counts(text) > 0
            docs += 1
    at = np.append(np.flatnonzero(total), -1)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(total[at[:-1]], docs))], names=["at", "n"])


def _clusters(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from farthest-point seeds; the same rows give the same centroids."""
    seeds = [x.mean(axis=0)]
    while len(seeds) < k:
        seeds.append(x[np.argmin((x @ np.array(seeds).T).max(axis=1))])
    centres = np.array(seeds)
    for _ in range(ROUNDS):
        nearest = np.argmax(x @ centres.T, axis=1)
        for j in range(len(centres)):
            if (nearest == j).any():
                centres[j] = x[nearest == j].mean(axis=0)
        norms = np.linalg.norm(centres, axis=1, keepdims=True)
        centres = centres / np.where(norms == 0, 1, norms)
    return centres


def train(docs: DataFrame, max_rows: int = ROWS_PER_LANGUAGE, centroids: int = CENTROIDS) -> Centroids:
    """Centroids from at most ``max_rows`` labelled rows of each language.

    Rows without a language, text or id teach nothing.  Only the centroids and the
    ``2 ** BITS`` document frequencies reach the driver.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text").where(
        "lang is not null and text is not null and doc_id is not null").where(~held_out())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # The sample is drawn on ids alone and limited within each task before it moves.
    ids = known.select("doc_id", "lang").withColumn("_n", F.row_number().over(order)).where(
        F.col("_n") <= max_rows).select("doc_id", "lang").distinct()
    ids = staged(ids)
    # A corpus with very many languages is joined by a shuffle instead.
    chosen = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    sample = known.select("doc_id", "lang", F.col("text").cast("binary").alias("text")).join(chosen, ["doc_id", "lang"])
    # Document frequencies are those of all learnable rows; a task sends at most 2 ** BITS + 1 sums.
    every = known.select(F.col("text").cast("binary").alias("text"))
    sums = {r["at"]: r["n"] for r in every.mapInArrow(_frequencies, "at long, n long").groupBy("at").agg(
        F.sum("n").alias("n")).collect()}
    total = sums.pop(-1, 0)
    idf = np.full(DIMS, np.log(1.0 + total))
    for at, n in sums.items():
        idf[at] = np.log((1.0 + total) / (1.0 + n)) + 0.01

    def fit(frame: pa.Table) -> pa.Table:
        rows = sorted(zip(frame.column("doc_id").to_pylist(), frame.column("text").to_pylist()))
        x = vectors([t for _, t in rows], idf)
        x = x[np.abs(x).sum(axis=1) > 0]
        centres = _clusters(x, min(centroids, len(x))) if len(x) else np.zeros((0, DIMS))
        return pa.table({"lang": pa.array([frame.column("lang")[0].as_py()] * len(centres), pa.string()),
                         "centre": pa.array(list(centres), pa.list_(pa.float64()))})

    fitted = sorted(sample.groupBy("lang").applyInArrow(fit, "lang string, centre array<double>").collect())
    rows = np.array([r["centre"] for r in fitted]).reshape(len(fitted), DIMS)
    return Centroids(idf, rows, [r["lang"] for r in fitted])


def predict(docs: DataFrame, model: Centroids, text_col: str = "text", max_distance: float = MAX_DISTANCE) -> DataFrame:
    """Append lang_pred, score and rejected to every row.

    ``score`` is the cosine to the nearest centroid, from 0 to 1.  A text that is
    null or has no letter, and any text if no language was learned, is ``und`` with
    score 0 and rejected.  Ties go to the language first in order.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.idf, model.rows, model.langs))

    def factory():
        idf, rows, langs = shared.value

        def step(batch: pa.RecordBatch):
            texts = as_bytes(batch, text_col)
            names: list[str] = []
            best = np.zeros(len(texts))
            if langs:
                cosines = vectors(texts, idf) @ rows.T
                nearest = np.argmax(cosines, axis=1)
                best = np.clip(cosines[np.arange(len(texts)), nearest], 0.0, 1.0)
                names = [langs[i] for i in nearest]
            judged = [bool(langs) and has_letter(t) for t in texts]
            best = np.where(judged, best, 0.0)
            return [pa.array([n if ok else "und" for n, ok in zip(names or ["und"] * len(texts), judged)], pa.string()),
                    pa.array(best), pa.array(1.0 - best > max_distance)]

        return step

    return append_columns(docs, FIELDS, factory, text_col)
