"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the hashes of its words, of neighbouring pairs and of pairs one word apart, each present or not.
Every coordinate has its own learning rate, and the L1 term keeps most weights at zero, so the weights that are left
go to all tasks as a small array.

Labels are learned from a bounded sample: at most ``TRAIN_TOXIC`` and ``TRAIN_CLEAN`` labelled rows, those whose ids
have the smallest hashes, and none whose crc32(doc_id as text) is divisible by ``FOLDS``. The sample is ordered by that
hash, so the weights don't depend on the order of rows. Labels, lang, source and doc_id are no features.

Null and empty texts have the score of no feature but the bias. A null doc_id is never learned from and isn't held
out. Of repeated labels the largest counts. Where nothing can be learned, as there are labels of one kind only or no
weight is left, every score is the sample's share of toxic rows, or 0 without any. Repeated rows are scored alike.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelab.llm.common import Remembered, stored, table

BITS = 20
TRAIN_TOXIC, TRAIN_CLEAN = 2000, 6000
FOLDS = 5
EPOCHS, ALPHA, BETA, L1, L2 = 5, 2.0, 1.0, 6.0, 0.1
#: A feature is learned once so many documents of the sample have it; rarer ones are mostly accidents.
LEAST_DOCUMENTS = 6
THRESHOLD = 0.5

#: A-Z in lower case; all other ASCII characters but digits and letters part words.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0x27D4EB2F165667C5))


def _hash(word: bytes) -> int:
    return zlib.crc32(word)


def features(text: str | None, hashes: dict[bytes, int], bits: int = BITS) -> np.ndarray:
    """Hashed features of a text, with repeats; the bias is feature 0."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    shift = np.uint64(64 - bits)
    one = (h * _MIX[0]) >> shift
    pairs = [((h[:-d] * _MIX[d] + h[d:] * _MIX[3]) * _MIX[0]) >> shift for d in (1, 2) if len(h) > d]
    return np.concatenate([[0], one, *pairs]).astype(np.int64)


def word_hashes() -> Remembered:
    """Word -> hash; a bounded table for a worker."""
    return Remembered(_hash)


def ftrl(samples: list[np.ndarray], labels: np.ndarray, bits: int = BITS, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """The indices and values of the weights that aren't zero. A sample is the distinct features of a text."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    seen = np.zeros(1 << bits, np.int64)
    for at in samples:
        seen[at] += 1
    samples = [at[seen[at] >= LEAST_DOCUMENTS] for at in samples]
    for _ in range(epochs):
        for at, y in zip(samples, labels, strict=True):
            w = weights(z[at], n[at])
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, w.sum())))) - y
            squares = n[at]
            z[at] += g - (np.sqrt(squares + g * g) - np.sqrt(squares)) / ALPHA * w
            n[at] = squares + g * g
    w = weights(z, n)
    at = np.flatnonzero(w)
    return at, w[at]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


class Model(NamedTuple):
    """Weights that aren't zero; where there are none, the score of all."""

    at: np.ndarray
    values: np.ndarray
    share: float


def train(docs: DataFrame, labels: DataFrame, bits: int = BITS) -> Model:
    """Learns from the bounded sample; one task does, as the method takes samples in turn, and it gets hashed features."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("turn", F.xxhash64("doc_id"))
    sample = known.where("toxic = 1").orderBy("turn", "doc_id").limit(TRAIN_TOXIC)
    sample = stored(sample.union(known.where("toxic = 0").orderBy("turn", "doc_id").limit(TRAIN_CLEAN)))
    # at most TRAIN_TOXIC + TRAIN_CLEAN rows of 24 bytes
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    # of rows that repeat an id one is learned from, so the bound holds
    rows = rows.groupBy("doc_id", "toxic", "turn").agg(F.min("text").alias("text"))

    @F.pandas_udf("array<int>")
    def distinct(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = word_hashes()
        for texts in batches:
            yield pd.Series([np.unique(features(t, hashes, bits)).astype(np.int32) for t in texts], dtype=object)

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["turn", "doc_id"])
        y = pdf["toxic"].to_numpy(np.float64)
        at, w = ftrl([np.asarray(x, np.int64) for x in pdf["features"]], y, bits) if len(np.unique(y)) == 2 else (np.empty(0, np.int64), np.empty(0))
        return pd.DataFrame({"at": [*at, -1], "w": [*w, y.mean()]})

    given = rows.select("doc_id", "toxic", "turn", distinct("text").alias("features"), F.lit(0).alias("all"))
    found = stored(given.groupBy("all").applyInPandas(learn, "at long, w double")).toPandas().sort_values("at")  # at most 2 ** bits rows and one
    at, w = found["at"].to_numpy(np.int64), found["w"].to_numpy(np.float64)
    return Model(at[1:], w[1:], float(w[0])) if len(at) else Model(at, w, 0.0)


def score(text: Column, model: Model, bits: int = BITS) -> Column:
    """The probability of label 1."""
    at, values, share = model

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w, hashes = np.zeros(1 << bits), word_hashes()
        w[at] = values
        there = w != 0

        def one(text: str | None) -> float:
            found = features(text, hashes, bits)
            total = w[np.unique(found[there[found]])].sum()
            return 1 / (1 + math.exp(-max(-35.0, min(35.0, total))))

        for texts in batches:
            yield pd.Series([one(t) for t in texts], dtype="float64")

    return of(text) if len(at) else F.lit(share)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), train(docs, labels)).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below the threshold."""
    return docs.where(score(F.col("text"), train(docs, labels)) < THRESHOLD)


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
