"""Document quality by a byte-level convolutional network, in numpy.

The bytes of a text are cut into chunks that overlap by more than a filter is wide, so every place of the whole text is
seen by every filter. A byte is a learned vector; filters of ``WIDTH`` bytes are laid on at each ``STRIDE``; a chunk's
feature is a filter's largest value in it; features of a chunk are mixed once. The largest and the mean of each mixed
feature over all chunks enter one logistic unit. Behind a text's end stand bytes of value 0, which no UTF-8 text needs otherwise; a filter may learn them.

Labels are learned from a bounded sample: at most ``TRAIN_LOW`` and ``TRAIN_HIGH`` labelled rows with texts of up to
``TRAIN_LONGEST`` characters, those whose ids have the smallest hashes, and none whose crc32(doc_id as text) is
divisible by ``FOLDS``. Weights of the rows restore the labels' own shares. Only what a maximum came from has a
gradient, so a step goes back through one window for each chunk and filter. Labels, lang, source and doc_id are no input.

Null and empty texts are one chunk of nothing. A null doc_id is never learned from and isn't held out. Of repeated
labels the largest counts. Where there are labels of one kind only, every score is the labels' share of quality, or 0
without any. Repeated rows are scored alike; extra columns aren't read; an empty table gives no rows. A very long text
costs a row of features for each of its chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelab.llm.common import stored, table
from racelab.llm.toxicity import held_out

DIM, WIDTH, STRIDE, FILTERS, MIXED = 8, 16, 4, 32, 32
CHUNK, STEP = 512, 448
TRAIN_LOW, TRAIN_HIGH, TRAIN_LONGEST = 2000, 4000, 1 << 16
EPOCHS, TOGETHER, RATE, DECAY = 8, 32, 3e-3, 1e-5
THRESHOLD = 0.3
#: Chunks that are convolved at once.
BLOCK = 128


class Net(NamedTuple):
    """Byte vectors, filters, what mixes their maxima, and the logistic unit's weights of maxima and means."""

    bytes: np.ndarray  # 256 x DIM
    filters: np.ndarray  # WIDTH * DIM x FILTERS
    offsets: np.ndarray  # FILTERS
    mix: np.ndarray  # FILTERS x MIXED
    mix_offsets: np.ndarray  # MIXED
    out: np.ndarray  # 2 * MIXED
    bias: np.ndarray  # 1

    @classmethod
    def shapes(cls) -> list[tuple[int, ...]]:
        return [(256, DIM), (WIDTH * DIM, FILTERS), (FILTERS,), (FILTERS, MIXED), (MIXED,), (2 * MIXED,), (1,)]

    @classmethod
    def start(cls, rng: np.random.Generator) -> Net:
        scales = (0.5, 1 / np.sqrt(WIDTH * DIM), 0.0, np.sqrt(2 / FILTERS), 0.0, 1 / np.sqrt(2 * MIXED), 0.0)
        return cls(*(rng.normal(0, 1, shape).astype(np.float32) * np.float32(s) for shape, s in zip(cls.shapes(), scales, strict=True)))

    def packed(self) -> bytes:
        return b"".join(x.astype("<f4").tobytes() for x in self)

    @classmethod
    def unpacked(cls, data: bytes) -> Net:
        flat, at, parts = np.frombuffer(data, "<f4"), 0, []
        for shape in cls.shapes():
            n = int(np.prod(shape))
            parts.append(flat[at : at + n].reshape(shape))
            at += n
        return cls(*parts)


def chunks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' chunks, a row of bytes each, and where each text's chunks begin and the last end."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    n = 1 + np.maximum(0, -(-(sizes - CHUNK) // STEP))
    bounds = np.concatenate([[0], np.cumsum(n)])
    flat = np.frombuffer(b"".join(texts) + bytes(CHUNK), np.uint8)
    begin = np.repeat(np.cumsum(sizes) - sizes, n) + STEP * (np.arange(bounds[-1]) - np.repeat(bounds[:-1], n))
    end = np.repeat(np.cumsum(sizes), n)
    rows = np.lib.stride_tricks.sliding_window_view(flat, CHUNK)[begin]
    short = np.flatnonzero(begin + CHUNK > end)
    rows[short] *= np.arange(CHUNK) < (end - begin)[short, None]
    return rows, bounds


def convolved(net: Net, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each chunk's largest value of each filter, without the offset, and where it is."""
    best, place = np.empty((len(rows), FILTERS), net.filters.dtype), np.empty((len(rows), FILTERS), np.int64)
    m, wide = WIDTH // STRIDE, STRIDE * DIM
    for i in range(0, len(rows), BLOCK):
        x = net.bytes[rows[i : i + BLOCK]].reshape(-1, CHUNK // STRIDE, wide)
        n = x.shape[1] - m + 1
        values = sum(np.matmul(x[:, j : j + n], net.filters[j * wide : (j + 1) * wide]) for j in range(m))
        place[i : i + BLOCK] = at = values.argmax(1)
        best[i : i + BLOCK] = np.take_along_axis(values, at[:, None], 1)[:, 0]
    return best, place


def largest(net: Net, rows: np.ndarray) -> np.ndarray:
    """``convolved`` without the places."""
    best = np.empty((len(rows), FILTERS), net.filters.dtype)
    m, wide = WIDTH // STRIDE, STRIDE * DIM
    for i in range(0, len(rows), BLOCK):
        x = net.bytes[rows[i : i + BLOCK]].reshape(-1, CHUNK // STRIDE, wide)
        n = x.shape[1] - m + 1
        values = np.matmul(x[:, :n], net.filters[:wide])
        for j in range(1, m):
            values += np.matmul(x[:, j : j + n], net.filters[j * wide : (j + 1) * wide])
        best[i : i + BLOCK] = values.max(1)
    return best


class Combined(NamedTuple):
    p: np.ndarray  # of each text
    features: np.ndarray  # of each text: maxima, then means
    seen: np.ndarray  # of each chunk: the filters' maxima
    mixed: np.ndarray  # of each chunk


def combined(net: Net, best: np.ndarray, bounds: np.ndarray) -> Combined:
    """From chunks' largest values to texts' probabilities."""
    seen = np.maximum(best + net.offsets, 0)
    mixed = np.maximum(seen @ net.mix + net.mix_offsets, 0)
    top = np.maximum.reduceat(mixed, bounds[:-1], axis=0)
    mean = np.add.reduceat(mixed, bounds[:-1], axis=0) / np.diff(bounds)[:, None]
    features = np.concatenate([top, mean], 1)
    return Combined(1 / (1 + np.exp(-np.clip(features @ net.out + net.bias, -30, 30))), features, seen, mixed)


def gradient(net: Net, rows: np.ndarray, bounds: np.ndarray, wanted: np.ndarray, weight: np.ndarray) -> Net:
    """Of the weighted log loss of some texts, for every parameter."""
    best, place = convolved(net, rows)
    c = combined(net, best, bounds)
    d = ((c.p - wanted) * weight).astype(np.float32) / np.float32(weight.sum())
    of_text = np.repeat(np.arange(len(wanted)), np.diff(bounds))
    # of equal maxima the first chunk counts
    is_top = c.mixed == c.features[of_text, :MIXED]
    run = np.cumsum(is_top, 0)
    before = np.concatenate([np.zeros((1, MIXED), run.dtype), run])[bounds[:-1]]
    is_top &= run == before[of_text] + 1
    to_mean = (d / np.diff(bounds).astype(np.float32))[:, None] * net.out[MIXED:]
    h = (to_mean[of_text] + is_top * (d[:, None] * net.out[:MIXED])[of_text]) * (c.mixed > 0)
    g = (h @ net.mix.T) * (c.seen > 0)
    bytes_ = rows[np.arange(len(rows))[:, None, None], (place * STRIDE)[:, :, None] + np.arange(WIDTH)]  # chunk, filter, place
    windows = net.bytes[bytes_].reshape(len(rows), FILTERS, WIDTH * DIM)
    d_filters = np.einsum("cf,cfk->kf", g, windows, optimize=True)
    back = (g[:, :, None] * net.filters.T).reshape(-1, DIM)
    flat = bytes_.ravel()
    d_bytes = np.stack([np.bincount(flat, back[:, k], 256) for k in range(DIM)], 1)
    return Net(d_bytes.astype(np.float32), d_filters, g.sum(0), c.seen.T @ h, h.sum(0), d @ c.features, np.array([d.sum()], np.float32))


def learned(texts: list[bytes], wanted: np.ndarray, weight: np.ndarray, seed: int = 0) -> Net:
    """Adam over shuffled batches of texts."""
    rng = np.random.default_rng(seed)
    net = Net.start(rng)
    first, second, step = [np.zeros_like(x) for x in net], [np.zeros_like(x) for x in net], 0
    total = EPOCHS * -(-len(texts) // TOGETHER)
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for i in range(0, len(order), TOGETHER):
            chosen = order[i : i + TOGETHER]
            rows, bounds = chunks([texts[j] for j in chosen])
            step += 1
            rate = RATE * (1 - (step - 1) / total)
            parts = []
            for k, (x, g) in enumerate(zip(net, gradient(net, rows, bounds, wanted[chosen], weight[chosen]), strict=True)):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                scaled = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                parts.append((x - np.float32(rate) * (scaled + np.float32(DECAY) * x)).astype(np.float32))
            net = Net(*parts)
    return net


def probabilities(net: Net, texts: list[bytes]) -> np.ndarray:
    rows, bounds = chunks(texts)
    return combined(net, largest(net, rows), bounds).p.astype(np.float64)


class Model(NamedTuple):
    """A network, packed; where there is none, the score of all."""

    net: bytes | None
    share: float


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from the bounded sample, in one task, as every step starts from the one before."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    known = stored(known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality")).withColumn("turn", F.xxhash64("doc_id")))
    share = known.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    if not share or share == 1:
        return Model(None, share or 0.0)
    low, high = (known.where(F.col("quality") == q).orderBy("turn", "doc_id").limit(n) for q, n in ((0, TRAIN_LOW), (1, TRAIN_HIGH)))
    # at most TRAIN_LOW + TRAIN_HIGH rows of 24 bytes
    rows = docs.where(F.length("text") <= TRAIN_LONGEST).select("doc_id", "text").join(F.broadcast(stored(low.union(high))), "doc_id")
    # of rows that repeat an id one is learned from, so the bounds hold
    rows = rows.groupBy("doc_id", "quality", "turn").agg(F.min("text").alias("text"))

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["turn", "doc_id"])
        wanted = pdf["quality"].to_numpy(np.float64)
        drawn = wanted.mean()
        if drawn in (0, 1):
            return pd.DataFrame({"net": [None]})
        weight = np.where(wanted == 1, share / drawn, (1 - share) / (1 - drawn))
        return pd.DataFrame({"net": [learned([t.encode() for t in pdf["text"]], wanted, weight).packed()]})

    found = stored(rows.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(learn, "net binary")).first()  # one row, some ten thousand bytes
    return Model(bytes(found["net"]) if found and found["net"] is not None else None, share)


def _pieces(texts: Iterator[bytes], longest: int = 1 << 20) -> Iterator[list[bytes]]:
    """Texts in lists of about so many bytes; a longer one is a list of its own."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > longest:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def score(text: Column, model: Model) -> Column:
    """The probability of label 1."""
    packed = model.net

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        net = Net.unpacked(packed)
        for texts in batches:
            found = [probabilities(net, part) for part in _pieces(("" if t is None else t).encode() for t in texts)]
            yield pd.Series(np.concatenate(found) if found else [], dtype="float64")

    return of(text) if packed else F.lit(model.share)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), train(docs, labels)).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op11_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
