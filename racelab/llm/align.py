"""Alignment of two tokenizers' tokens over a corpus, with counts of the id pairs that meet.

A text with a space before it is encoded by a byte-level vocabulary (A) and by a piece vocabulary (B, which adds the
space itself). Byte offsets where tokens of both end cut them into groups; tokens whose byte ranges overlap are linked.
An id pair's count is the number of documents, of the whole corpus, that hold it linked.

Both encoders part a text where a run of white space begins (no piece of B goes on with white space after anything else:
``PieceEncoder`` makes sure of it), so a batch is cut there and each distinct stretch is encoded and aligned once.

Counts need two passes over the corpus. The first aligns and leaves (pair, documents) for each task. The distinct pairs
are dealt into shards by hash, and each shard gets a minimal perfect hash: cascading bit tables in which a pair takes
its slot where it is alone, its index being the number of bits before. Each task adds its rows up in dense vectors over
that index, and vectors are summed as a tree, ``FAN`` at a time. The second pass aligns anew and looks counts up; the
keys stored in order of the index tell whether a pair is one of the table at all.

Tasks get the table by broadcast while it holds at most ``MOST_PAIRS`` pairs, about 17 bytes each. Beyond, they get the
most frequent ones; links of the others leave the second pass as rows and meet their counts by a join, in which a
pair has no more rows than documents, fewer than every broadcast pair. The highest count of each A id is an array as
long as the vocabulary.

Null and empty texts, and texts whose tokens of A or B don't join to the text with its space, have no tokens: all counts
are zero and the groups an empty text. Each row counts as a document of its own, whether its doc_id is repeated or null;
columns other than doc_id and text aren't read. An empty table gives no rows. Very long texts cost more in proportion;
a long stretch without white space costs what the encoders take.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelab.llm.bpe import KEPT_STRETCHES, VOCABULARY, Ids, KnownIds, slices, spread
from racelab.llm.common import stored, table
from racelab.llm.tokens import LibraryEncoder

PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Pairs of a shard, about; rows of counts that a task adds up; vectors that are summed at once.
SHARD_PAIRS, LEAF_ROWS, FAN = 1 << 15, 1 << 20, 16
#: Pairs that are broadcast at most.
MOST_PAIRS = 2_000_000
#: Pairs that a task gathers before it hands them on.
GATHERED = 1 << 20
#: Characters, about, of texts that are aligned together.
TOGETHER = 1 << 20
SPACE = "▁"


class ByteEncoder(LibraryEncoder):
    """A: ids of stretches and each id's bytes; special tokens' strings are plain text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.pieces.special, self.pieces.at_special = {}, None
        self.known = self.pieces.known(self.encode)
        byte = {s: b for b, s in enumerate(self.symbols)}
        names = {i: t for t, i in self.model.get_vocab().items()}
        self.bytes = [bytes(byte.get(c, 63) for c in names.get(i, "")) for i in range(max(names) + 1)]


class PieceEncoder:
    """B: ids of stretches and each id's bytes."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        if any(re.search(rf"[^{SPACE}]{SPACE}|.\n", name) for name in names):
            raise ValueError("pieces of this vocabulary go on with white space after other characters")
        self.bytes = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace(SPACE, " ").encode() for i, n in enumerate(names)]
        self.space = self.model.piece_to_id(SPACE)
        self.known = KnownIds(self.encode, KEPT_STRETCHES)

    def encode(self, stretches: pa.StringArray) -> Ids:
        each = []
        texts = stretches.to_pylist()
        # the model puts a space before what it gets: it stands for a stretch's own, or is taken off again
        for text, ids in zip(texts, self.model.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1), strict=True):
            each.append(([self.space] if text == " " else ids) if text[0] == " " else ids[1:])
        return np.array([i for ids in each for i in ids], np.uint32), np.fromiter(map(len, each), np.int64, len(each))


@lru_cache(maxsize=2)
def encoders(a: str, b: str) -> tuple[ByteEncoder, PieceEncoder, ByteTables, ByteTables]:
    """A worker's encoders and their tables, kept between tasks."""
    first, second = ByteEncoder(a), PieceEncoder(b)
    return first, second, ByteTables(first.bytes, "|"), ByteTables(second.bytes, ";")


class ByteTables:
    """Each id's bytes one after another, and each id written with a comma or with the last separator behind."""

    def __init__(self, each: list[bytes], last: str):
        self.sizes = np.fromiter(map(len, each), np.int64, len(each))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(each), np.uint8)
        self.written = [f"{i}{c}" for c in (",", last) for i in range(len(each))]

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[spread(self.starts, self.sizes, ids)[0]]


def _is_white(*last: np.ndarray) -> np.ndarray:
    """Whether a character of these last three bytes, the last one first, is white space."""
    c, b, a = last
    two = (b == 0xC2) & ((c == 0x85) | (c == 0xA0))
    general = (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (b == 0x81) & (c == 0x9F)
    three = (a == 0xE1) & (b == 0x9A) & (c == 0x80) | (a == 0xE2) & general | (a == 0xE3) & (b == 0x80) & (c == 0x80)
    return (c >= 9) & (c <= 13) | (c >= 28) & (c <= 32) | two | three


def stretches(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """Texts with a space before each, cut where white space begins with a space or a line feed, and where each text's
    stretches begin and the last ends."""
    spaced = pc.binary_join_element_wise("", texts, " ")
    bounds = np.frombuffer(spaced.buffers()[1], np.int32, len(spaced) + 1, 4 * spaced.offset)
    data = np.frombuffer(spaced.buffers()[2], np.uint8)[: bounds[-1]]
    at = np.flatnonzero((data == 32) | (data == 10))
    before = [data[np.maximum(at - d, 0)] for d in (1, 2, 3)]
    cut = np.zeros(len(data) + 1, bool)
    cut[at[~_is_white(*before)]] = cut[bounds] = True
    cuts = np.flatnonzero(cut).astype(np.int32)
    parts = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.tobytes()), spaced.buffers()[2])
    return parts, np.searchsorted(cuts, bounds)


class Aligned(NamedTuple):
    """A batch: distinct stretches with their groups and links, and the documents as lists of stretches.

    ``links`` are pairs, a * 2**32 + b, those of stretch i at link_at[i]:link_at[i + 1]; document d has the stretches
    codes[text_at[d]:text_at[d + 1]], none if it has no tokens.
    """

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    written: pa.StringArray | None
    links: np.ndarray
    link_at: np.ndarray
    codes: np.ndarray
    text_at: np.ndarray

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Each document's sum of a value of its stretches."""
        total = np.concatenate([[0], np.cumsum(values[self.codes])])
        return total[self.text_at[1:]] - total[self.text_at[:-1]]


def aligned_batch(texts: pa.StringArray, a_path: str, b_path: str, write: bool) -> Aligned:
    """Encodes and aligns a batch's distinct stretches; ``write``: the groups as texts, too."""
    enc_a, enc_b, of_a, of_b = encoders(a_path, b_path)
    parts, text_at = stretches(texts.fill_null(""))
    coded = parts.dictionary_encode()
    distinct, codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    (a, n_a), (b, n_b) = enc_a.known.of(distinct), enc_b.known.of(distinct)
    a, b = a.astype(np.int64), b.astype(np.int64)

    # stretches whose tokens don't join to their bytes have none, nor have the documents that hold them
    offsets = np.frombuffer(distinct.buffers()[1], np.int32, len(distinct) + 1, 4 * distinct.offset).astype(np.int64)
    data = np.frombuffer(distinct.buffers()[2], np.uint8) if len(distinct) else np.empty(0, np.uint8)
    sizes = np.diff(offsets)
    stretch_of = {}
    ok = np.ones(len(distinct), bool)
    for name, ids, n, tables in (("a", a, n_a, of_a), ("b", b, n_b, of_b)):
        of = np.repeat(np.arange(len(distinct)), n)
        stretch_of[name] = of
        long = np.bincount(of, tables.sizes[ids], len(distinct)).astype(np.int64)
        same = long == sizes
        kept = np.flatnonzero(same)
        there = tables.joined(ids[same[of]])
        wrong = there != data[spread(offsets[:-1], sizes, kept)[0]]
        if wrong.any():
            same[np.repeat(kept, sizes[kept])[wrong]] = False
        ok &= same
    a, b = a[ok[stretch_of["a"]]], b[ok[stretch_of["b"]]]
    in_a, in_b = stretch_of["a"][ok[stretch_of["a"]]], stretch_of["b"][ok[stretch_of["b"]]]
    n_a, n_b = np.where(ok, n_a, 0), np.where(ok, n_b, 0)

    # all stretches one after another: both sides have the same bytes
    end_a, end_b = np.cumsum(of_a.sizes[a]), np.cumsum(of_b.sizes[b])
    meets = np.zeros((end_a[-1] if len(end_a) else 0) + 1, np.int8)
    meets[end_a] = 1
    meets[end_b] += 1
    common = np.flatnonzero(meets == 2)
    group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
    n_groups = np.bincount(in_a[meets[end_a] == 2], minlength=len(distinct))
    first = np.searchsorted(end_b, end_a - of_a.sizes[a], "right")
    each = np.searchsorted(end_b, end_a, "left") - first + 1
    partners, _ = spread(first, each, np.arange(len(a)))
    links = (np.repeat(a, each) << 32) + b[partners]
    link_at = np.concatenate([[0], np.cumsum(np.bincount(in_a, each, len(distinct)).astype(np.int64))])

    written = None
    if write:
        last_a = np.append(group_a[1:] != group_a[:-1], True) if len(a) else np.empty(0, bool)
        last_b = np.append(group_b[1:] != group_b[:-1], True) if len(b) else np.empty(0, bool)
        shift = len(of_a.written)
        ids = np.concatenate([a + last_a * len(of_a.sizes), shift + b + last_b * len(of_b.sizes)])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        tokens = pa.array(of_a.written + of_b.written, pa.string()).take(pa.array(ids[order]))
        ends = np.concatenate([[0], np.cumsum(n_a + n_b)]).astype(np.int32)
        written = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), tokens), "")

    empty = pc.equal(pc.binary_length(texts.fill_null("")), 0).to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~ok[codes])])
    none = empty | (bad[text_at[1:]] > bad[text_at[:-1]])
    if none.any():
        n = np.where(none, 0, np.diff(text_at))
        codes = codes[spread(text_at[:-1], n, np.arange(len(n)))[0]]
        text_at = np.concatenate([[0], np.cumsum(n)])
    return Aligned(n_a, n_b, n_groups, written, links, link_at, codes, text_at)


def _distinct(values: np.ndarray) -> np.ndarray:
    ordered = np.sort(values)
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])] if len(ordered) else ordered


def _distinct_links(batch: Aligned) -> tuple[np.ndarray, np.ndarray]:
    """The batch's distinct pairs, and for each link of its stretches which of them it is."""
    return np.unique(batch.links, return_inverse=True)


def document_counts(batch: Aligned) -> tuple[np.ndarray, np.ndarray]:
    """The batch's distinct pairs and in how many of its documents each is linked."""
    pairs, which = _distinct_links(batch)
    n_docs, n_stretches = len(batch.text_at) - 1, len(batch.n_a)
    doc = np.repeat(np.arange(n_docs), np.diff(batch.text_at))
    held = _distinct(doc * n_stretches + batch.codes)  # each document's distinct stretches
    doc, stretch = held // max(n_stretches, 1), held % max(n_stretches, 1)
    at, ends = spread(batch.link_at[:-1], np.diff(batch.link_at), stretch)
    seen = _distinct(np.repeat(doc, np.diff(ends)) * len(pairs) + which[at])
    return pairs, np.bincount(seen % max(len(pairs), 1), minlength=len(pairs))


def task_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The first pass: (part, pair, n), in how many documents of a part of the corpus a pair is linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts = np.empty(0, np.int64), np.empty(0, np.int64)

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], ["pair", "n"])

        for part in (part for batch in batches for part in slices(batch, together=TOGETHER)):
            new, n = document_counts(aligned_batch(part.column("text"), a_path, b_path, False))
            pairs, at = np.unique(np.concatenate([pairs, new]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, n]), len(pairs)).astype(np.int64)
            if len(pairs) > GATHERED:
                yield rows()
                pairs, counts = pairs[:0], counts[:0]
        yield rows()

    found = docs.select("text").mapInArrow(run, "pair long, n long").where("n > 0")
    return found.select(F.spark_partition_id().alias("part"), "pair", "n")


_MULTIPLY = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """Another hash of the keys for each level; within a level different keys have different ones."""
    x = keys.astype(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * _MULTIPLY[0]
    x = (x ^ (x >> np.uint64(27))) * _MULTIPLY[1]
    return x ^ (x >> np.uint64(31))


class PerfectHash(NamedTuple):
    """Minimal perfect hash of a shard's keys: bits of all levels, slots of each level, and the keys by index."""

    bits: np.ndarray
    slots: np.ndarray
    keys: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        left, bits, slots, taken, base = keys, [], [], [], 0
        while len(left):
            m = max(2 * len(left), 64)
            slot = (_mixed(left, len(slots)) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(slot, minlength=m) == 1
            bits.append(alone)
            taken.append((base + slot[alone[slot]], left[alone[slot]]))
            left, base = left[~alone[slot]], base + m
            slots.append(m)
        at = np.concatenate([x for x, _ in taken]) if taken else np.empty(0, np.int64)
        placed = np.concatenate([x for _, x in taken]) if taken else keys
        return cls(np.concatenate(bits) if bits else np.empty(0, bool), np.array(slots, np.int64), placed[np.argsort(at)])


class PairTable:
    """The perfect hashes of some shards as one: the index of each key, -1 for any that isn't one of theirs."""

    def __init__(self, n_shards: int, shards: dict[int, PerfectHash]):
        self.n_shards = n_shards
        levels = max((len(s.slots) for s in shards.values()), default=0)
        self.slots = np.zeros((levels, n_shards), np.int64)
        self.base = np.zeros((levels, n_shards), np.int64)
        at = 0
        for number, s in sorted(shards.items()):
            n = len(s.slots)
            self.slots[:n, number] = s.slots
            self.base[:n, number] = at + np.cumsum(s.slots) - s.slots
            at += len(s.bits)
        none = [np.empty(0, bool)]
        bits = np.concatenate([s.bits for _, s in sorted(shards.items())] or none)
        words = np.zeros((len(bits) + 63) // 64 * 8, np.uint8)
        packed = np.packbits(bits, bitorder="little")
        words[: len(packed)] = packed
        self.words = words.view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.keys = np.concatenate([s.keys for _, s in sorted(shards.items())] or [np.empty(0, np.int64)])

    def index(self, keys: np.ndarray) -> np.ndarray:
        found, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        shard = shard_of(keys, self.n_shards)
        for level in range(len(self.slots)):
            m = self.slots[level][shard[open_]]
            open_, m = open_[m > 0], m[m > 0]
            bit = self.base[level][shard[open_]] + (_mixed(keys[open_], level) % m.astype(np.uint64)).astype(np.int64)
            word, inside = self.words[bit >> 6], (bit & 63).astype(np.uint64)
            hit = (word >> inside) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << inside) - np.uint64(1))
            found[open_[hit]] = (self.before[bit >> 6] + np.bitwise_count(below))[hit]
            open_ = open_[~hit]
        known = np.flatnonzero(found >= 0)
        found[known[self.keys[found[known]] != keys[known]]] = -1
        return found


def shard_of(keys: np.ndarray, n_shards: int) -> np.ndarray:
    return (_mixed(keys, -2) % np.uint64(n_shards)).astype(np.int64)


def _unpacked(row: pd.Series) -> PerfectHash:
    slots = np.asarray(row["slots"], np.int64)
    bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=int(slots.sum()), bitorder="little").astype(bool)
    return PerfectHash(bits, slots, np.frombuffer(row["keys"], np.int64))


def with_shard(rows: DataFrame, n_shards: int) -> DataFrame:
    """``rows`` with the shard of their pair."""

    @F.pandas_udf("int")
    def shard(pairs: pd.Series) -> pd.Series:
        return pd.Series(shard_of(pairs.to_numpy(np.int64), n_shards), dtype="int32")

    return rows.withColumn("shard", shard("pair"))


def perfect_hashes(pairs: DataFrame) -> DataFrame:
    """(shard, slots, bits, keys, counts) of distinct pairs, given as (shard, pair, n); counts are n by index."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        made = PerfectHash.of(pdf["pair"].to_numpy(np.int64))
        counts = pdf.set_index("pair")["n"].reindex(made.keys).to_numpy(np.int64)
        row = (int(pdf["shard"].iloc[0]), made.slots.tolist(), np.packbits(made.bits, bitorder="little").tobytes(), made.keys.tobytes(), counts.tobytes())
        return pd.DataFrame([row], columns=["shard", "slots", "bits", "keys", "counts"])

    return pairs.groupBy("shard").applyInPandas(build, "shard int, slots array<long>, bits binary, keys binary, counts binary")


def pair_counts(counted: DataFrame, shard_pairs: int = SHARD_PAIRS, leaf_rows: int = LEAF_ROWS, fan: int = FAN) -> tuple[DataFrame, int, int]:
    """(pair, n) of the whole corpus from the tasks' rows, how many pairs there are, and in how many shards."""
    distinct = stored(counted.select("pair").distinct())
    n_pairs = distinct.count()
    n_shards = -(-n_pairs // shard_pairs) or 1
    hashes = stored(perfect_hashes(with_shard(distinct.withColumn("n", F.lit(0)), n_shards)).drop("counts"))
    n_branches = -(-counted.count() // (leaf_rows * n_shards)) or 1

    def leaf(rows: pd.DataFrame, hash_: pd.DataFrame) -> pd.DataFrame:
        number, branch = (int(hash_[c].iloc[0]) for c in ("shard", "branch"))
        # a table of this shard alone
        of_shard = PairTable(n_shards, {number: _unpacked(hash_.iloc[0])})
        at = of_shard.index(rows["pair"].to_numpy(np.int64))
        if len(at) and at.min() < 0:
            raise ValueError("a pair that no key is for")
        dense = np.bincount(at, rows["n"].to_numpy(), len(of_shard.keys)).astype(np.int64)
        return pd.DataFrame([(number, branch, dense.tobytes())], columns=["shard", "branch", "dense"])

    def summed(vectors: pd.DataFrame) -> pd.DataFrame:
        dense = np.sum([np.frombuffer(v, np.int64) for v in vectors["dense"]], axis=0)
        return pd.DataFrame([(vectors["shard"].iloc[0], vectors["branch"].iloc[0] // fan, dense.tobytes())], columns=["shard", "branch", "dense"])

    def by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, dense in zip(batch.column("keys"), batch.column("dense"), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x.as_py(), np.int64)) for x in (keys, dense)], ["pair", "n"])

    schema = "shard int, branch long, dense binary"
    branches = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_branches - 1).cast("long"))).alias("branch")
    rows = with_shard(counted.withColumn("branch", F.pmod("part", F.lit(n_branches)).cast("long")), n_shards)
    vectors = rows.groupBy("shard", "branch").cogroup(hashes.select("*", branches).groupBy("shard", "branch")).applyInPandas(leaf, schema)
    while n_branches > 1:
        vectors = vectors.groupBy("shard", F.floor(F.col("branch") / fan).alias("next")).applyInPandas(summed, schema)
        n_branches = -(-n_branches // fan)
    return stored(vectors.join(hashes.hint("merge"), "shard").select("keys", "dense").mapInArrow(by_key, "pair long, n long")), n_pairs, n_shards


def aligned(docs: DataFrame, a_path: str = VOCABULARY, b_path: str = PIECES, most_pairs: int = MOST_PAIRS, **sizes: int) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every row.

    ``groups`` has each group's ids of A and of B in order, as a1,a2|b1;a3|b2,b3. ``n_best`` counts the links whose pair
    has the highest count among the pairs of its A id, ``count_sum`` adds up the links' counts. ``sizes``: see pair_counts.
    """
    spark = docs.sparkSession
    counts, n_pairs, _ = pair_counts(stored(task_counts(docs, a_path, b_path)), **sizes)
    best_rows = stored(counts.groupBy(F.shiftright("pair", 32).cast("int").alias("a")).agg(F.max("n").alias("best")))
    best_of = best_rows.toPandas()  # a row for each id of the vocabulary at most
    least = 0
    if n_pairs > most_pairs:
        # pairs by the power of two below their count: 63 rows at most
        powers = counts.groupBy(F.floor(F.log2("n")).alias("power")).count().orderBy(F.desc("power")).toPandas()
        fit = powers["power"][powers["count"].cumsum() <= most_pairs]
        least = 1 << int(fit.iloc[-1]) if len(fit) else 1 << 62
    frequent = counts.where(F.col("n") >= least)
    n_frequent = -(-n_pairs // sizes.get("shard_pairs", SHARD_PAIRS)) or 1
    hashes = stored(perfect_hashes(with_shard(frequent, n_frequent))).toPandas()  # most_pairs pairs at most
    best = np.zeros(int(best_of["a"].max()) + 1 if len(best_of) else 1, np.int64)
    best[best_of["a"]] = best_of["best"]
    shared = spark.sparkContext.broadcast((n_frequent, hashes.to_dict("records"), best))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows, highest = shared.value
        known = PairTable(number, {r["shard"]: _unpacked(r) for r in rows})
        n = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in sorted(rows, key=lambda r: r["shard"])] or [np.empty(0, np.int64)])
        for part in (part for batch in batches for part in slices(batch, together=TOGETHER)):
            batch = aligned_batch(part.column("text"), a_path, b_path, True)
            pairs, which = _distinct_links(batch)
            at = known.index(pairs)
            count = np.where(at >= 0, n[at], 0) if len(n) else np.zeros(len(pairs), np.int64)
            is_best = (at >= 0) & (count == highest[np.minimum(pairs >> 32, len(highest) - 1)])
            by_stretch = lambda value: np.diff(np.concatenate([[0], np.cumsum(value[which])])[batch.link_at])
            each = [batch.n_a, batch.n_b, batch.n_groups, np.diff(batch.link_at), by_stretch(is_best.astype(np.int64)), by_stretch(count)]
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(batch.text_at.astype(np.int32)), batch.written.take(pa.array(batch.codes))), "")
            rest = _rest(batch, pairs, which, at)
            columns = [part.column("doc_id"), *(pa.array(batch.sums(x)) for x in each), pc.utf8_slice_codeunits(texts, 0, -1), rest]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups", "rest"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    numbers = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long"
    found = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {numbers}, groups string, rest array<struct<pair: long, links: long>>")
    if not least:
        return found.drop("rest")

    # links of the pairs that weren't broadcast; fewer documents have one of these than any that was
    found = stored(found.withColumn("row", F.monotonically_increasing_id()))
    rare = counts.where(F.col("n") < least).join(F.broadcast(best_rows), F.shiftright("pair", 32) == F.col("a"))
    links = found.select("row", F.explode("rest").alias("p")).select("row", "p.*").join(rare.hint("merge"), "pair")
    more = links.groupBy("row").agg(F.sum(F.when(F.col("n") == F.col("best"), F.col("links")).otherwise(0)).alias("more_best"), F.sum(F.col("links") * F.col("n")).alias("more_sum"))
    n_best, count_sum = (F.col(c) + F.coalesce(m, F.lit(0)) for c, m in (("n_best", "more_best"), ("count_sum", "more_sum")))
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", n_best.alias("n_best"), count_sum.alias("count_sum"), "groups"]
    return found.drop("rest").join(more, "row", "left").select(*columns)


def _rest(batch: Aligned, pairs: np.ndarray, which: np.ndarray, at: np.ndarray) -> pa.ListArray:
    """For each document its links of pairs that the table lacks: (pair, links)."""
    lacking = at < 0
    n_docs = len(batch.text_at) - 1
    bounds, found, links = np.zeros(n_docs + 1, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)
    if lacking.any():
        of_stretch = np.repeat(np.arange(len(batch.n_a)), np.diff(batch.link_at))[lacking[which]]
        of_pair = which[lacking[which]]
        n = np.bincount(of_stretch, minlength=len(batch.n_a))
        places, ends = spread(np.cumsum(n) - n, n, batch.codes)
        doc = np.repeat(np.repeat(np.arange(n_docs), np.diff(batch.text_at)), np.diff(ends))
        seen, links = np.unique(doc * len(pairs) + of_pair[places], return_counts=True)
        found = pairs[seen % len(pairs)]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(seen // len(pairs), minlength=n_docs))]).astype(np.int32)
    entries = pa.StructArray.from_arrays([pa.array(found), pa.array(links.astype(np.int64))], ["pair", "links"])
    return pa.ListArray.from_arrays(pa.array(bounds), entries)


def op13_token_alignment(spark, sf_dir: str) -> DataFrame:
    rows = aligned(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))
