"""Byte-level BPE encoding and decoding with a public vocabulary file.

Encoding splits a text at its special tokens and by the vocabulary's public pattern. A piece's bytes form a doubly
linked list of symbols; a priority queue holds the merge rank of each neighbouring pair, the lowest rank is merged
first and the leftmost of equal ranks; entries whose symbols have meanwhile changed are skipped as stale. Decoding
joins the vocabulary's byte strings. Pieces that occur often are kept in a bounded table of each worker.

A batch of texts is cut at its spaces first, wherever the pattern parts pieces anyway, and each distinct stretch between
them is looked up once; the texts' ids are gathered from those.

Null and empty texts have no tokens and decode to an empty text. Rows with equal ids stay as they are; other columns
than doc_id and text aren't read. Very long pieces cost n log n.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: Pieces, and stretches of several, whose ids a worker keeps.
KEPT_PIECES, KEPT_STRETCHES = 300_000, 200_000
#: Characters, about, of the texts that are encoded together.
TOGETHER = 2 << 20
#: White space as the vocabulary's pattern has it, without and with the space.
BREAKS = r"\t-\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WHITE = rf" {BREAKS}"
#: A space that may stand inside a piece: after white space, and with more of it or nothing behind.
INNER_SPACE = rf"[{WHITE}] (?:[{WHITE}]|$)"
#: White space that parts stretches which are split together, and stretches that can't be.
PART, ODD = "\x85", rf"^ ?$|^ [{WHITE}]|^[{BREAKS}]|[{WHITE}]$|\x{{85}}"


def byte_symbols() -> list[str]:
    """The character by which the vocabulary writes each byte: printable ones as they are, the others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shifted = iter(range(256, 512))
    return [chr(b if b in plain else next(shifted)) for b in range(256)]


#: Ids of several strings: all one after another, and how many each has.
Ids = tuple[np.ndarray, np.ndarray]


def spread(starts: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the chosen ranges' members, one range after another, and where each range begins and the last ends."""
    n = sizes[chosen]
    ends = np.concatenate([[0], np.cumsum(n)])
    return np.repeat(starts[chosen] - ends[:-1], n) + np.arange(ends[-1]), ends


class KnownIds:
    """A bounded table of strings' ids; encodes what it lacks and, once full, keeps what was wanted last."""

    def __init__(self, encode: Callable[[pa.StringArray], Ids], kept: int, longest: int = 64):
        self.encode, self.kept, self.longest = encode, kept, longest
        self._set(pa.array([], pa.string()), np.empty(0, np.uint32), np.empty(0, np.int64))

    def _set(self, strings: pa.StringArray, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.strings, self.ids, self.sizes, self.starts = strings, ids, sizes, np.cumsum(sizes) - sizes

    def of(self, wanted: pa.StringArray) -> Ids:
        """The ids of distinct strings."""
        at = pc.index_in(wanted, value_set=self.strings).fill_null(-1).to_numpy()
        lacking = at < 0
        if lacking.any():
            new = wanted.filter(pa.array(lacking))
            ids, sizes = self.encode(new)
            at = at.copy()
            at[lacking] = len(self.strings) + np.arange(len(new))
            self._set(pa.concat_arrays([self.strings, new]), np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes]))
        places, _ = spread(self.starts, self.sizes, at)
        found, sizes = self.ids[places], self.sizes[at]
        if len(self.strings) > self.kept:
            self._set(wanted, found, sizes)
        if lacking.any() and pc.max(pc.binary_length(self.strings)).as_py() > self.longest:
            short = pc.less_equal(pc.binary_length(self.strings), self.longest)
            at = np.flatnonzero(short.to_numpy(zero_copy_only=False))
            self._set(self.strings.filter(short), self.ids[spread(self.starts, self.sizes, at)[0]], self.sizes[at])
        return found, sizes


def latin_pattern() -> re.Pattern[str]:
    """The public pattern for texts of the first 256 characters, with its classes written out: several times as fast."""

    def chars(*kinds: str) -> str:
        return "".join(re.escape(chr(c)) for c in range(256) if unicodedata.category(chr(c))[0] in kinds)

    letters, numbers, space = chars("L"), chars("N"), r"\t-\r \x85\xa0"
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+|[{space}]+(?![^{space}])|[{space}]+")


class Pieces:
    """Splits texts into special tokens and pieces as the vocabulary file says."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.at_special = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if self.special else None
        self.pattern, self.latin = regex.compile(public_tokenizers.PATTERN), latin_pattern()

    def split(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.pattern.findall(text)
        return self.latin.findall(text)

    def all_of(self, text: str) -> list[str]:
        """Pieces and special tokens of a text."""
        if self.at_special is None or not self.at_special.search(text):
            return self.split(text)
        return [piece for part in self.at_special.split(text) for piece in ([part] if part in self.special else self.split(part))]

    def whole(self, texts: pa.Array) -> np.ndarray:
        """Which texts can't be cut at every space: a space is inside a piece, or a special token occurs."""
        found = pc.match_substring_regex(texts, INNER_SPACE)
        for token in self.special:
            found = pc.or_(found, pc.match_substring(texts, token))
        return found.to_numpy(zero_copy_only=False)

    def of_stretches(self, known: KnownIds) -> Callable[[pa.StringArray], Ids]:
        """Encodes stretches of text that begin and end where pieces do, and special tokens, by their pieces' ids."""

        def encode(stretches: pa.StringArray) -> Ids:
            odd = self.whole(stretches) | pc.match_substring_regex(stretches, ODD).to_numpy(zero_copy_only=False)
            # stretches are split together, with a mark between them; odd ones, where that might change pieces, alone
            marked = self.split(PART.join(stretches.filter(pa.array(~odd)).to_numpy(zero_copy_only=False)))
            alone = [x for text in stretches.filter(pa.array(odd)).to_pylist() for x in (None, *self.all_of(text))]
            pieces = pa.array(marked + alone, pa.string()).dictionary_encode()
            codes, mark = pieces.indices.fill_null(-1).to_numpy(), pc.index(pieces.dictionary, PART).as_py()
            parts = np.flatnonzero(np.concatenate([codes[: len(marked)] == mark, codes[len(marked) :] == -1]))
            begin, upto = np.concatenate([[0], parts + 1]), np.concatenate([parts, [len(codes)]])
            if odd.all():  # nothing stands before the first mark
                begin, upto = begin[1:], upto[1:]
            order = np.argsort(odd, kind="stable")
            starts, ends = np.empty_like(begin), np.empty_like(upto)
            starts[order], ends[order] = begin, upto
            ids, sizes = known.of(pieces.dictionary)
            sizes = np.append(sizes, 0)  # a mark has no ids; it is the last code, -1
            at, bounds = spread(np.cumsum(sizes) - sizes, sizes, codes)
            n = bounds[ends] - bounds[starts]
            return ids[at][spread(bounds[starts], n, np.arange(len(n)))[0]], n

        return encode

    def beside_special(self, encode: Callable[[pa.StringArray], Ids]) -> Callable[[pa.StringArray], Ids]:
        """``encode`` for pieces that may be special tokens."""

        def run(pieces: pa.StringArray) -> Ids:
            special = pc.is_in(pieces, pa.array(self.special, pa.string())).to_numpy(zero_copy_only=False)
            if not special.any():
                return encode(pieces)
            ids, sizes = encode(pieces.filter(pa.array(~special)))
            n = np.ones(len(pieces), np.int64)
            n[~special] = sizes
            before = np.cumsum(np.where(special, 0, n))[special]
            return np.insert(ids, before, [self.special[t] for t in pieces.filter(pa.array(special)).to_pylist()]), n

        return run

    def known(self, encode: Callable[[pa.StringArray], Ids]) -> KnownIds:
        """The table of stretches' ids, by a table of the ids that ``encode`` gives for pieces."""
        return KnownIds(self.of_stretches(KnownIds(self.beside_special(encode), KEPT_PIECES)), KEPT_STRETCHES)

    def ids(self, texts: pa.Array, known: KnownIds) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after another, and where each text's begin and end; ``known`` encodes stretches."""
        texts = texts.fill_null("")
        apart = self.whole(texts)
        lists = pc.split_pattern(pc.if_else(pa.array(apart), "", texts) if apart.any() else texts, " ")
        bounds, flat = lists.offsets.to_numpy(), lists.values
        # distinct stretches: those with the space before them, those that begin a text, and whole texts
        behind, first = flat.dictionary_encode(), flat.take(pa.array(bounds[:-1])).dictionary_encode()
        n = len(behind.dictionary)
        codes = behind.indices.to_numpy().astype(np.int64)
        codes[bounds[:-1]] = n + first.indices.to_numpy()
        alone = texts.filter(pa.array(apart))
        codes[bounds[:-1][apart]] = n + len(first.dictionary) + np.arange(len(alone))
        lead = pc.binary_join_element_wise("", behind.dictionary, " ")
        found, sizes = known.of(pa.concat_arrays([lead, first.dictionary, alone]))
        at, ends = spread(np.cumsum(sizes) - sizes, sizes, codes)
        return found[at], ends[bounds]


def slices(batch: pa.RecordBatch, column: str = "text", together: int = TOGETHER) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts are about so long together; a longer text is a part of its own."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + together, "right")))
        yield batch.slice(at, upto - at)
        at = upto


class Bpe:
    """The tokenizer of a vocabulary file: ``encode`` and ``decode`` of single texts."""

    def __init__(self, path: str = VOCABULARY):
        self.pieces = Pieces(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocabulary, symbols = model["vocab"], byte_symbols()
        self.first = [vocabulary[s] for s in symbols]
        self.merges = {}
        for rank, (left, right) in enumerate(model["merges"]):
            self.merges[vocabulary[left], vocabulary[right]] = rank, vocabulary[left + right]
        byte = {s: b for b, s in enumerate(symbols)}
        names = {i: t for t, i in vocabulary.items()}
        self.bytes = {i: bytes(byte[c] for c in t) for i, t in names.items()} | {i: t.encode() for t, i in self.pieces.special.items()}
        self.known = self.pieces.known(self.merged)

    def merged(self, pieces: pa.StringArray) -> Ids:
        each = list(map(self.merge, pieces.to_pylist()))
        return np.array([i for ids in each for i in ids], np.uint32), np.fromiter(map(len, each), np.int64, len(each))

    def merge(self, piece: str) -> list[int]:
        ids = [self.first[b] for b in piece.encode()]
        n, merges = len(ids), self.merges
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = [(*found, i, ids[i], ids[i + 1]) for i in range(n - 1) if (found := merges.get((ids[i], ids[i + 1])))]
        # an entry: rank, merged id, place of the left symbol, both symbols' ids
        queue = [(rank, i, new, left, right) for rank, new, i, left, right in queue]
        heapq.heapify(queue)
        while queue:
            _, i, new, left, right = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue  # stale: one of the two is merged with another by now
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if found := merges.get((new, ids[k])):
                    heapq.heappush(queue, (found[0], i, found[1], new, ids[k]))
            h = before[i]
            if h >= 0 and (found := merges.get((ids[h], new))):
                heapq.heappush(queue, (found[0], h, found[1], ids[h], new))
        return [x for x in ids if x >= 0]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after another, and where each text's begin and end."""
        return self.pieces.ids(texts, self.known)

    def encode(self, text: str) -> bytes:
        """The ids of one text as little-endian unsigned 32-bit integers."""
        return self.ids(pa.array([text], pa.string()))[0].tobytes()

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Bpe:
    """A worker's tokenizer, kept between tasks."""
    return Bpe(path)


def encoded(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids, decoded) for every row: ids as binary, little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for part in (part for batch in batches for part in slices(batch)):
            ids, ends = bpe.ids(part.column("text"))
            packed = ids.astype("<u4").tobytes()
            each = [packed[4 * a : 4 * b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            columns = [part.column("doc_id"), pa.array(each, pa.binary()), pa.array(map(bpe.decode, each), pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids binary, decoded string")


def op6_bpe(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encoded(docs).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def token_lists(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens, ids as a list of int) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for part in (part for batch in batches for part in slices(batch)):
            ids, ends = bpe.ids(part.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(ends)), lists], ["doc_id", "n_tokens", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids array<int>")
