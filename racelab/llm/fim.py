"""Fill-in-the-middle: a text is cut at two line ends, and its middle is moved behind prefix and suffix.

A text is laid out in fixed blocks of bytes. A Fenwick tree over the blocks holds how many units (lines with their line
feed; the last may lack it) end in each block and how many code points begin there. Binary lifting descends to the block
in which the wanted unit ends, summing code points on the way; only this block is searched for the place itself.

Where a row is cut and in which form depends on its doc_id alone: 8-digit groups of sha256("<seed>:<doc_id>"). A null
doc_id counts as an empty one. Null and empty texts, and texts in which a marker occurs, stay plain: the output is the
text, null becomes empty. Very long texts cost a table of their blocks. Rows that repeat an id are cut alike, each by
its own text; columns other than doc_id and text aren't read, so their names don't matter. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelab.llm.bpe import slices
from racelab.llm.common import table

SEED, RATE, SPM_RATE = 7, 100, 50
#: Bytes of a block.
BLOCK = 1024


class Markers(NamedTuple):
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


class BlockTree:
    """Fenwick tree over a text's blocks: unit ends and code points."""

    def __init__(self, text: bytes, block: int = BLOCK):
        self.data, self.block = np.frombuffer(text, np.uint8), block
        if not len(text):
            self.units, self.points, self.n = [0], [0], 0
            return
        starts = np.arange(0, len(text), block)
        units = np.add.reduceat(self.data == 10, starts, dtype=np.int64)
        units[-1] += self.data[-1] != 10
        points = np.add.reduceat(self._begins(self.data), starts, dtype=np.int64)
        self.n = int(units.sum())
        self.units, self.points = self._tree(units), self._tree(points)

    @staticmethod
    def _begins(data: np.ndarray) -> np.ndarray:
        return (data & 0xC0) != 0x80

    @staticmethod
    def _tree(counts: np.ndarray) -> list[int]:
        tree = [0, *counts.tolist()]
        for i in range(1, len(tree)):
            if (up := i + (i & -i)) < len(tree):
                tree[up] += tree[i]
        return tree

    def end_of(self, k: int) -> tuple[int, int]:
        """Bytes and code points up to the end of the k-th unit, from 1 on; nothing for 0."""
        if k == 0:
            return 0, 0
        at, before, step = 0, 0, 1 << (len(self.units) - 1).bit_length()
        while step:
            if at + step < len(self.units) and self.units[at + step] < k:
                at += step
                k -= self.units[at]
                before += self.points[at]
            step >>= 1
        inside = self.data[at * self.block : (at + 1) * self.block]
        ends = np.flatnonzero(inside == 10)
        upto = int(ends[k - 1]) + 1 if k <= len(ends) else len(inside)
        return at * self.block + upto, before + int(np.count_nonzero(self._begins(inside[:upto])))


def cut(text: bytes, doc_id: object, seed: int, rate: int, spm_rate: int, markers: Markers) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, code points of prefix and of middle, output) of one text."""
    tree = BlockTree(text)
    drawn = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(drawn[i : i + 8], 16) for i in range(0, 32, 8))
    p, s, m = (x.encode() for x in markers)
    if not text or p in text or s in text or m in text or h3 % 100 >= rate:
        return tree.n, "plain", None, None, text
    first, second = sorted((h1 % (tree.n + 1), h2 % (tree.n + 1)))
    (a, a_points), (b, b_points) = tree.end_of(first), tree.end_of(second)
    if h4 % 100 < spm_rate:
        return tree.n, "spm", a_points, b_points - a_points, b"".join((s, text[b:], p, text[:a], m, text[a:b]))
    return tree.n, "psm", a_points, b_points - a_points, b"".join((p, text[:a], s, text[b:], m, text[a:b]))


def transformed(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE, markers: Markers = Markers()) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row.

    ``rate`` of 100 texts are cut, ``spm_rate`` of 100 of these with the suffix first. A marker must not be empty, nor
    begin with what another ends with: otherwise where one begins wouldn't be certain.
    """
    tails = lambda x: (x[i:] for i in range(1, len(x)))
    meet = any(y.startswith(e) for x in markers for y in markers for e in tails(x)) or any(x in y for i, x in enumerate(markers) for j, y in enumerate(markers) if i != j)
    if not all(markers) or meet:
        raise ValueError("markers overlap")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in slices(batch)):
            texts = part.column("text").cast(pa.binary())
            rows = [cut(t.as_py() or b"", i, seed, rate, spm_rate, markers) for t, i in zip(texts, part.column("doc_id").to_pylist(), strict=True)]
            n, forms, before, middle, out = zip(*rows, strict=True) if rows else ((),) * 5
            columns = [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(forms, pa.string()), pa.array(before, pa.int64()), pa.array(middle, pa.int64()), pa.array(out, pa.binary()).view(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, markers: Markers = Markers()) -> Column:
    """The text that ``transformed`` was given."""
    p, s, m = (re.escape(x) for x in markers)
    psm = F.regexp_replace(output, f"(?s)^{p}(.*?){s}(.*?){m}(.*)$", "$1$3$2")
    spm = F.regexp_replace(output, f"(?s)^{s}(.*?){p}(.*?){m}(.*)$", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    rows = transformed(table(spark, sf_dir, "documents"))
    digest = lambda text: F.sha2(F.encode(text, "UTF-8"), 256)
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )
