"""Token ids of a corpus as Parquet files with list columns.

Documents are dealt out by ranges of their ids and sorted, so the files hold them in ascending order of doc_id (null
first; rows with equal ids by a hash of their text). Each row has its ids as a list, with dictionary encoding (50 thousand ids
take 16 bits each before compression) or, with ``encoding="delta"``, the second version of Parquet's pages and its
delta encoding. Row groups and pages have set sizes and the files have page indexes, so one can read few documents, or
only doc_id and n_tokens, without the ids.

Where a document starts in the whole corpus is a sum over all before it: each file has running sums of its own, and
one row for each file gives what comes before the file.

Pieces of text are encoded by the tokenizers library; a worker keeps those that it has met in a bounded table. Null
and empty texts have the end id alone. Columns other than doc_id and text are not read. An empty table gives files
without rows.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from racelab.llm.bpe import VOCABULARY, Ids, Pieces, byte_symbols, slices
from racelab.llm.common import shared_folder

END_ID = 0
ROW_GROUP_BYTES, PAGE_BYTES = 64 << 20, 1 << 20
SCHEMA = "part int, doc_id {}, start_in_part long, n_tokens long, ids array<int>"


#: Pieces that the library encodes in one call, parted by a byte that no merge has.
TOGETHER = 256
#: Such calls in a batch: the library's own results take much memory.
AT_ONCE = 16


class LibraryEncoder:
    """Ids by the tokenizers library's model, many pieces at once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.pieces, self.symbols = Pieces(path), byte_symbols()
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        merges = [tuple(pair) for pair in model["merges"]]
        # the model without the steps before and after, and without its table of strings, which here are long rows
        self.model = Tokenizer(BPE(model["vocab"], merges, cache_capacity=0))
        merged = {c for left, right in merges for c in left + right}
        self.part = next(chr(b) for b in range(128) if self.symbols[b] not in merged)
        self.part_id = self.model.token_to_id(self.symbols[ord(self.part)])
        self.by_byte = dict(enumerate(self.symbols))
        self.known = self.pieces.known(self.encode)

    def symbolic(self, text: str) -> str:
        """Bytes as the vocabulary writes them."""
        return text.encode().decode("latin-1").translate(self.by_byte)

    def encode(self, pieces: pa.StringArray) -> Ids:
        if not len(pieces):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        texts, part = pieces.to_numpy(zero_copy_only=False), self.part
        rows = [self.symbolic(part.join(texts[i : i + TOGETHER])) for i in range(0, len(texts), TOGETHER)]
        found = (row for i in range(0, len(rows), AT_ONCE) for row in self.model.encode_batch_fast(rows[i : i + AT_ONCE], add_special_tokens=False))
        ids = np.concatenate([np.append(np.array(row.ids, np.uint32), self.part_id) for row in found])
        # a piece ends at the part after it; it may have some of its own
        ends = np.flatnonzero(ids == self.part_id)[np.cumsum(pc.count_substring(pieces, part).to_numpy() + 1) - 1]
        return np.delete(ids, ends), np.diff(ends, prepend=-1) - 1

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after another, and where each text's begin and end."""
        return self.pieces.ids(texts, self.known)


@lru_cache(maxsize=2)
def encoder(path: str) -> LibraryEncoder:
    """A worker's encoder, kept between tasks."""
    return LibraryEncoder(path)


def write_tokens(docs: DataFrame, folder: str, path: str = VOCABULARY, end_id: int = END_ID, encoding: str = "dictionary", row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES) -> None:
    """Writes the ids of every row of ``docs`` below ``folder``, in ascending order of doc_id."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError("encoding is dictionary or delta")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, part, start = encoder(path), TaskContext.get().partitionId(), 0
        for rows in (rows for batch in batches for rows in slices(batch)):
            ids, ends = library.ids(rows.column("text"))
            ids = np.insert(ids.astype(np.int32), ends[1:], end_id)
            ends = ends + np.arange(len(ends))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(rows.num_rows, part, np.int32)), rows.column("doc_id"), pa.array(start + ends[:-1]), pa.array(np.diff(ends)),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)),
                ],
                ["part", "doc_id", "start_in_part", "n_tokens", "ids"],
            )
            start += int(ends[-1])

    # the hash parts rows with equal ids; the ranges' bounds come from a sample of keys, which should be short
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("turn"))
    ordered = keyed.repartitionByRange("doc_id", "turn").sortWithinPartitions("doc_id", "turn").drop("turn")
    ordered.mapInArrow(run, SCHEMA.format(docs.schema["doc_id"].dataType.simpleString())).write.options(
        **{
            "compression": "snappy",
            "parquet.block.size": str(row_group_bytes),
            "parquet.page.size": str(page_bytes),
            "parquet.enable.dictionary": str(encoding == "dictionary").lower(),
            "parquet.writer.version": "PARQUET_1_0" if encoding == "dictionary" else "PARQUET_2_0",
        }
    ).parquet(folder)


def read_tokens(spark: SparkSession, folder: str, id_type: str = "bigint") -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the files; start counts the ids of all documents before."""
    rows = spark.read.schema(SCHEMA.format(id_type)).parquet(folder)
    # one row for each file, which is one for each task that wrote
    sizes = rows.groupBy("part").agg(F.max(F.col("start_in_part") + F.col("n_tokens")).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    return rows.join(F.broadcast(starts), "part").select("doc_id", (F.col("before") + F.col("start_in_part")).alias("start"), "n_tokens", "ids")


def with_crc32(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): the lists become checksums of little-endian 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            ends, flat = lists.offsets.to_numpy(), memoryview(np.ascontiguousarray(lists.values.to_numpy(), "<i4")).cast("B")
            sums = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            columns = [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), shared_folder(spark)
    write_tokens(docs, folder)
    return with_crc32(read_tokens(spark, folder))
