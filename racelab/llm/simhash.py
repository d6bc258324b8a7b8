"""SimHash near-duplicates by a self-join of binary tries.

A text's fingerprint is the bitwise majority of the XXH64 hashes of its word shingles. Two fingerprints link when
at most ``budget`` bits differ; documents reachable over links form one component.

How the join is dealt out: the 64 bits are cut into blocks, and as ``budget`` differing bits spoil ``budget`` blocks
at most, two linked fingerprints agree in some ``blocks - budget`` of them. For each such choice of blocks the
fingerprints that agree there are one subtrie, and each subtrie is joined with itself by walking pairs of its nodes
down together, adding up the bits in which their paths differ, and leaving a pair once that exceeds the budget.
Subtries with more than ``CELL`` fingerprints are cut into pairs of shards, so no task holds a hot one. A task returns
a spanning forest of the links that it found rather than all pairs, which keeps the components.

Empty and null texts have fingerprint zero and link like any other. Null ids take part; a component's id is its
smallest id that isn't null. Repeated rows stay repeated. An empty table gives an empty result. Fingerprints, roots and
hubs with very many rows are joined by broadcast, as they are few; see ``joined``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelab.llm.common import joined, stored

SHINGLE, SEED, BUDGET = 4, 42, 4
#: Fingerprints of a subtrie, or of a shard of one, that a task handles at once.
CELL = 4096
#: Subtries should have about so many fingerprints at most; with more, more blocks have to agree.
SUBTRIE = 4096
#: A table of hot subtries is broadcast up to so many rows of 28 bytes.
HOT_BROADCAST = 100_000
#: Node pairs that are expanded together, and rows of whole subtries that are.
PAIRS, ROWS = 1 << 18, 1 << 15


def fingerprint_of(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of a text as an unsigned integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(line[a:b], seed) for a, b in zip(starts[: len(last)].tolist(), last.tolist(), strict=True)]
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[i : i + (1 << 16)], "<u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    """The fingerprint of a text column, as the signed long with those bits."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        out = np.fromiter((fingerprint_of(t, shingle, seed) for t in texts), np.uint64, len(texts))
        return pd.Series(out.view(np.int64))

    return of(text)


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


class _Forest:
    """Components of positions; each one's label is its smallest position."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while len(a):
            x, y = label[a], label[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(up := label[label], label):
                label[:] = up


def trie_links(codes: np.ndarray, bounds: np.ndarray, budget: int = BUDGET) -> np.ndarray:
    """The component of each code over links within each subtrie.

    ``codes`` is sorted, without repeats, within each subtrie ``bounds[i]:bounds[i + 1]``. A trie node is a range of
    such codes that share their upper bits.
    """
    forest, ones = _Forest(len(codes)), {}
    lo, hi = bounds[:-1], bounds[1:]
    stack = [(63, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    while stack:
        bit, a0, a1, b0, b1, diff = stack.pop()
        if len(a0) > PAIRS:
            stack += [(bit, *(x[i : i + PAIRS] for x in (a0, a1, b0, b1, diff))) for i in range(0, len(a0), PAIRS)]
            continue
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        a, b = a0[single], b0[single]
        near = (a != b) & (np.bitwise_count(codes[a] ^ codes[b]) <= budget)
        forest.link(a[near], b[near])
        a0, a1, b0, b1, diff = (x[~single] for x in (a0, a1, b0, b1, diff))
        if bit < 0 or not len(a0):
            continue
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum((codes >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)])
        upto = ones[bit]
        am, bm = a1 - (upto[a1] - upto[a0]), b1 - (upto[b1] - upto[b0])
        twice = a0 != b0  # a node paired with itself has its unequal children once only
        pairs = [
            (a0, am, b0, bm, diff, np.ones(len(a0), bool)),
            (am, a1, bm, b1, diff, np.ones(len(a0), bool)),
            (a0, am, bm, b1, diff + 1, np.ones(len(a0), bool)),
            (am, a1, b0, bm, diff + 1, twice),
        ]
        keep = [(p, (p[0] < p[1]) & (p[2] < p[3]) & (p[4] <= budget) & p[5]) for p in pairs]
        stack.append((bit - 1, *(np.concatenate([p[i][k] for p, k in keep]) for i in range(5))))
    return forest.label


def _join_cells(batches: Iterator[pd.DataFrame], budget: int) -> Iterator[pd.DataFrame]:
    """Rows sorted by cell and code come in; edges of each cell's spanning forest go out."""

    def done(rows: pd.DataFrame, cell: np.ndarray) -> pd.DataFrame:
        fps = rows["fp"].to_numpy()
        bounds = np.concatenate([[0], np.flatnonzero(cell[1:]) + 1, [len(rows)]])
        label = trie_links(rows["code"].to_numpy().view(np.uint64), bounds, budget)
        child = np.flatnonzero(label != np.arange(len(label)))
        return pd.DataFrame({"u": fps[child], "v": fps[label[child]]})

    def fresh(rows: pd.DataFrame) -> np.ndarray:
        new = np.ones(len(rows), bool)
        keys = rows[["choice", "key", "i", "j"]].to_numpy()
        new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
        return new

    held: list[pd.DataFrame] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n < ROWS:
            continue
        rows = pd.concat(held, ignore_index=True)
        new = fresh(rows)
        cut = int(np.flatnonzero(new)[-1])  # the last cell may go on in the next batch
        if cut:
            yield done(rows[:cut], new[:cut])
        held, n = [rows[cut:]], len(rows) - cut
    if n:
        rows = pd.concat(held, ignore_index=True)
        yield done(rows, fresh(rows))


def _choices(budget: int, blocks: int) -> list[tuple[int, Column]]:
    """For each choice of agreeing blocks: their number of bits, and the fingerprint with those bits first."""
    size = [64 // blocks + (b < 64 % blocks) for b in range(blocks)]
    start = [sum(size[:b]) for b in range(blocks)]
    out = []
    for chosen in combinations(range(blocks), blocks - budget):
        at, parts = 64, []
        for b in [*chosen, *(b for b in range(blocks) if b not in chosen)]:
            at -= size[b]
            part = F.shiftrightunsigned("fp", start[b]).bitwiseAND(F.lit((1 << size[b]) - 1))
            parts.append(F.shiftleft(part, at))
        out.append((sum(size[b] for b in chosen), reduce(lambda x, y: x.bitwiseOR(y), parts)))
    return out


def links(fps: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Edges (u, v) between fingerprints at most ``budget`` bits apart that connect what all such pairs connect.

    ``fps`` has distinct values in its column ``fp``.
    """
    n = fps.count()
    blocks = budget + 1
    while blocks < 2 * budget and n >> (64 * (blocks - budget) // blocks) > SUBTRIE:
        blocks += 1
    rows = fps.select(
        "fp",
        F.explode(
            F.array(
                *(
                    F.struct(F.lit(i).alias("choice"), F.shiftrightunsigned(code, 64 - bits).alias("key"), code.alias("code"))
                    for i, (bits, code) in enumerate(_choices(budget, blocks))
                )
            )
        ).alias("c"),
    ).select("fp", "c.*")
    sizes = rows.groupBy("choice", "key").count().where(F.col("count") > CELL)
    hot = stored(sizes.select("choice", "key", F.ceil(F.col("count") / CELL).cast("int").alias("shards")))
    rows = rows.join(F.broadcast(hot) if hot.count() <= HOT_BROADCAST else hot, ["choice", "key"], "left")
    shard = F.pmod(F.xxhash64("code"), F.col("shards")).cast("int")
    cells = F.when(
        F.col("shards").isNotNull(),
        F.transform(
            F.sequence(F.lit(0), F.col("shards") - 1),
            lambda j: F.struct(F.least(shard, j).alias("i"), F.greatest(shard, j).alias("j")),
        ),
    ).otherwise(F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"))))
    dealt = (
        rows.select("choice", "key", F.explode(cells).alias("cell"), "code", "fp")
        .select("choice", "key", "cell.i", "cell.j", "code", "fp")
        .repartition("choice", "key", "i", "j")
        # codes compare as unsigned; a subtrie shares its upper bits, so the signed order is the same within it
        .sortWithinPartitions("choice", "key", "i", "j", "code")
    )
    return dealt.mapInPandas(lambda batches: _join_cells(batches, budget), "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; root is the smallest node reachable.

    Each round every node moves to its neighbour with the smallest hash, if smaller than its own, and edges go on
    between the places moved to. Hashes stand in random order along any path, so about half the places fall away in a
    round, also on long chains of ascending nodes; once no edge is left, all nodes of a component are in one place.
    """
    edges = stored(edges.where("u != v").select("u", "v"))
    found = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        ranked = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))
        parents = stored(both.groupBy("u").agg(F.least(ranked("u"), F.min(ranked("v"))).alias("p"), F.count("*").alias("n")).select("u", F.col("p.n").alias("p"), "n"))
        pu, pv = (parents.select(F.col("u").alias(x), F.col("p").alias(f"p{x}"), "n") for x in "uv")
        edges = stored(joined(joined(edges, pu, "u"), pv, "v").where("pu != pv").select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct())
        if found is None:
            found = parents.select(F.col("u").alias("node"), F.col("p").alias("place"))
            continue
        at = found.groupBy("place").agg(F.count("*").alias("n"))
        step = stored(parents.select(F.col("u").alias("place"), "p").join(at, "place"))
        found = stored(joined(found, step, "place", "left").select("node", F.coalesce("p", "place").alias("place")))
    if found is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    least = stored(found.groupBy("place").agg(F.min("node").alias("root"), F.count("*").alias("n")))
    return joined(found, least, "place").select("node", "root")


def near_duplicates(docs: DataFrame, budget: int = BUDGET, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, key, fp, component_id, representative) for every row; see the module's text for nulls and ties.

    ``key`` is a hash of doc_id and text. ``representative`` is the smallest fingerprint of the component: rows with
    equal values are one component, also where all ids are null.
    """
    rows = stored(docs.select("doc_id", _row_key(), fingerprint(F.col("text"), shingle).alias("fp")))
    fps = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    roots = components(links(fps.select("fp"), budget)).withColumnRenamed("node", "fp")
    fps = stored(fps.join(roots, "fp", "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root")))
    ids = stored(fps.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n")))
    whole = stored(joined(fps.withColumnRenamed("n", "copies"), ids, "root").withColumnRenamed("copies", "n"))
    return joined(rows, whole.drop("least"), "fp").select("doc_id", "key", "fp", "component_id", F.col("root").alias("representative"))


def _row_key() -> Column:
    return F.xxhash64("doc_id", "text").alias("key")


def op5_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """The rows of ``docs``, all columns, without near-duplicates: of each component the row with its id stays.

    Of rows that share that id within the component the one with the smallest hash of its text stays, and of rows that
    repeat id and text the smallest by its columns. A component whose ids are all null keeps one row. The rows that go
    are known by doc_id and a hash of doc_id and text: nothing but these is held against all texts.
    """
    found = stored(near_duplicates(docs, budget).select("doc_id", "key", "representative"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("first")
    first_of = stored(found.groupBy("representative").agg(first, F.count("*").alias("n")))
    placed = joined(found, first_of, "representative").withColumn("stays", (F.col("key") == F.col("first.key")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id")))
    rows = stored(placed.groupBy("doc_id", "key").agg(F.max("stays").alias("stays"), F.count("*").alias("n")).where("n > 1 or not stays"))
    packed = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("_doc_id"), _row_key().alias("_row_key"))
    same = (F.col("_row_key") == F.col("key")) & F.col("_doc_id").eqNullSafe(F.col("doc_id"))
    kept = packed.join(rows.select("doc_id", "key"), same, "left_anti").select("row.*")
    repeated = rows.where("stays")
    if repeated.isEmpty():
        return kept
    again = packed.join(repeated.select("doc_id", "key"), same, "left_semi").groupBy("_doc_id", "_row_key").agg(F.min("row").alias("row"))
    return kept.unionByName(again.select("row.*"))
