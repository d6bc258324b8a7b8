"""Benchmark decontamination by winnowing, with DataFrame functions only.

A window is ``size`` consecutive words of a benchmark item; an item with fewer words, but not none, is one window of
its own size. For each size t among the windows, texts are hashed in k-grams, k = ceil(t / 2), and each run of
t - k + 1 of them keeps its smallest hash: the fingerprint. Equal windows have equal fingerprints, so every shared
span of t words shares one. Fingerprints of documents and windows are joined, and each hit is extended: the document's
words around it have to be the window's words.

One scan hashes all texts, for all sizes; what leaves it are a row with the number of words for each document and rows
for fingerprints that met. Only documents with such a row are read again, to be extended. Rows are known by a hash of
their doc_id and text, so neither repeated nor missing doc_ids gather in one group. Spark broadcasts the stored tables
of fingerprints and candidates only while their size on disk is below its threshold.

Words are A-Z in lower case, split at ASCII characters other than digits and letters. Null and empty texts have no
words; they are never hit. Repeated rows are judged one by one if their doc_ids differ; rows with equal doc_ids (null
among them) are each judged by their own text. An empty benchmark hits nothing. Windows of an item without an id hit
words but count for no item. Columns besides doc_id and text (item_id and text) aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelab.llm.common import ascii_lower, let, stored, table

SIZE = 10
#: All ASCII characters but digits and letters.
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text as they are written; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAKS), "")


def _grams(hashes: Column, k: int) -> Column:
    """A hash of each run of k word hashes."""
    if k == 1:
        return hashes

    def of(all_: Column) -> Column:
        grams = F.transform(all_, lambda x, i: F.xxhash64(x, *(F.get(all_, i + d) for d in range(1, k))))
        return F.slice(grams, 1, F.greatest(F.size(all_) - (k - 1), F.lit(0)))

    return let(hashes, of)


def _least(grams: Column, width: int) -> Column:
    """For each run of ``width`` k-grams its smallest hash."""

    def of(all_: Column) -> Column:
        smallest = F.transform(all_, lambda x, i: F.least(x, *(F.get(all_, i + d) for d in range(1, width)))) if width > 1 else all_
        return F.slice(smallest, 1, F.greatest(F.size(all_) - (width - 1), F.lit(0)))

    return let(grams, of)


def _word_hashes(ws: Column) -> Column:
    # lower() joins at least what A-Z in lower case joins; the words themselves are compared later
    return F.transform(ws, lambda w: F.xxhash64(F.lower(w)))


def fingerprints(hashes: Column, size: int) -> Column:
    """Winnowing: an array of (hash, place) of the k-grams that are smallest in some window of ``size`` words."""
    k = (size + 1) // 2
    width = size - k + 1

    def chosen(grams: Column, least: Column) -> Column:
        # k-gram j is in the windows j - width + 1 ... j; their smallest hashes are at most its own
        def struct(g: Column, j: Column) -> Column:
            nearest = [F.when(j >= d, F.get(least, F.greatest(j - d, F.lit(0)))) for d in range(width)]
            top = F.greatest(*nearest) if width > 1 else nearest[0]
            return F.when(g == top, F.struct(g.alias("hash"), j.alias("place")))

        return F.filter(F.transform(grams, struct), lambda s: s.isNotNull())

    return let(_grams(hashes, k), lambda g: let(_least(g, width), lambda m: chosen(g, m)))


def windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """(item, size, window) of every window; equal ones of an item once."""
    cut = benchmark.select(F.col("item_id").cast("string").alias("item"), words(ascii_lower(F.col("text"))).alias("words")).where(F.size("words") > 0)
    cut = cut.withColumn("n", F.least(F.size("words"), F.lit(size)))
    starts = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("n") + 1))
    window = F.concat_ws(" ", F.slice("words", F.col("at"), F.col("n"))).alias("window")
    return cut.select("item", "n", "words", starts.alias("at")).select("item", F.col("n").alias("size"), window).distinct()


def window_fingerprints(found: DataFrame, sizes: list[int]) -> DataFrame:
    """Each window's own fingerprint: (size, hash, shift, window); shift is its first place in the window."""
    out = None
    for t in sizes:
        k = (t + 1) // 2
        grams = _grams(_word_hashes(F.split("window", " ")), k)
        smallest = let(grams, lambda g: F.struct(F.array_min(g).alias("hash"), (F.array_position(g, F.array_min(g)) - 1).cast("int").alias("shift")))
        of_size = found.where(F.col("size") == t).select("size", "window").distinct()
        of_size = of_size.select("size", smallest.alias("f"), "window").select("size", "f.hash", "f.shift", "window")
        out = of_size if out is None else out.unionByName(of_size)
    return out


def _row_key() -> Column:
    return F.xxhash64("doc_id", "text").alias("key")


def _judged(docs: DataFrame, benchmark: DataFrame, size: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three stored tables: (key, doc_id, n_words) of every row of ``docs``; (key, doc_id, n_words, hit, windows, row) of
    those with a candidate, where ``windows`` occur; and the benchmark's windows.
    """
    found = stored(windows(benchmark, size))
    sizes = sorted(r["size"] for r in found.select("size").distinct().collect())  # SIZE values at most
    own = docs.select("doc_id", "text")

    def facts_of(ws: Column) -> Column:
        # size 0: the number of words, under a hash of the row, so no two rows need meet
        number = F.array(F.struct(F.lit(0).alias("size"), F.xxhash64("doc_id", "text").alias("hash"), F.size(ws).alias("place")))
        if not sizes:
            return number
        tagged = lambda h, t: F.transform(fingerprints(h, t), lambda p: F.struct(F.lit(t).alias("size"), p["hash"].alias("hash"), p["place"].alias("place")))
        return let(_word_hashes(ws), lambda h: F.concat(number, *(tagged(h, t) for t in sizes)))

    # explode() would have the optimizer compute the array a second time, to filter empty ones
    facts = own.select("doc_id", _row_key(), F.explode_outer(let(words(F.col("text")), facts_of)).alias("p")).select("doc_id", "key", "p.*")
    if sizes:
        prints = stored(window_fingerprints(found, sizes))
        facts = facts.join(prints, ["size", "hash"], "left").where((F.col("size") == 0) | (F.col("place") >= F.col("shift")))
    else:
        facts = facts.withColumns({"shift": F.lit(None).cast("int"), "window": F.lit(None).cast("string")})
    facts = stored(facts.select("doc_id", "key", "size", "place", "shift", "window"))
    counts = facts.where("size = 0").select("key", "doc_id", F.col("place").cast("long").alias("n_words"))
    near = facts.where("size > 0").groupBy("key").agg(F.collect_set(F.struct((F.col("place") - F.col("shift")).alias("at"), "size", "window")).alias("near"))
    near = stored(near)
    keys = stored(near.select("key"))  # eight bytes for each candidate

    def extended(ws: Column) -> Column:
        same = F.filter(
            F.col("near"),
            lambda h: (h["at"] + h["size"] <= F.size(ws)) & (ascii_lower(F.concat_ws(" ", F.slice(ws, h["at"] + 1, h["size"]))) == h["window"]),
        )
        return let(
            same,
            lambda s: F.struct(
                F.size(ws).cast("long").alias("n_words"),
                F.array_sort(F.array_distinct(F.flatten(F.transform(s, lambda h: F.sequence(h["at"], h["at"] + h["size"] - 1))))).alias("hit"),
                F.array_distinct(F.transform(s, lambda h: h["window"])).alias("windows"),
            ),
        )

    # only candidates' texts are shuffled, to what they met: that may be much, so it is never broadcast
    given = own.withColumn("key", _row_key()).join(keys, "key", "left_semi").join(near.hint("merge"), "key")
    judged = given.select("key", "doc_id", let(words(F.col("text")), extended).alias("r")).select("key", "doc_id", "r.*", F.monotonically_increasing_id().alias("row"))
    return counts.join(keys, "key", "left_anti"), stored(judged), found


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """For every row of ``docs``: doc_id, n_words, n_hit, n_items, items (sorted), and ``hit``, the places of hit words.

    A word is hit if it lies in any occurrence of a window.
    """
    untouched, judged, found = _judged(docs, benchmark, size)
    by_row = judged.select("row", F.explode("windows").alias("window")).join(found.select("window", "item"), "window")
    items = by_row.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    touched = judged.join(items, "row", "left").select("doc_id", "n_words", "hit", F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    rest = untouched.select("doc_id", "n_words", F.array().cast("array<int>").alias("hit"), F.array().cast("array<string>").alias("items"))
    counts = F.size("hit").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items")
    return touched.unionByName(rest).select("doc_id", "n_words", *counts, "items", "hit")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """The rows of ``docs``, all columns, in whose texts no window of the benchmark occurs.

    The few rows that go are known by doc_id and a hash of doc_id and text, so nothing but these is held against all.
    """
    _, judged, _ = _judged(docs, benchmark, size)
    hit = stored(judged.where(F.size("hit") > 0).select(F.col("key").alias("_key"), F.col("doc_id").alias("_id")).distinct())
    packed = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("_doc_id"), _row_key().alias("_row_key"))
    return packed.join(hit, (F.col("_row_key") == F.col("_key")) & F.col("_doc_id").eqNullSafe(F.col("_id")), "left_anti").select("row.*")


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ') FOR i IN range(1, len(w) - least(len(w), 10) + 2)]) AS win
  FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, unnest([array_to_string(w[i:i + n - 1], ' ') FOR i IN range(1, len(w) - n + 2)]) AS win
  FROM d, sizes WHERE len(w) >= n),
hits AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT doc_id, item_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN it USING (doc_id)
"""
