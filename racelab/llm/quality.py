"""Line-first quality rules, with DataFrame functions only.

Each line of a text is held against rules of punctuation, navigation and boilerplate; lines that fail are removed,
and a document that loses more than ``MOST_LOST`` of its visible characters is rejected. Before that, documents with
fewer than 50 words, or with more than half their words in repeated 3-word windows, fail.

Null and empty texts have no words and fail. Rows are judged one by one, repeated ones too; all work stays within a
row, so no key is hot, and costs n log n for n words. Columns other than doc_id and text aren't read by
``judged``; ``cleaned`` keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelab.llm.common import let, table

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, WINDOW, MOST_REPEATED_PERCENT = 50, 3, 50
MOST_LOST = 0.5
#: A line of navigation has so many separators, and so many for each of its words.
SEPARATORS, SEPARATORS_PER_WORD = 3, 0.25
SEPARATOR = r"\||»|›|·|→"
#: Words with marks where prose has none: a share of a line's words.
DECORATED = r"[#*$%&<>~^=_]{2,}|[!?]{2,}"
DECORATED_PER_WORD = 0.3
#: A long line has some sentence punctuation.
LONG_LINE, SENTENCE_MARK = 25, r"[.!?,;:…。，！？]"
BOILERPLATE = (
    r"(?i)^\s*(?:licensed under\b|all rights reserved|copyright\b|©|terms of (?:use|service)|privacy policy|"
    r"(?:we|this (?:web)?site) uses? cookies|(?:accept|manage) (?:all )?cookies|sign (?:in|up)\b.{0,20}$|log ?in\b.{0,20}$|"
    r"subscribe to\b|share this\b|read more\b|click here\b|javascript (?:is|must be)\b|lorem ipsum)"
)


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def repeated_words(ws: Column, window: int = WINDOW) -> Column:
    """Words in windows that occur twice or more in the text, the first occurrence included.

    Windows are sorted by a hash and, where hashes are equal, by their words, so equal windows are neighbours.
    """

    def grams(all_: Column) -> Column:
        each = F.transform(all_, lambda w, i: F.xxhash64(w, *(F.get(all_, i + d) for d in range(1, window))))
        return F.slice(each, 1, F.greatest(F.size(all_) - (window - 1), F.lit(0)))

    def same(a: Column, b: Column) -> Column:
        equal = a["h"] == b["h"]
        for d in range(window):
            equal = equal & (a[f"w{d}"] == b[f"w{d}"])
        return equal

    def places(ordered: Column) -> Column:
        """Starts of windows equal to a neighbour, in order."""
        found = F.transform(ordered, lambda g, j: F.when(same(g, F.get(ordered, j - 1)) | same(g, F.get(ordered, j + 1)), g["i"]))
        return F.sort_array(F.filter(found, lambda i: i.isNotNull()))

    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda p, j: F.least(F.lit(window), F.coalesce(F.get(starts, j + 1) - p, F.lit(window))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def count(all_: Column, hashes: Column) -> Column:
        words_of = lambda i: [F.get(all_, i + d).alias(f"w{d}") for d in range(window)]
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), *words_of(i), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(let(placed, places), covered))

    return let(ws, lambda all_: let(grams(all_), lambda hashes: count(all_, hashes))).cast("long")


def line_fails(line: Column) -> Column:
    """Whether a line breaks a rule; lines without words don't."""

    def of(n: Column) -> Column:
        separators = F.regexp_count(line, F.lit(SEPARATOR))
        navigation = (separators >= SEPARATORS) & (separators >= n * SEPARATORS_PER_WORD)
        decorated = F.regexp_count(line, F.lit(DECORATED)) >= n * DECORATED_PER_WORD
        unpunctuated = (n >= LONG_LINE) & ~line.rlike(SENTENCE_MARK)
        return (n > 0) & (navigation | decorated | unpunctuated | line.rlike(BOILERPLATE))

    return let(F.regexp_count(line, F.lit(WORD)), of)


def clean_text(text: Column) -> Column:
    """The text without the lines that fail."""
    return F.concat_ws("\n", F.filter(F.split(text, "\n"), lambda line: ~line_fails(line)))


def visible(text: Column) -> Column:
    """Code points of a text in its words."""
    return F.length(F.regexp_replace(text, SPACE, ""))


def judged(docs: DataFrame) -> DataFrame:
    """For every row: doc_id, the counts, base_failed, lost (share of visible characters) and kept."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    ws = words(F.col("text"))
    base = docs.select(
        "doc_id",
        let(ws, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words"))).alias("w"),
        visible(text).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        visible(clean_text(text)).cast("long").alias("_left"),
    ).select("doc_id", "w.*", "word_chars", "n_symbols", "n_dup_lines", "_left")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    lost = F.when(F.col("word_chars") > 0, 1 - F.col("_left") / F.col("word_chars")).otherwise(F.lit(0.0))
    return base.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), lost.alias("lost"), (~failed & (lost <= MOST_LOST)).alias("kept"),
    )


def cleaned(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose documents are kept, all columns, with failing lines removed from their texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    verdict = let(
        words(F.col("text")),
        lambda w: (F.size(w) >= LEAST_WORDS) & (100 * repeated_words(w) <= MOST_REPEATED_PERCENT * F.size(w)),
    )
    left = clean_text(text)
    enough = visible(left) >= visible(text) * (1 - MOST_LOST)
    return docs.where(verdict & enough).withColumn("text", left)


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).drop("lost")


OP9_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, t, list_filter(string_split_regex(t, '{SPACE}'), lambda x: x <> '') AS ws, string_split(t, chr(10)) AS ls,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{WORD}')) AS full_ls
  FROM d),
g AS (
  SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, unnest([array_to_string(ws[i:i + 2], ' ') FOR i IN range(1, len(ws) - 1)]) AS g
  FROM w WHERE len(ws) >= 3),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM c WHERE n > 1) GROUP BY doc_id),
l AS (
  SELECT doc_id, l, len(regexp_extract_all(l, '{WORD}')) AS n, len(regexp_extract_all(l, '{SEPARATOR}')) AS seps, len(regexp_extract_all(l, '{DECORATED}')) AS decs
  FROM (SELECT doc_id, unnest(ls) AS l FROM w)),
k AS (
  SELECT doc_id, sum(CASE WHEN n > 0 AND ((seps >= {SEPARATORS} AND seps >= n * {SEPARATORS_PER_WORD}::DOUBLE) OR decs >= n * {DECORATED_PER_WORD}::DOUBLE
      OR (n >= {LONG_LINE} AND NOT regexp_matches(l, '{SENTENCE_MARK}')) OR regexp_matches(l, '{BOILERPLATE}'))
    THEN 0 ELSE length(regexp_replace(l, '{SPACE}', '', 'g')) END) AS kept_chars
  FROM l GROUP BY doc_id),
o AS (
  SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(t, '{SPACE}', '', 'g')) AS word_chars, length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols,
    len(full_ls) - len(list_distinct(full_ls)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, k.kept_chars
  FROM w LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id)),
f AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed FROM o)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND CASE WHEN word_chars > 0 THEN 1 - kept_chars / word_chars::DOUBLE ELSE 0 END <= {MOST_LOST}::DOUBLE AS kept
FROM f
"""
