"""Nulls, empty and long texts, ties, repeated rows, empty tables and extra columns, for each operator."""

import pytest

import corpus_pipeline
from racelab.llm import bpe, chat, decontam, pii, quality, secrets, simhash, tokens, toxicity, urls

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "very long words " * 20_000
ROWS = [
    (1, "one two three four five six", "en", "a", 27),
    (1, "one two three four five six", "en", "a", 27),
    (2, None, None, None, None),
    (None, "one two three four five six", "en", "a", 27),
    (None, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, LONG, "en", "a", len(LONG)),
    (5, "é😀 \x00 tab\tnew\nline 0123", "xx", "", 3),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumnsRenamed({"lang": "row", "source": "fp"}).repartition(3)


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "labels": spark.createDataFrame([(1, 1, 0), (4, 0, 1), (5, None, None), (None, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame([(7, "Two THREE four"), (8, None), (9, ""), (10, "very long words " * 4)], "item_id long, text string"),
    }


ROWWISE = {
    "quality": lambda d, t: quality.judged(d),
    "pii": lambda d, t: pii.find(d),
    "secrets": lambda d, t: secrets.find(d),
    "bpe": lambda d, t: bpe.encoded(d),
    "simhash": lambda d, t: simhash.near_duplicates(d),
    "decontam": lambda d, t: decontam.contamination(d, t["benchmark"]),
    "toxicity": lambda d, t: toxicity.scored(d, t["labels"]),
}


@pytest.mark.parametrize("name", ROWWISE)
def test_one_row_for_each(name, docs, tables):
    out = ROWWISE[name](docs, tables).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", ROWWISE)
def test_empty_table(name, docs, tables):
    assert ROWWISE[name](docs.limit(0), tables).collect() == []


def test_decontam_by_own_text(docs, tables):
    out = {(r["doc_id"], r["n_words"]): r for r in decontam.contamination(docs, tables["benchmark"]).collect()}
    assert out[1, 6]["items"] == ["7"] and out[1, 6]["hit"] == [1, 2, 3] and out[None, 6]["n_hit"] == 3
    assert out[None, 0]["n_hit"] == 0 and out[2, 0]["n_items"] == 0
    assert out[4, 60_000]["n_hit"] == 60_000 and out[4, 60_000]["items"] == ["10"]


def test_item_without_id_hits_words_only(spark):
    rows = spark.createDataFrame([(1, "x of no item y"), (2, "two three")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(None, "of no item"), (3, "two three"), (4, "two three")], "item_id long, text string")
    out = {r["doc_id"]: (r["n_hit"], r["items"]) for r in decontam.contamination(rows, benchmark).collect()}
    assert out == {1: (3, []), 2: (2, ["3", "4"])}


def test_decontam_keeps_clean_rows_of_a_hit_id(spark, tables):
    rows = spark.createDataFrame([(1, "a two three four"), (1, "clean words only"), (2, "fine"), (None, None)], "doc_id long, text string")
    assert {r["text"] for r in decontam.without_contaminated(rows, tables["benchmark"]).collect()} == {"clean words only", "fine", None}
    empty = tables["benchmark"].limit(0)
    assert decontam.without_contaminated(rows, empty).count() == 4


def test_near_dedup_keeps_one(spark, docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), (r["text"] or "")[:3]) for r in kept.collect()) == [("1", "one"), ("2", ""), ("4", "ver"), ("5", "é😀 ")]
    other = spark.createDataFrame([(5, "alone with this id and text"), (3, "same text here for two"), (5, "same text here for two")], "doc_id long, text string")
    assert sorted(r["text"][:4] for r in simhash.keep_one(other).collect()) == ["alon", "same"]
    nulls = spark.createDataFrame([(None, "x"), (None, "x"), (None, "other words stand here now")], "doc_id long, text string")
    assert simhash.keep_one(nulls).count() == 2


def test_token_files(spark, docs, tmp_path):
    for encoding in ("dictionary", "delta"):
        folder = f"file://{tmp_path}/{encoding}"
        tokens.write_tokens(docs, folder, encoding=encoding)
        rows = tokens.read_tokens(spark, folder).collect()
        assert len(rows) == len(ROWS)
        at = 0
        for r in sorted(rows, key=lambda r: r["start"]):
            assert r["start"] == at and len(r["ids"]) == r["n_tokens"] and r["ids"][-1] == tokens.END_ID
            at += r["n_tokens"]
        ids = [r["doc_id"] or -1 for r in sorted(rows, key=lambda r: r["start"])]
        assert ids == sorted(ids)
    with pytest.raises(ValueError):
        tokens.write_tokens(docs, folder, encoding="plain")
    tokens.write_tokens(docs.limit(0), f"file://{tmp_path}/empty")
    assert tokens.with_crc32(tokens.read_tokens(spark, f"file://{tmp_path}/empty")).collect() == []


def test_redaction(spark):
    rows = spark.createDataFrame([(1, "mail a.b@c.de or +1 (068) 555-2748, é 4111 1111 1111 1111."), (2, None), (3, "")], "doc_id long, text string")
    assert [r["text"] for r in pii.redacted(rows).orderBy("doc_id").collect()] == ["mail [EMAIL] or [PHONE], é [CARD].", None, ""]


def test_urls(spark):
    rows = [(1, "HTTP://A.Example.ORG/es/x?q"), (2, "x://example.org/en/12"), (3, None), (4, "no scheme"), (5, "a://b://c.com/fr/"), (6, "h://com/de/#a"), (None, "h://x.net/p"), (6, "h://com/de/#a"), (7, "h://org")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("features", urls.F.lit(1))
    out = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judged(pages).drop("score").where("page_id is not null").collect()}
    assert {(1, "a.example.org", "/es/x", "example.org/es/", "block"), (2, "example.org", "/en/12", "example.org/en/1", "block"), (6, "com", "/de/", "com/de/", "block")} <= out
    assert {x[1:4] for x in out if x[0] in (3, 4)} == {("", "", None)} and {x[1:4] for x in out if x[0] == 5} == {("b:", "//c.com/fr/", None)}
    assert {x[1:4] for x in out if x[0] == 7} == {("org", "", None)}
    assert urls.judged(pages).count() == len(rows) and urls.judged(pages.limit(0)).count() == 0
    none = urls.labelled_urls(spark).limit(0)
    assert urls.judged(pages, none, rules=()).where("verdict = 'allow' and score = 0").count() == len(rows)
    assert urls.judged(pages, urls.labelled_urls(spark).where("blocked = 1"), rules=()).where("verdict = 'block'").count() == len(rows)


def test_chat_edges(spark):
    rows = [(None, None, None, None), (1, 1, "user", "a"), (1, 1, "user", "a"), (2, None, "Assistant ", ""), (3, 1, "bot", "x" * 200_000)]
    talk = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("place", "rendered", "action", "block", "n", "state", "cost"):
        talk = talk.withColumn(name, chat.F.lit("own"))  # names that the operator uses itself
    assert chat.formatted(talk).count() == len(rows) and chat.formatted(talk.limit(0)).count() == 0
    one = "".join(r["rendered"] for r in chat.formatted(talk).where("conv_id = 1").orderBy("place").collect())
    assert one == "<|user|>\na<|end|>\n<|assistant|>\na<|end|>\n"  # relabelling costs less than a merge and an empty turn


def test_pipeline_stages(spark, tmp_path, tables):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    for name, t in tables.items():
        t.write.parquet(f"{tmp_path}/{name}.parquet")
    for start in (rows, rows.limit(0)):
        start.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)))
            assert docs.columns == (columns if name != "bpe" else ["doc_id", "n_tokens", "ids"])
        assert docs.count() <= start.count()
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
