"""Fill-in-the-middle against a plain version, round trips and edge cases."""

import hashlib
import random
import re

import pytest

from racelab.llm import fim
from racelab.llm.common import table


def plain(text, doc_id, seed=7, rate=100, spm_rate=50):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    groups = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(groups[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(lines), "plain", None, None, text
    a, b = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < spm_rate:
        return len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ROWS = [
    (None, "a\nb"), (None, None), (1, None), (2, ""), (3, "\n"), (4, "\n\n\n"), (5, "no end"), (6, "one\n"), (6, "one\n"), (6, "an\nother"),
    (7, "has <P> in it\nx"), (8, "<M>"), (9, "<\n<P\n<S"), (10, "é😀\r\n日本\n" * 3000), (11, "x" * 50_000), (12, "$1 \\ \n$2\n"),
]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    parts = [*"ab é\n\n\r", "😀", "日本\n", "<", "P>", "$1", "\\", "x" * 300, "\n" * 40]
    return ROWS + [(i, "".join(rng.choices(parts, k=rng.randint(0, 60)))) for i in range(20, 600)]


def test_against_plain(spark, rows):
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, output string, n int").repartition(3)
    for given in ({}, {"seed": 3, "rate": 60, "spm_rate": 10}):
        out = fim.transformed(docs, **given)
        assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        key = lambda r: tuple(map(str, r))
        assert sorted(map(tuple, out.collect()), key=key) == sorted(((i, *plain(t, i, **given)) for i, t in rows), key=key)
        back = out.select("doc_id", fim.restored(fim.F.col("output"), fim.F.col("form"))).collect()
        assert sorted(map(tuple, back), key=key) == sorted(((i, t or "") for i, t in rows), key=key)
    assert fim.transformed(docs.limit(0)).collect() == []


def test_every_cut():
    text = ("é\n" * 700 + "long " * 900 + "\n\nend").encode()
    for block in (1, 7, 1024, 1 << 20):
        tree, at, points = fim.BlockTree(text, block), 0, 0
        assert tree.n == 703
        for k, line in enumerate(re.findall(rb"[^\n]*\n|[^\n]+", text), 1):
            at += len(line)
            points += len(line.decode())
            assert tree.end_of(k) == (at, points)
        assert tree.end_of(0) == (0, 0)


def test_own_markers(spark):
    marks = fim.Markers("[pre]", "[suf]", "[mid]")
    docs = spark.createDataFrame([(i, "a\n<P>b\nc\n") for i in range(30)], "doc_id long, text string")
    out = fim.transformed(docs, markers=marks)
    assert {r["form"] for r in out.collect()} == {"psm", "spm"}
    assert {r[0] for r in out.select(fim.restored(fim.F.col("output"), fim.F.col("form"), marks)).collect()} == {"a\n<P>b\nc\n"}
    for bad in (("aba", "x", "y"), ("", "x", "y"), ("<P>", "<P>", "y"), ("ab", "bc", "y"), ("abc", "b", "y")):
        with pytest.raises(ValueError):
            fim.transformed(docs, markers=fim.Markers(*bad))


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    out = fim.op12_fill_in_middle(spark, sf).collect()
    assert len(out) == len(texts)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in out:
        *facts, output = plain(texts[r["doc_id"]], r["doc_id"])
        assert list(r) == [r["doc_id"], *facts, sha(output), sha(texts[r["doc_id"]] or "")]
