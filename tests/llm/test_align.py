"""Token alignment against whole-text encodings by the two libraries and plain loops."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from racelab.llm import align
from racelab.llm.bpe import byte_symbols
from racelab.llm.common import table


@pytest.fixture(scope="module")
def tokens():
    """text -> A's and B's (id, bytes), by whole texts."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte = {s: i for i, s in enumerate(byte_symbols())}

    def of(text):
        found = a.encode(" " + text, add_special_tokens=False)
        piece = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        return [(i, bytes(byte[c] for c in t)) for i, t in zip(found.ids, found.tokens)], [(i, piece(i)) for i in b.encode(text)]

    return of


def spans(tokens):
    at, out = 0, []
    for i, b in tokens:
        out.append((i, at, at + len(b)))
        at += len(b)
    return out


def plain(text, tokens):
    """(n_a, n_b, groups, links) of a text, None without tokens."""
    if not text:
        return None
    a, b = tokens(text)
    whole = (" " + text).encode()
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return None
    a, b = spans(a), spans(b)
    cuts, links, groups, j0 = {e for *_, e in a} & {e for *_, e in b}, [], [], 0
    for i, s, e in a:
        j = j0
        while j < len(b) and b[j][1] < e:
            if b[j][2] > s:
                links.append((i, b[j][0]))
            j += 1
        while j0 < len(b) and b[j0][2] <= e:
            j0 += 1
    left, right = defaultdict(list), defaultdict(list)
    ends = sorted(cuts)
    for side, toks in ((left, a), (right, b)):
        k = 0
        for i, _, e in toks:
            while ends[k] < e:
                k += 1
            side[k].append(str(i))
    groups = [",".join(left[k]) + "|" + ",".join(right[k]) for k in range(len(ends))]
    return len(a), len(b), groups, links


def expected(rows, tokens):
    found = [(i, plain(t, tokens)) for i, t in rows]
    counts = Counter(pair for _, f in found if f for pair in set(f[3]))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for i, f in found:
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, groups, links = f
            out.append((i, n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), ";".join(groups)))
    return out


PARTS = [*"ab .,!é🙂\n\t\r\x00▁ｶ\xa0 　\x1c\x85１", "  ", "\n\n", " the", " The", "<s>", "<|endoftext|>", "don't", "ing", "\r\n", "日本", "ﬁ", " \n", "!!", "###", " running", "<0x41>"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    made = [(i, "".join(rng.choices(PARTS, k=rng.randint(0, 25)))) for i in range(300)]
    return made + [(None, None), (None, "the the"), (1, None), (2, ""), (3, " "), (4, "\n"), (5, "▁"), (6, "a" * 5000), (7, " " * 3000), (8, "the end "), (8, "the end ")]


SIZES = [{}, {"shard_pairs": 40, "leaf_rows": 3, "fan": 2}, {"shard_pairs": 64, "most_pairs": 60}, {"most_pairs": 0}]


@pytest.mark.parametrize("sizes", SIZES)
def test_against_plain(spark, rows, tokens, sizes):
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, n_a int, pair int").repartition(5)
    out = align.aligned(docs, **sizes)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(expected(rows, tokens), key=str)


@pytest.mark.parametrize("sizes", SIZES)
def test_empty(spark, sizes):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert align.aligned(docs.limit(0), **sizes).collect() == []
    assert sorted(map(tuple, align.aligned(docs, **sizes).collect())) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_query(spark, tokens):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    want = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in expected(rows, tokens)]
    assert sorted(map(tuple, align.op13_token_alignment(spark, sf).collect())) == sorted(want)


def test_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 5000):
        keys = np.unique(rng.integers(0, 1 << 47, n))
        made = align.PerfectHash.of(keys)
        assert sorted(made.keys) == keys.tolist() and made.bits.sum() == len(keys)
        for shards in (1, 7):
            at = align.shard_of(keys, shards)
            whole = align.PairTable(shards, {i: align.PerfectHash.of(keys[at == i]) for i in set(at.tolist())})
            found = whole.index(keys)
            assert sorted(found) == list(range(len(keys))) and (whole.keys[found] == keys).all()
            others = rng.integers(0, 1 << 47, 5000)
            assert (whole.index(others)[~np.isin(others, keys)] == -1).all()


def test_cuts(tokens):
    """Cut at stretches or not, tokens are those of whole texts."""
    rng = random.Random(9)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 60))) for _ in range(500)]
    parts, bounds = align.stretches(pa.array(texts))
    parts = parts.to_pylist()
    assert ["".join(parts[a:b]) for a, b in zip(bounds, bounds[1:])] == [" " + t for t in texts]
