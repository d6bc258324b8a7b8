"""Each operator against a brute-force version, an exact round trip or held-out accuracy."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash
from tokenizers import Tokenizer

import __spark_entry__
from racelab.llm import bpe, chat, decontam, pii, quality, secrets, simhash, tokens
from racelab.llm.common import Remembered

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(5)
    parts = list("ab1234567890.. @@--++()  é🙂\n") + ["a@b.c", "1.2.3.4", "+1 (068) 555-2748", "4111 1111 1111 1111", "255.0.0.1", "123-45-6789", "token = '", "API_KEY:", "password : ", "AKIA", "ABCDEFGHIJ0123456789", "0123456789abcdef", "deadbeef"]
    made = {10**6 + i: "".join(rng.choices(parts, k=rng.randint(0, 50))) for i in range(400)}
    made |= {-1: None, -2: "", -3: "1" * 30_000, -4: "a@b" + ".c" * 9_000, -5: "1 " * 20_000, -6: "+1" * 9_000}
    made |= {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    return made


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4).cache()


def luhn(digits):
    doubled = (int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits)))
    return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0


PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m, d: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m, d: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m, d: 13 <= len(d) <= 19 and luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m, d: 9 <= len(d) <= 15),
}


def test_pii(docs, texts):
    out = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] in pii.BASE] for r in pii.find(docs).collect()}
    for i, text in texts.items():
        want = [(k, m.start(), m.end()) for k, (p, ok) in PII.items() for m in re.finditer(p, text or "") if ok(m[0], re.sub("[^0-9]", "", m[0]))]
        assert out[i] == want, i


def test_mod97(spark):
    rows = spark.createDataFrame([("GB82 WEST 1234 5698 7654 32",), ("GB82WEST12345698765433",), ("DE89370400440532013000",)], "x string")
    assert [r[0] for r in rows.select(pii.mod97(pii.F.col("x"))).collect()] == [1, 28, 1]


def test_secrets(docs, texts):
    letters = "".join
    names = "|".join(letters(f"[{c}{c.upper()}]" if c.isalpha() else c for c in n) for n in ("password", "passwd", "secret", "token", "api_?key"))
    assign = re.compile(rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for i, text in texts.items():
        t = text or ""
        want = [("assign", m.start(), m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        want += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        want += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        assert sorted(s for s in secrets.secrets_of(text) if s[0] != "entropy") == sorted(want), i
    assert {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in secrets.find(docs).collect()} == {i: secrets.secrets_of(t) for i, t in texts.items()}


def test_entropy_by_counts():
    rng = random.Random(1)
    for _ in range(200):
        s = "".join(rng.choices("abcdefgh0123XYZ", k=rng.randint(20, 60)))
        dense = {p for a, b in secrets.dense_windows(s, 3.2) for p in range(a, b)}
        want = set()
        for i in range(len(s) - secrets.WINDOW + 1):
            n = Counter(s[i : i + secrets.WINDOW]).values()
            if -sum(c / secrets.WINDOW * np.log2(c / secrets.WINDOW) for c in n) >= 3.2:
                want |= set(range(i, i + secrets.WINDOW))
        assert dense == want
    assert [k for k, *_ in secrets.secrets_of("key kJ8sLq02mZx7Vb3TnQ9w and your_token_kJ8sLq02mZx7Vb3TnQ9w")] == ["entropy"]


def test_quality(docs, texts):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    for r in quality.judged(docs).collect():
        t = texts[r["doc_id"]] or ""
        w = word.findall(t)
        grams = Counter(zip(w, w[1:], w[2:], strict=False))
        hit = {i + d for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for d in range(3)}
        lines = [x for x in t.split("\n") if word.search(x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == want
        assert not (r["kept"] and r["base_failed"])


def test_decontamination(spark, docs, texts):
    split = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) if w]
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()} | {900: "b", 901: None, 902: "1 2", 903: "the of"}
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    windows = {}
    for item, text in items.items():
        w = split(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    for most in ("-1", spark.conf.get(threshold)):  # by shuffle join, then by broadcast
        spark.conf.set(threshold, most)
        for r in decontam.contamination(docs, benchmark).collect():
            w = split(texts[r["doc_id"]])
            hit, found = set(), set()
            for n in sizes:
                for i in range(len(w) - n + 1):
                    if got := windows.get(tuple(w[i : i + n])):
                        hit |= set(range(i, i + n))
                        found |= got
            assert (r["n_words"], r["hit"], r["items"]) == (len(w), sorted(hit), sorted(found))
        spark.conf.set(threshold, most)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.VOCABULARY)


def test_bpe_as_library(library):
    rng = random.Random(3)
    parts = [*"abcd eE \n\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0 ​'sdé²½Ⅷ٣€漢🙂\x00#.,_-01 ", "<|endoftext|>", "'ll", " the", "  "]
    cases = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(3000)] + ["a" * 5000, "ab" * 3000, "", " " * 2000]
    own, by_library = bpe.Bpe(), tokens.LibraryEncoder(bpe.VOCABULARY)
    for known in (own.known, by_library.known):
        known.kept = 500  # forgets between batches
    for i in range(0, len(cases), 100):
        batch = pa.array([*cases[i : i + 100], None], pa.string())
        ours, theirs = own.ids(batch), by_library.ids(batch)
        for text, a, b in zip(cases[i : i + 100], ours[1].tolist(), ours[1].tolist()[1:], strict=False):
            want = library.encode(text, add_special_tokens=False).ids
            assert ours[0][a:b].tolist() == want and theirs[0][a:b].tolist() == want, text
            assert own.decode(np.array(want, "<u4").tobytes()) == library.decode(want, skip_special_tokens=False)
        assert ours[1].tolist() == theirs[1].tolist() and ours[1][-1] == ours[1][-2]
    assert own.encode(cases[0]) == np.array(library.encode(cases[0], add_special_tokens=False).ids, "<u4").tobytes()
    assert own.decode(np.array([165, 50256], "<u4").tobytes()) == library.decode([165, 50256], skip_special_tokens=False)


def test_piece_table_forgets():
    table = Remembered(str.encode, kept=3)
    assert [table[c] for c in "abcdabcdxyzabc"] == [c.encode() for c in "abcdabcdxyzabc"] and len(table) <= 3 and len(table.older) <= 3
    known = bpe.KnownIds(lambda x: (np.array([ord(c) for s in x.to_pylist() for c in s], np.uint32), pc.binary_length(x).to_numpy().astype(np.int64)), kept=3, longest=2)
    for want in (["a", "bb"], ["ccc", "a"], ["d", "e", "bb"], [], ["a", "ccc"]):
        ids, sizes = known.of(pa.array(want, pa.string()))
        assert "".join(map(chr, ids)) == "".join(want) and sizes.tolist() == list(map(len, want)) and len(known.strings) <= 4


def test_token_queries(spark, library):
    given = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    queries = __spark_entry__.queries()
    files = {r["doc_id"]: r for r in queries["op2_token_files"](spark, SF).collect()}
    coded = {r["doc_id"]: r for r in queries["op6_bpe"](spark, SF).collect()}
    start = 0
    for i in sorted(given):
        ids = library.encode(given[i], add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        assert (files[i]["start"], files[i]["n_tokens"], files[i]["ids_crc32"]) == (start, len(ids) + 1, zlib.crc32(raw + bytes(4)))
        assert (coded[i]["n_tokens"], coded[i]["ids_sha256"]) == (len(ids), hashlib.sha256(raw).hexdigest())
        assert coded[i]["decoded_sha256"] == hashlib.sha256(given[i].encode()).hexdigest()
        start += len(ids) + 1


def _fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(nodes, linked):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {n: root(n) for n in nodes}


def test_simhash_query(spark):
    given = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {i: _fingerprint(t) for i, t in given.items()}
    want = _components(sorted(given), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    out = __spark_entry__.queries()["op5_simhash_near_dedup"](spark, SF).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in out} == {i: (f"{prints[i]:016x}", want[i]) for i in given}


@pytest.mark.parametrize("cell", [4096, 8])
def test_trie_join(spark, cell, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", cell)
    rng = random.Random(1)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for b in sorted(prints)[:60]:
        for _ in range(rng.randint(1, 8)):
            x = b
            for k in rng.sample(range(64), rng.randint(0, 6)):
                x ^= 1 << k
            prints.add(x)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    want = _components(sorted(prints), lambda a, b: (a ^ b).bit_count() <= 4)
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(frame)).collect()}
    groups = lambda m: sorted(sorted(k for k in m if m[k] == v) for v in set(m.values()))
    assert groups({p: roots.get(signed(p), signed(p)) for p in prints}) == groups(want)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([*pairwise(range(40)), (100, 101), (101, 100)], "u long, v long")
    out = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert out == dict.fromkeys(range(40), 0) | {100: 100, 101: 100}


def test_chat_repair(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 3)  # conversations span blocks
    rng, talk, rows = random.Random(2), {}, []
    for i in range(80):
        talk[i] = rng.choices(["system", "user", "assistant", "tool", None], [1, 5, 5, 1, 0.3], k=rng.choice([1, 2, 3, 5, 9, 40]))
        rows += [(i, t, r, f"t{t}") for t, r in enumerate(talk[i])]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    out = {}
    for r in chat.formatted(frame).orderBy("place").collect():
        out.setdefault(r["conv_id"], []).append(r)
    code = {r: i for i, r in enumerate(chat.ROLES)}
    for i, roles in talk.items():
        turns = re.findall(r"<\|(\w+)\|>\n(.*?)<\|end\|>\n", "".join(r["rendered"] for r in out[i]), re.S)
        states = [chat.START, *(code[t[0]] for t in turns)]
        assert all(b in chat._NEXT[a] for a, b in pairwise(states)) and states[-1] == 2
        assert [x for t in turns for x in t[1].split("\n") if x] == [f"t{t}" for t in range(len(roles))]
        best = {chat.START: 0.0}  # every legal way, by its state
        for role in roles:
            after = {}
            for state, cost in best.items():
                ways = [(chat.MERGE + chat.RELABEL * (code.get(role) != state), state)] if state != chat.START else []
                for x in chat._NEXT[state]:
                    ways.append((chat.RELABEL * (code.get(role) != x), x))
                    ways += [(chat.INSERT + chat.RELABEL * (code.get(role) != y), y) for y in chat._NEXT[x]]
                for more, x in ways:
                    after[x] = min(after.get(x, 1e9), cost + more)
            best = after
        least = min(cost + (2 - state) * chat.INSERT for state, cost in best.items())
        price = {"keep": 0, "relabel": 0, "merge": chat.MERGE, "insert": chat.INSERT}
        paid = sum(price[r["action"]] + chat.RELABEL * (code.get(role) != code[r["role"]]) for r, role in zip(out[i], roles, strict=True))
        assert paid + (2 - code[out[i][-1]["role"]]) * chat.INSERT == least


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    scored = __spark_entry__.queries()["op3_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    n = Counter((r["toxic"], r["predicted"]) for r in scored.collect())
    assert n[1, 1] / (n[1, 0] + n[1, 1]) > 0.7 and n[0, 1] / (n[0, 0] + n[0, 1]) < 0.01
