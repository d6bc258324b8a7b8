"""Each stage of the pipeline against a plain version, on that stage's own input."""

import math
import re
import zlib

import pytest
from test_brute import PII, SF, _components, _fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from racelab.llm import bpe, pii, toxicity

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def toxic_score(text, weights, share):
    h = [zlib.crc32(w.encode()) for w in WORD.findall(lower(text))]
    mix, cut = [int(m) for m in toxicity._MIX], 64 - toxicity.BITS
    found = {0, *(x * mix[0] % 2**64 >> cut for x in h)}
    for d in (1, 2):
        found |= {((a * mix[d] + b * mix[3]) * mix[0]) % 2**64 >> cut for a, b in zip(h, h[d:], strict=False)}
    return 1 / (1 + math.exp(-sum(weights.get(i, 0.0) for i in found))) if weights else share


def contaminated(text, windows):
    w = WORD.findall(lower(text))
    return any(tuple(w[i : i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1))


def redacted(text):
    found = sorted((m.start(), m.end(), kind) for kind, (p, ok) in PII.items() for m in re.finditer(p, text) if ok(m[0], re.sub("[^0-9]", "", m[0])))
    out, at = "", 0
    for a, b, kind in found:
        if a >= at:
            out += f"{text[at:a]}[{kind.upper()}]"
        at = max(at, b)
    return out + text[at:]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        left = corpus_pipeline.stored(stage(spark, docs, SF))
        out[name] = docs, left
        docs = left
    return out


def texts(frame):
    return {r["doc_id"]: r["text"] for r in frame.select("doc_id", "text").collect()}


def test_toxicity(spark, stages):
    given, left = map(texts, stages["toxicity"])
    model = toxicity.train(stages["toxicity"][0], spark.read.parquet(f"{SF}/labels.parquet"))
    weights = dict(zip(model.at.tolist(), model.values.tolist(), strict=True))
    assert set(left) == {i for i, t in given.items() if toxic_score(t, weights, model.share) < toxicity.THRESHOLD}


def test_near_dedup(stages):
    given, left = map(texts, stages["near_dedup"])
    prints = {i: _fingerprint(t) for i, t in given.items()}
    assert left == {i: given[i] for i in set(_components(sorted(given), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4).values())}


def test_decontamination(spark, stages):
    given, left = map(texts, stages["decontamination"])
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = WORD.findall(lower(r["text"]))
        n = min(10, len(w))
        windows |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1) if w}
    assert left == {i: t for i, t in given.items() if not contaminated(t, windows)} and len(left) < len(given)


def test_pii(stages):
    given, left = stages["pii"]
    assert not any(s["kind"] not in pii.BASE for r in pii.find(given).collect() for s in r["spans"])
    assert texts(left) == {i: t if t is None else redacted(t) for i, t in texts(given).items()}
    assert left.where("n_chars <> length(text)").count() == 0 and left.columns == given.columns


def test_bpe(stages):
    given, left = stages["bpe"]
    library = Tokenizer.from_file(bpe.VOCABULARY)
    out = {r["doc_id"]: r["ids"] for r in left.collect()}
    assert out == {i: library.encode(t or "", add_special_tokens=False).ids for i, t in texts(given).items()}
