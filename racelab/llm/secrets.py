"""Secrets in texts: fixed patterns, and the entropy of windows over candidate strings.

Base kinds are assignments to a telling name, access key ids and long hexadecimal runs; they always stay. The method
adds ``entropy`` spans: in each candidate, a run of characters as keys have them, a window slides along while counts of
its characters, and with them its Shannon entropy, are kept up to date one character at a time. Each character class
(hexadecimal; letters and digits; base64) has its own least entropy. Windows above it are joined to a span, unless an
entry of the allow-list says that the candidate is no secret.

Offsets are code points, the end exclusive. Null and empty texts have no spans. Rows are scanned one by one, so no key
is hot; repeated rows repeat. Columns other than doc_id and text aren't read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelab.llm.common import let, table

ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: As greedy runs are maximal, the least lengths can stand in the patterns without a change.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE = 6

#: A candidate has letters and digits, and is as long as a window at least.
WINDOW = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW)
#: Bits a character that a window has to reach, by class.
LEAST_ENTROPY = {"hex": 3.0, "alnum": 3.6, "base64": 3.8}
ALLOWED = tuple(
    re.compile(p)
    for p in (
        r"(?i)(?:example|sample|dummy|placeholder|changeme|your[_-]?(?:key|token|secret))",
        r"^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",
        r"(?i)0123456789|abcdefghij|1234567890",
        r"^(?:[A-Za-z]+[-_/])+[A-Za-z]*[0-9]{0,4}$",
        r"^[0-9+/_=-]+$",
        r"^[A-Za-z+/_=-]+$",
    )
)
KINDS = ("assign", "access", "hex", "entropy")


def character_class(candidate: str) -> str:
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", candidate):
        return "hex"
    return "alnum" if candidate.isalnum() else "base64"


def dense_windows(candidate: str, least: float, width: int = WINDOW) -> list[tuple[int, int]]:
    """Maximal runs of windows whose entropy is ``least`` bits at least."""
    log = [0.0, *(c * math.log2(c) for c in range(1, width + 1))]
    counts: dict[str, int] = {}
    sum_, out = 0.0, []  # entropy = log2(width) - sum(c log2 c) / width
    for i, c in enumerate(candidate):
        n = counts.get(c, 0)
        counts[c] = n + 1
        sum_ += log[n + 1] - log[n]
        if i >= width:
            gone = candidate[i - width]
            n = counts[gone]
            counts[gone] = n - 1
            sum_ += log[n - 1] - log[n]
        if i >= width - 1 and math.log2(width) - sum_ / width >= least - 1e-9:
            if out and i - width + 1 <= out[-1][1]:
                out[-1] = out[-1][0], i + 1
            else:
                out.append((i - width + 1, i + 1))
    return out


def entropy_spans(text: str) -> Iterator[tuple[int, int]]:
    for m in CANDIDATE.finditer(text):
        found = m.group()
        if any(a.search(found) for a in ALLOWED):
            continue
        for a, b in dense_windows(found, LEAST_ENTROPY[character_class(found)]):
            yield m.start() + a, m.start() + b


def secrets_of(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed."""
    text = text or ""
    low = text.lower()  # ASCII letters stay in place in what this is asked for: whether a name occurs
    out = []
    if any(name in low for name in NAMES):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    out += [("entropy", a, b) for a, b in entropy_spans(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def spans(text: Column) -> Column:
    """array<struct<kind, start, end>> of a text's secrets."""

    @F.pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in secrets_of(t)] for t in texts], dtype=object)

    return of(text)


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row."""
    return docs.select("doc_id", spans(F.col("text")).alias("spans"))


def _joined(found: Column) -> Column:
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def _of_kind(found: Column, *kinds: str) -> Column:
    return F.filter(found, lambda s: s["kind"].isin(*kinds))


def op7_secrets(spark, sf_dir: str) -> DataFrame:
    def digest(found: Column) -> Column:
        base = KINDS[:3]
        counts = [F.size(_of_kind(found, k)).cast("long").alias(f"n_{k}") for k in base]
        return F.struct(*counts, F.sha2(_joined(_of_kind(found, *base)), 256).alias("base_sha256"), _joined(found).alias("spans"))

    return find(table(spark, sf_dir, "documents")).select("doc_id", let(F.col("spans"), digest).alias("r")).select("doc_id", "r.*")
