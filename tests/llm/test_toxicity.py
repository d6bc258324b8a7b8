"""The learner against a plain version, and what is scored where nothing can be learned."""

import math
import random

import numpy as np
import pytest

from racelab.llm import toxicity as tx


def plain_ftrl(samples, labels, bits):
    seen = {}
    for at in samples:
        for i in at:
            seen[i] = seen.get(i, 0) + 1
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= tx.L1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return (sign * tx.L1 - z[i]) / ((tx.BETA + math.sqrt(n.get(i, 0.0))) / tx.ALPHA + tx.L2)

    for _ in range(tx.EPOCHS):
        for at, y in zip(samples, labels, strict=True):
            at = [i for i in at if seen[i] >= tx.LEAST_DOCUMENTS]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w.values()))))) - y
            for i in at:
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / tx.ALPHA * w[i]
                n[i] = old + g * g
    return {i: w for i in z if (w := weight(i))}


def test_ftrl():
    rng = random.Random(4)
    y = [rng.random() < 0.3 for _ in range(400)]
    samples = [np.unique([0, *rng.choices(range(1, 200), k=20), *(rng.choices(range(200, 220), k=3) if t else [])]) for t in y]
    at, w = tx.ftrl(samples, np.array(y, float), bits=8)
    want = plain_ftrl([s.tolist() for s in samples], y, 8)
    assert at.tolist() == sorted(want) and np.allclose(w, [want[i] for i in at.tolist()], atol=1e-9) and 0 < len(at) < 220


@pytest.mark.parametrize(("toxic", "clean", "share"), [(4, 0, 1.0), (0, 3, 0.0), (1, 3, 0.25), (0, 0, 0.0)])
def test_where_nothing_can_be_learned(spark, toxic, clean, share):
    ids = [i for i in range(100) if tx.zlib.crc32(str(i).encode()) % tx.FOLDS][: toxic + clean]
    labels = spark.createDataFrame([(d, 1, int(k < toxic)) for k, d in enumerate(ids)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(100)] + [(None, None)], "doc_id long, text string")
    assert {(r["score"], r["predicted"]) for r in tx.scored(docs, labels).collect()} == {(share, int(share >= 0.5))}
