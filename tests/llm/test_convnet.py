"""The convolutional network: gradients, coverage of whole texts, held-out accuracy, edge cases."""

import numpy as np
import pytest

from racelab.llm import convnet
from racelab.llm.common import table

SIZES = (0, 5, 449, 512, 513, 600, 960, 961, 3000)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(1)
    return [bytes(rng.integers(32, 127, n).astype(np.uint8)) for n in SIZES]


def test_chunks_cover_whole_texts(texts):
    rows, bounds = convnet.chunks(texts)
    for text, a, b in zip(texts, bounds, bounds[1:]):
        laid = bytearray()
        for i, row in enumerate(rows[a:b]):
            laid[i * convnet.STEP :] = row.tobytes()
        assert bytes(laid).rstrip(b"\0") == text and len(laid) >= len(text)
    assert convnet.CHUNK - convnet.STEP >= convnet.WIDTH and convnet.STEP % convnet.STRIDE == 0


def test_maxima_by_hand(texts):
    net = convnet.Net.start(np.random.default_rng(2))
    rows, _ = convnet.chunks(texts)
    want = [np.max([net.bytes[row[i : i + convnet.WIDTH]].ravel() @ net.filters for i in range(0, convnet.CHUNK - convnet.WIDTH + 1, convnet.STRIDE)], 0) for row in rows]
    assert np.allclose(convnet.largest(net, rows), want, atol=1e-4)
    assert np.allclose(convnet.convolved(net, rows)[0], want, atol=1e-4)


def test_gradient_is_that_of_the_loss(texts):
    rng = np.random.default_rng(3)
    net = convnet.Net(*(x.astype(np.float64) for x in convnet.Net.start(rng)))
    rows, bounds = convnet.chunks(texts)
    wanted, weight = (np.arange(len(texts)) % 2).astype(float), rng.uniform(1, 3, len(texts))

    def loss(net):
        p = convnet.combined(net, convnet.largest(net, rows), bounds).p
        return -(weight * np.log(np.where(wanted == 1, p, 1 - p))).sum() / weight.sum()

    for k, g in enumerate(convnet.gradient(net, rows, bounds, wanted, weight)):
        for _ in range(5):
            at = tuple(rng.integers(0, n) for n in net[k].shape)
            more, less = ([x.copy() for x in net] for _ in range(2))
            more[k][at] += 1e-6
            less[k][at] -= 1e-6
            assert abs((loss(convnet.Net(*more)) - loss(convnet.Net(*less))) / 2e-6 - g[at]) < 1e-5


def test_packed_and_alone(texts):
    net = convnet.Net.start(np.random.default_rng(4))
    assert all((a == b).all() for a, b in zip(net, convnet.Net.unpacked(net.packed())))
    together = convnet.probabilities(net, texts)
    assert np.allclose(together, [convnet.probabilities(net, [t])[0] for t in texts], atol=1e-6)


def test_held_out_quality(spark):
    """Of held-out rows nearly all good ones are kept, and most others are found."""
    sf = "/root/testdata/sf0.1"
    out = convnet.op11_quality_classifier(spark, sf)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    both = out.join(table(spark, sf, "labels"), "doc_id").where("held_out").toPandas()
    assert ((both["score"] >= 0.3) == (both["predicted"] == 1)).all() and both["score"].between(0, 1).all()
    assert both.loc[both["quality"] == 1, "predicted"].mean() >= 0.98
    assert both.loc[both["quality"] == 0, "predicted"].mean() <= 0.25


def test_nothing_to_learn(spark):
    rows = [(1, "a b"), (1, "a b"), (2, None), (None, ""), (3, "x" * 70_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"quality": convnet.F.lit(9), "turn": convnet.F.lit(1)})
    labels = spark.createDataFrame([(1, 1, 0), (3, 1, None), (2, None, 1), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in convnet.scored(docs, labels).collect()] == [1.0] * 5
    assert {r["score"] for r in convnet.scored(docs, labels.limit(0)).collect()} == {0.0}
    assert convnet.scored(docs.limit(0), labels).count() == 0


def test_learns_from_few_rows(spark):
    rows = [(i, "## || ## " * 9 if i % 2 else "plain words stand here") for i in range(40)] + [(None, None), (None, ""), (1, "## || " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("quality", convnet.F.lit(9))
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(40)] + [(1, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    out = convnet.scored(docs, labels).collect()
    assert len(out) == len(rows)
    assert all(r["score"] < 0.5 for r in out if r["doc_id"] is not None and r["doc_id"] % 2)
    assert all(r["score"] > 0.5 for r in out if r["doc_id"] is not None and r["doc_id"] % 2 == 0)
