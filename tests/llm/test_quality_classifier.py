import zlib

import numpy as np
import pytest
from helpers import SCHEMA, documents, empty, prose

from paddock.llm import quality_classifier

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=400):
    good = [(i, prose(i, 50), *[None] * 7) for i in range(n)]
    return [(i, t.replace(" ", "*** ") if i % 3 == 0 else t, *x) for i, t, *x in good]


def test_held_out_accuracy(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(400)], LABELS)
    found = quality_classifier.score(docs, quality_classifier.fit(docs, labels)).collect()
    out = [r for r in found if r["held_out"]]
    assert {r["doc_id"] for r in out} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r["predicted"] == (r["doc_id"] % 3 != 0) for r in out]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)


def test_held_out_labels_change_nothing(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    true = [(i, int(i % 3 != 0), 0) for i in range(400)]
    wrong = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in true]
    models = [quality_classifier.fit(docs, spark.createDataFrame(x, LABELS)) for x in (true, wrong)]
    assert np.array_equal(models[0].weights, models[1].weights) and models[0].bias == models[1].bias


def test_dual_coordinate_descent_reaches_the_optimum():
    """The duality gap of the hinge-loss problem closes."""
    r = np.random.default_rng(2)
    rows = [np.unique(r.integers(0, 60, 12)) for _ in range(80)]
    labels = np.array([int((x < 20).sum() > 4) for x in rows])
    ratios = np.zeros(quality_classifier.PLACES)
    ratios[:60] = r.normal(size=60)
    epochs = quality_classifier.EPOCHS
    try:
        quality_classifier.EPOCHS = 3000
        weights, bias = quality_classifier.descend(rows, labels, ratios)
    finally:
        quality_classifier.EPOCHS = epochs
    used = np.flatnonzero(ratios)
    plain = np.zeros(quality_classifier.PLACES)
    plain[used] = weights[used] / ratios[used]
    signs = np.where(labels > 0, 1, -1)
    margins = np.array([weights[x].sum() / np.sqrt(len(x)) + bias for x in rows])
    cost = len(labels) / (2 * np.array([(labels == k).sum() for k in (0, 1)])[labels])

    def loss(w, b):
        m = np.array([(w * ratios)[x].sum() / np.sqrt(len(x)) + b for x in rows])
        return 0.5 * (w @ w + b * b) + (cost * np.maximum(0, 1 - signs * m)).sum()

    here = loss(plain, bias)
    assert (signs * margins > 0).mean() > 0.8
    for _ in range(50):
        step = np.zeros_like(plain)
        step[:60] = r.normal(size=60) * 0.05
        assert loss(plain + step, bias + r.normal() * 0.05) >= here - 1e-3


def test_awkward_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 0), (2, 0, 1), (3, None, 0), (None, 1, 0), (7, 1, 0), (9999, 0, 0), (4, 0, 0), (6, 1, 0)], LABELS
    )
    found = quality_classifier.score(docs, quality_classifier.fit(docs, labels)).collect()
    assert len(found) == docs.count()
    assert all(r["score"] is not None and r["held_out"] is not None for r in found)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (3, 1, 0)], [(1, None, None)]])
def test_without_both_classes(spark, labels):
    docs = documents(spark)
    found = quality_classifier.score(docs, quality_classifier.fit(docs, spark.createDataFrame(labels, LABELS)))
    assert found.select("score").distinct().count() == 1


def test_empty(spark):
    labels = spark.createDataFrame([(1, 1, 0)], LABELS)
    assert quality_classifier.score(empty(spark), quality_classifier.fit(empty(spark), labels)).count() == 0
