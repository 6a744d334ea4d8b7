import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paddock.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, tag int, id string, score double"
ANCHOR = "vec_id % 10 = 0"


def rows():
    r = random.Random(4)
    out = []
    for i in range(160):
        base = 1.0 if i % 4 else 0.2
        out.append((i, [base + r.uniform(-0.6, 0.6) for _ in range(12)], i % 3, 1, "x", 2.0))
    out += [(200 + i, out[5][1], i % 3, 1, "x", 2.0) for i in range(30)]  # the same vector many times
    out.append(out[7])  # a repeated row
    out.append((0, out[9][1], 1, 1, "x", 2.0))  # a repeated id that is an anchor
    out += [(300, None, 1, None, None, None), (310, [1.0, None], 1, 1, "x", 2.0), (320, [math.nan] * 12, 0, 1, "x", 2.0)]
    out += [(330, [math.inf] * 12, 0, 1, "x", 2.0), (340, out[1][1], None, 1, "x", 2.0), (None, out[1][1], 1, 1, "x", 2.0)]
    out += [(350, [], 1, 1, "x", 2.0), (351, [2.0, 3.0], 2, 1, "x", 2.0), (360, [-1.0] * 12, 2, 1, "x", 2.0), (370, [0.0] * 12, 0, 1, "x", 2.0)]
    return out


def brute(data, positives=5, negatives=10):
    some = []
    for i, v, label, *_ in data:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        some.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for at, (i, v, label) in enumerate(some):
        if i % 10:
            continue
        ranked = sorted((-score(v, w), j, k) for k, (j, w, _) in enumerate(some) if k != at)
        same = [(s, j) for s, j, k in ranked if some[k][2] == label]
        other = [(-s, j) for s, j, k in ranked if some[k][2] != label]
        for s, j in same[:positives]:
            inside = [(n, m) for n, m in other if 30 * -s <= 100 * n <= 90 * -s]
            out += [(i, j, rank, m, -s, n) for rank, (n, m) in enumerate(inside[:negatives], 1)]
    return sorted(out)


@pytest.mark.parametrize("row_block,anchor_block", [(1024, 256), (17, 4)])
def test_like_brute_force(spark, row_block, anchor_block):
    vectors = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    found = hard_negatives.mine(vectors, F.col("label"), F.expr(ANCHOR), row_block=row_block, anchor_block=anchor_block)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows())


def test_few_rows(spark):
    data = [(0, [1.0, 0.5], 0), (1, [1.0, 0.5], 0), (2, [0.5, 0.2], 1), (3, [-1.0, 0.0], 1)]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    found = hard_negatives.mine(vectors, F.col("label"), F.expr(ANCHOR), negatives=3)
    assert sorted(tuple(r) for r in found.collect()) == brute(data, negatives=3) != []


def test_empty_table(spark):
    assert hard_negatives.mine(spark.createDataFrame([], SCHEMA), F.col("label"), F.expr(ANCHOR)).count() == 0


def test_bounds_drop_candidates_before_the_last_column():
    r = np.random.default_rng(1)
    rows = r.integers(-5, 5, (500, 64))
    rows[7] = 100
    block = hard_negatives.Block(rows)
    seen = []

    def cut(lower, upper):
        assert (lower <= upper).all()
        seen.append(len(lower))
        return upper >= np.partition(lower, -1)[-1]

    alive, scores = block.scan(np.full(64, 3), np.arange(500), cut)
    assert alive.tolist() == [7] and scores.tolist() == [64 * 300]
    assert seen[-1] < 500
