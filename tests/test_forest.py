import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paddock.operators import forest
from paddock.plans import training
from paddock.scratch import materialize

FEATURES = ["a", "b", "c"]
WEIGHTS = [1.25, 0.75]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = []
    for i in range(600):
        a, b = rng.gauss(0, 1), float(rng.randrange(4))
        c = float("nan") if i % 50 == 0 else rng.random()
        data.append((i, a, b, c, float(a + b + rng.gauss(0, 1) > 1.5)))
    table = materialize(spark.createDataFrame(data, "id int, a double, b double, c double, y double"), "rows")
    return table.repartition(3, "id").sortWithinPartitions("id")


def test_cut_points(rows):
    a, b, c = forest.cut_points(rows, FEATURES)
    assert b.tolist() == [0.5, 1.5, 2.5]
    for name, cuts in (("a", a), ("c", c)):
        values = np.array([r[0] for r in rows.select(name).collect()])
        values = values[np.isfinite(values)]
        held = np.bincount(np.searchsorted(cuts, values, "left"), minlength=forest.BINS)
        assert len(cuts) == forest.BINS - 1 and held.min() > 0.5 * len(values) / forest.BINS
    many = np.arange(10_000.0)
    values, counts = forest._thinned(many, np.ones(10_000), 1_000)
    assert len(values) == 1_000 and counts.sum() == 10_000 and values[-1] == 9_999


def test_nodes_hold_the_rows_that_reach_them(rows, monkeypatch):
    """Each tree walked again in plain Python, with its drawn rows and the best of all cuts."""
    monkeypatch.setattr(forest, "PIECE", 2)
    cuts = forest.cut_points(rows, FEATURES)
    packed = forest.pack(rows, FEATURES, "y", cuts).persist()
    trees = forest.grow(packed, len(FEATURES), WEIGHTS, 3, 4, 9)
    data = []
    for r in packed.collect():
        bins = np.frombuffer(r["bins"], np.uint8).reshape(-1, len(FEATURES))
        data.append((r["part"], r["block"], bins, np.frombuffer(r["labels"], np.uint8)))
    packed.unpersist()
    assert sum(len(d[3]) for d in data) == 600 and any(d[2].max() == forest.BINS - 1 for d in data)
    table = forest._poisson()
    for tree, levels in enumerate(trees):
        drawn = []
        for part, block, bins, labels in data:
            times = forest._drawn(table, len(labels), 9, 1, tree, part, block)
            drawn += [(x.tolist(), int(y)) for x, y, n in zip(bins, labels, times) for _ in range(n)]
        held = {0: drawn}
        for depth, level in enumerate(levels):
            subsets = forest._subsets(len(level.feature), len(FEATURES), 2, 9, 2, tree, depth)
            below = {}
            for number, feature in enumerate(level.feature):
                mine = held[number]
                assert level.rows[number].tolist() == [sum(y == k for _, y in mine) for k in (0, 1)]
                gains = {
                    (f, cut): _gain(mine, f, cut) for f in subsets[number].tolist() for cut in range(forest.BINS - 1)
                }
                best = max(gains.values())
                if feature < 0:
                    assert best <= 1e-12
                    continue
                assert gains[int(feature), int(level.cut[number])] == pytest.approx(best, abs=1e-12)
                for side, goes_left in ((level.left, True), (level.right, False)):
                    below[int(side[number])] = [r for r in mine if (r[0][feature] <= level.cut[number]) == goes_left]
            held = below


def _gain(rows, feature, cut):
    def impurity(some):
        total = sum(WEIGHTS[y] for _, y in some)
        return total, 1 - sum((sum(WEIGHTS[y] for _, y in some if y == k) / total) ** 2 for k in (0, 1))

    left, right = ([r for r in rows if (r[0][feature] <= cut) == side] for side in (True, False))
    if not left or not right:
        return -1.0
    (n, whole), (nl, gl), (nr, gr) = map(impurity, (rows, left, right))
    return whole - nl / n * gl - nr / n * gr


def test_trees_of_large_tables_do_not_follow_the_input_partitions(spark, rows):
    table = rows.withColumns({"target": F.col("y") > 0, "c": F.when(~F.isnan("c"), F.col("c"))})
    found = []
    for parts in (2, 7):
        model = training.train(
            table.repartition(parts), "target", FEATURES, trees=2, depth=3, tree_rows=600, partition_rows=200, key="id"
        )
        found.append([t.toDebugString.split("\n", 1)[1] for f in model.stages[2:] for t in f.trees])
    assert found[0] == found[1] and len(set(found[0])) == 2
    scored = training.score(table, {"top10": model}).selectExpr("avg(int(top10_prediction = target))").first()[0]
    assert scored > 0.6
