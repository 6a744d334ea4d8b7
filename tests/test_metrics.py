"""Metrics, drift and preparation against plain Python on small frames."""

import math
import random

import pytest
from pyspark.sql import functions as F

from paddock.operators import drift, metrics, preprocess, quality, selection, splits, summaries


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(7)
    rows = []
    for i in range(1500):
        y = rng.random() < 0.4
        p = min(max(round(rng.gauss(0.6 if y else 0.4, 0.2), 3), 0.0), 1.0)
        rows.append((i, y, p >= 0.5, p))
    return rows, spark.createDataFrame(rows, "id int, y boolean, pred boolean, p double")


def auc(rows):
    pos = [p for _, y, _, p in rows if y]
    neg = [p for _, y, _, p in rows if not y]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("chunk_rows", [10**6, 130])
def test_roc_auc(scored, chunk_rows):
    rows, df = scored
    assert metrics.roc_auc(df, "p", "y", chunk_rows).first()[0] == pytest.approx(auc(rows))


@pytest.mark.parametrize("chunk_rows", [10**6, 130])
def test_pr_curve(scored, chunk_rows):
    rows, df = scored
    points = {r["threshold"]: r for r in metrics.pr_curve(df, "p", "y", chunk_rows).collect()}
    assert len(points) == len({p for *_, p in rows})
    for t in (0.2, 0.35, 0.5, 0.71):
        chosen = [y for _, y, _, p in rows if p >= t]
        assert points[t]["precision"] == pytest.approx(sum(chosen) / len(chosen))
        assert points[t]["recall"] == pytest.approx(sum(chosen) / sum(y for _, y, *_ in rows))


def test_log_loss_and_flat_metrics(scored):
    rows, df = scored
    eps = metrics.EPSILON
    loss = -sum(
        math.log(min(max(p if y else 1 - p, eps), 1 - eps)) for _, y, _, p in rows
    ) / len(rows)
    row = metrics.binary_metrics(df, "pred", "p", "y").first()
    assert row["log_loss"] == pytest.approx(loss)
    assert row["roc_auc"] == pytest.approx(auc(rows))
    assert row["accuracy"] == pytest.approx(sum(y == q for _, y, q, _ in rows) / len(rows))


@pytest.mark.parametrize("label", [True, False])
def test_one_class_only(scored, label):
    _, df = scored
    row = metrics.binary_metrics(df.where(F.col("y") == label), "pred", "p", "y").first()
    assert (row["roc_auc"], row["log_loss"]) == (1.0, 0.0)


def test_report_and_confusion_with_absent_cells(spark):
    df = spark.createDataFrame([(True, True), (True, False)], "y boolean, pred boolean")
    cells = {(r[0], r[1]): r[2] for r in metrics.confusion_matrix(df, "pred", "y").collect()}
    assert cells == {
        (False, False): 0, (False, True): 0, (True, False): 1, (True, True): 1,
        (False, None): 0, (True, None): 0,
    }
    report = {r["label"]: r for r in metrics.classification_report(df, "pred", "y").collect()}
    assert report["true"]["precision"] == 1.0 and report["true"]["recall"] == 0.5
    assert report["false"]["precision"] == 0.0 and report["false"]["support"] == 0
    assert report["weighted avg"]["recall"] == 0.5 and report["accuracy"]["precision"] == 0.5


def test_missing_prediction_counts_as_wrong(spark):
    df = spark.createDataFrame([(True, True), (True, None)], "y boolean, pred boolean")
    assert metrics.accuracy(df, {"a": ("pred", "y")}).first()["a"] == 0.5


def test_middle_of_the_curve_may_be_its_end(spark):
    df = spark.createDataFrame([(True, 0.4), (False, 0.4)], "y boolean, p double")
    row = metrics.pr_at_threshold(df, "p", "y", 0.5).first()
    assert (row["middle_precision"], row["middle_recall"]) == (1.0, 0.0)


@pytest.mark.parametrize("chunk_rows", [10**6, 130])
def test_drift_scores(spark, chunk_rows):
    rng = random.Random(3)
    a = [round(rng.gauss(0, 1), 2) for _ in range(900)]
    b = [round(rng.gauss(0.3, 1.4), 2) for _ in range(700)]
    rows = [("train", x) for x in a] + [("test", x) for x in b] + [("test", None)]
    df = spark.createDataFrame(rows, "split string, x double")
    counts = drift.value_counts(df, ["x"], F.col("split") == "train")
    row = drift.ordered_scores(counts, chunk_rows).first()
    points = sorted(set(a + b))

    def cdf(values, x):
        return sum(v <= x for v in values) / len(values)

    gaps = [abs(cdf(a, x) - cdf(b, x)) for x in points]
    w = sum(g * (points[i + 1] - points[i]) for i, g in enumerate(gaps[:-1]))
    assert row["ks"] == pytest.approx(max(gaps)) and row["wasserstein"] == pytest.approx(w)


def test_jensen_shannon(spark):
    rows = [("train", True)] * 3 + [("train", False)] + [("test", False)] * 2
    df = spark.createDataFrame(rows, "split string, f boolean")
    counts = drift.value_counts(df, ["f"], F.col("split") == "train", "string")
    js = drift.category_scores(counts).first()["js"]
    p, q = (0.75, 0.25), (0.0, 1.0)
    m = [(x + y) / 2 for x, y in zip(p, q)]
    kl = sum(x * math.log2(x / z) for xs in (p, q) for x, z in zip(xs, m) if x > 0)
    assert js == pytest.approx(math.sqrt(kl / 2))
    flagged = drift.flag_drift(drift.category_scores(counts), "js")
    assert drift.drift_summary(flagged).first()["dataset_drift"] is True


@pytest.mark.parametrize("buckets", [1024, 64, 5, 1])
def test_distances_from_buckets(spark, buckets):
    """The same as from every value: shifted, crossing, equal, constant, infinite and missing columns."""
    rng = random.Random(8)
    rows = []
    for i in range(1500):
        ref = i < 800
        rows.append((
            ref if i % 50 else None,
            rng.gauss(0 if ref else 2, 1),
            rng.gauss(0, 1 if ref else 2),
            rng.gauss(5, 1),
            7.0,
            float(rng.randrange(6)) if i % 7 else None,
            math.inf if i % 90 == 3 else rng.random(),
            1.0 if ref else None,
            None,
        ))
    names = ["shifted", "crossing", "equal", "constant", "whole", "infinite", "one_side", "gone"]
    df = spark.createDataFrame(rows, "ref boolean, " + ", ".join(f"{n} double" for n in names)).repartition(3)
    found = {r["feature"]: r for r in drift.distances(df, names, F.col("ref"), buckets, 100).collect()}
    want = {r["feature"]: r for r in drift.ordered_scores(drift.value_counts(df, names, F.col("ref"))).collect()}
    assert set(found) == set(want) == set(names) - {"one_side", "gone"}
    for name, row in want.items():
        assert found[name]["ks"] == pytest.approx(row["ks"], rel=1e-12)
        assert found[name]["wasserstein"] == pytest.approx(row["wasserstein"], rel=1e-9)


def test_buckets_settle_what_cannot_cross():
    bucket = dict(bucket=0, ref_sum=0.0, cur_sum=0.0)
    # all of one group first: the distance only grows, nothing is left open
    apart = [
        {**bucket, "ref": 10, "cur": 0, "low": 0.0, "high": 1.0, "ref_sum": 5.0},
        {**bucket, "bucket": 1, "ref": 0, "cur": 10, "low": 2.0, "high": 3.0, "cur_sum": 5.0},
    ]
    settled = drift._settle(apart, 0.0, 2.0)
    assert settled.open == [] and settled.ks == 1.0 and settled.area == pytest.approx(2.0)
    mixed = [{**bucket, "ref": 5, "cur": 5, "low": 0.0, "high": 1.0}]
    assert drift._settle(mixed, 0.0, 1.0).open == [(0, 1.0, 0, 0)]


@pytest.mark.parametrize("buckets", [1024, 3])
def test_quantiles_are_exact(spark, buckets):
    rng = random.Random(4)
    values = [rng.randrange(2000) / 4 for _ in range(1200)]
    df = spark.createDataFrame([(v, None) for v in values], "x double, gone double")
    shares = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    found = {
        r["feature"]: r
        for r in preprocess.quantiles(df, ["x", "gone"], shares, buckets).collect()
    }
    assert set(found) == {"x"}
    ordered = sorted(values)
    for name, share in shares.items():
        h = (len(ordered) - 1) * share
        low = ordered[int(h)]
        expected = low + (ordered[min(int(h) + 1, len(ordered) - 1)] - low) * (h - int(h))
        assert found["x"][name] == pytest.approx(expected)
    small = spark.createDataFrame([(1,), (2,), (4,), (10,)], "x int")
    assert preprocess.median_values(small, ["x"]) == {"x": 3.0}


@pytest.mark.parametrize("buckets", [1024, 2])
def test_selection_over_hard_values(spark, buckets):
    """Wide ranges, neighbours among the doubles, infinities, NaN and long runs of one value."""
    inf = math.inf
    columns = {
        "wide": [-1.7e308, 1.7e308, 1e-300, 5.0, 5.0, -3.0, 0.0],
        "tiny": [k * 5e-324 for k in (1, 2, 3, 4, 5, 6, 7)],
        "ends": [-inf, -inf, 2.0, 3.0, 4.0, inf, math.nan],
        "same": [7.0] * 7,
        "close": [1.0, 1.0 + 2**-52, 1.0 + 2**-51, 1e9, 1e9, 1e9, None],
        "all_nan": [math.nan] * 7,
    }
    schema = ", ".join(f"{c} double" for c in columns)
    df = spark.createDataFrame(list(zip(*columns.values())), schema).repartition(3)
    shares = (0.0, 0.25, 0.4, 0.5, 0.75, 1.0)
    found = selection.order_statistics(df, list(columns), shares, buckets)
    for c, values in columns.items():
        ordered = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
        n, known = found[c]
        assert n == len(ordered)
        assert set(known) == {f(s * (n - 1)) for s in shares for f in (math.floor, math.ceil)}
        assert all(str(ordered[r]) == str(v) for r, v in known.items())
    assert selection.order_statistics(df.limit(0), list(columns), shares) == {}


def test_selection_moves_buckets_not_values(spark):
    df = spark.range(20_000).select((F.rand(3) * 1000).alias("x"))
    wanted = {"x": {selection.Interval(0.0, 1000.0, 0): [9_999, 10_000]}}
    buckets = selection._counted(df, wanted, 64)
    assert len(buckets) in (1, 2)
    assert all(b["through"] - b["below"] < 20_000 / 64 * 2 for b in buckets)


def test_standardize_and_weights(spark):
    df = spark.createDataFrame([(1.0, 5, True), (3.0, 5, False), (5.0, 5, False)], "x double, c int, y boolean")
    out = preprocess.standardize(df, preprocess.scales(df, ["x", "c"])).orderBy("x").collect()
    assert [r["x"] for r in out] == pytest.approx([-math.sqrt(1.5), 0, math.sqrt(1.5)])
    assert {r["c"] for r in out} == {0.0}
    weights = {r["label"]: r["weight"] for r in preprocess.class_weights(df, "y").collect()}
    assert weights == {True: 1.5, False: 0.75}


def test_splits(spark):
    df = spark.createDataFrame([(y, y % 2 == 0) for y in range(2010, 2024)], "year int, target boolean")
    split = splits.temporal_split(df)
    stats = {r["split"]: r for r in splits.split_stats(split).collect()}
    assert stats["train"]["years"] == "2010-2016" and stats["test"]["samples"] == 2
    assert splits.union_splits(splits.split_frames(split)).count() == 11
    empty = {r["split"]: r["years"] for r in splits.split_stats(split.where("year < 2017")).collect()}
    assert empty == {"train": "2010-2016", "val": "N/A", "test": "N/A"}
    pct = {r["split"]: r["target_pct"] for r in splits.split_distribution(split, ["target"]).collect()}
    assert pct["val"] == 50.0
    for bad in ((2017, (2017,), (2019,)), (2016, (2017, 2019), (2019,)), (2016, (2018,), (2017,))):
        with pytest.raises(ValueError):
            splits.check_split_years(*bad)


def test_split_filter_reaches_the_scan(spark, tmp_path):
    spark.range(10).selectExpr("CAST(2010 + id AS INT) AS year", "id").write.parquet(f"{tmp_path}/t")
    split = splits.temporal_split(spark.read.parquet(f"{tmp_path}/t"))
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan.replace("\n", "")


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, None), (None, "b")], "k int, v string")
    assert [tuple(r) for r in quality.duplicates(df, ["k"]).collect()] == [(1, 2)]
    assert {r[0]: r[1] for r in quality.null_counts(df, ["k", "v"]).collect()} == {"k": 1, "v": 2}
    parent = spark.createDataFrame([(1,)], "id int")
    assert [r["k"] for r in quality.orphans(df, "k", parent, "id").collect()] == [2]


def test_labels_and_rankings(spark):
    rows = [
        (1, 10, 3, 0.9, 0.6, True, True), (1, 11, None, 0.9, 0.1, True, False),
        (1, 12, 1, 0.2, 0.2, False, False),
    ]
    df = spark.createDataFrame(
        rows,
        "race_id int, driver_id int, grid_position int, top10_probability double, "
        "dnf_probability double, target_top_10 boolean, target_dnf boolean",
    ).withColumns({"top10_prediction": F.lit(True), "dnf_prediction": F.lit(False),
                   "qualifying_position": F.col("grid_position")})
    top = summaries.top_per_race(df, "top10_probability", 2).orderBy("rank").collect()
    assert [r["driver_id"] for r in top] == [10, 11]
    assert [r["driver_id"] for r in summaries.grid_order(df).collect()] == [12, 10, 11]
    drivers = spark.createDataFrame([(10, "Ten")], "driver_id int, full_name string")
    shown = summaries.race_prediction_table(df, drivers).collect()
    assert [(r["Driver"], r["Prediction"]) for r in shown] == [
        ("12", "Outside Top-10"), ("Ten", "DNF"), ("11", "Top-10"),
    ]
    panel = summaries.race_panel(df).first()
    assert (panel["predicted_top10"], panel["predicted_dnf"], panel["drivers"]) == (1, 1, 3)
    assert panel["top10_accuracy"] == pytest.approx(2 / 3)


def test_missing_values_in_metrics(spark):
    """Missing predictions are wrong; missing scores and labels are left out of score metrics."""
    rows = [(True, True, 0.9), (False, False, 0.2), (True, None, None), (None, True, 0.99), (False, None, 0.1)]
    df = spark.createDataFrame(rows, "y boolean, pred boolean, p double")
    loss = -(math.log(0.9) + math.log(0.8) + math.log(0.9)) / 3
    assert df.agg(metrics.log_loss("p", "y")).first()[0] == pytest.approx(loss)
    report = {r["label"]: r for r in metrics.classification_report(df, "pred", "y").collect()}
    assert (report["true"]["recall"], report["true"]["precision"], report["true"]["support"]) == (0.5, 1.0, 2)
    assert (report["false"]["recall"], report["false"]["precision"], report["false"]["support"]) == (0.5, 1.0, 2)
    labelled = df.where("y IS NOT NULL")
    flat = metrics.accuracy(labelled, {"a": ("pred", "y")}).first()["a"]
    assert report["accuracy"]["precision"] == flat == 0.5
    cells = {(r[0], r[1]): r[2] for r in metrics.confusion_matrix(df, "pred", "y").collect()}
    assert cells == {
        (False, False): 1, (False, True): 0, (False, None): 1,
        (True, False): 0, (True, True): 1, (True, None): 1,
    }


def test_one_class_among_the_scored_rows(spark):
    rows = [(True, True, 0.9), (True, True, 0.4), (False, None, None), (None, None, 0.3)]
    df = spark.createDataFrame(rows, "y boolean, pred boolean, p double")
    row = metrics.binary_metrics(df, "pred", "p", "y").first()
    assert (row["roc_auc"], row["log_loss"]) == (1.0, 0.0)
    assert row["positive_rate"] == pytest.approx(2 / 3) and row["n_rows"] == 4
