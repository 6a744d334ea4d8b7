import random

import pytest
from pyspark.sql import functions as F

from paddock.plans import training
from paddock.scratch import materialize

COLUMNS = ["a", "b", "flag"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(11)
    data = []
    for i in range(400):
        top = rng.random() < 0.4
        a = None if rng.random() < 0.1 else rng.gauss(2.0 if top else 0.0, 1.0)
        data.append((i, a, rng.random(), rng.random() < 0.5, top, rng.random() < 0.2, True))
    schema = "id int, a double, b double, flag boolean, target_top_10 boolean, target_dnf boolean, ever boolean"
    return materialize(spark.createDataFrame(data, schema), "training")


@pytest.fixture(scope="module")
def models(rows):
    return {
        "top10": training.train(rows, "target_top_10", COLUMNS, trees=10, depth=4),
        "dnf": training.train(rows, "target_dnf", COLUMNS, trees=10, depth=4),
    }


def test_scores_and_metrics(rows, models):
    scored = training.score(rows, models)
    assert scored.columns == [
        *rows.columns, "top10_probability", "top10_prediction", "dnf_probability", "dnf_prediction",
    ]
    outside = scored.where(~F.col("top10_probability").between(0, 1)).count()
    assert outside == 0 and scored.count() == 400
    table = {r["model"]: r for r in training.evaluate_all(rows, models).collect()}
    assert table["top10"]["roc_auc"] > 0.85 and table["dnf"]["n_rows"] == 400
    by_split = training.train_metrics(models["top10"], "top10", {"train": rows, "val": rows})
    assert {r["split"] for r in by_split.collect()} == {"train", "val"}


def test_importances(models):
    table = training.importances(models["top10"], COLUMNS).collect()
    assert table[0]["feature"] == "a" and sum(r["importance"] for r in table) == pytest.approx(1)


def test_stored_models_score_the_same(spark, rows, models, tmp_path):
    for name, model in models.items():
        training.save(model, str(tmp_path), name)
    again = training.load_all(spark, str(tmp_path))
    a, b = training.score(rows, models), training.score(rows, again)
    assert a.exceptAll(b).isEmpty()


def test_missing_models(spark, rows, models, tmp_path):
    with pytest.raises(FileNotFoundError):
        training.load_all(spark, f"{tmp_path}/none")
    training.save(models["dnf"], str(tmp_path), "dnf")
    only = training.load_all(spark, str(tmp_path))
    assert set(only) == {"dnf"}
    assert "top10_probability" not in training.score(rows, only).columns


@pytest.mark.parametrize("value", [True, False])
def test_training_with_one_class(rows, value):
    same = rows.withColumn("target_top_10", F.lit(value))
    model = training.train(materialize(same, "same"), "target_top_10", COLUMNS, trees=3, depth=2)
    scored = training.score(same, {"top10": model})
    assert [r[0] for r in scored.select("top10_probability").distinct().collect()] == [1.0]
    assert training.saw_one_class(model)
    mixed = training.evaluate_all(rows, {"top10": model}).first()
    assert (mixed["roc_auc"], mixed["log_loss"]) == (1.0, 0.0)


def test_a_forest_sends_bounded_histograms(spark, rows):
    """However short the parts are asked to be, their number stops growing."""
    context = spark.sparkContext
    context.setJobGroup("forest of short parts", "")
    try:
        training.train(rows, "target_top_10", COLUMNS, trees=2, depth=2, partition_rows=4, key="id")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("forest of short parts")]
    stages = [tracker.getStageInfo(s) for job in jobs if job for s in job.stageIds]
    assert 30 < max(stage.numTasks for stage in stages if stage) <= 64


SAME_FOREST = """
import sys
sys.path[:0] = [{root!r}, {tests!r}]
from pyspark.sql import SparkSession, functions as F
from paddock.plans import training
spark = SparkSession.builder.master(sys.argv[1]).config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
rows = spark.read.parquet(sys.argv[2]).repartition(int(sys.argv[3]))
model = training.train(rows, "target_top_10", ["a", "b", "flag"], trees=6, depth=5, partition_rows=90, key="id")
print("FOREST", hash(model.stages[-1].toDebugString.split("\\n", 1)[1]))
"""


def test_the_same_forest_on_any_cluster(rows, tmp_path):
    """On 2 and on 8 cores, with the input split in two ways."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    tests = str(Path(__file__).resolve().parent)
    rows.write.parquet(f"{tmp_path}/rows")
    code = SAME_FOREST.format(root=str(Path(tests).parent), tests=tests)
    found = set()
    for master, parts in (("local[2]", "3"), ("local[8]", "7")):
        done = subprocess.run(
            [sys.executable, "-c", code, master, f"{tmp_path}/rows", parts],
            capture_output=True, text=True, timeout=300, env=os.environ | {"PYTHONHASHSEED": "0"},
        )
        found.update(line for line in done.stdout.splitlines() if line.startswith("FOREST"))
        assert done.returncode == 0, done.stderr[-2000:]
    assert len(found) == 1


def test_trees_grown_in_several_forests_are_one(spark, rows, models, tmp_path):
    name, target = "top10", "target_top_10"
    model = training.train(rows, target, COLUMNS, trees=10, depth=4, tree_rows=1_300)
    forests = model.stages[2:]
    assert [f.getNumTrees for f in forests] == [3, 3, 2, 2] and len(model.stages) == 6
    assert len({t.toDebugString for f in forests for t in f.trees}) == 10
    training.save(model, str(tmp_path), name)
    again = training.load_all(spark, str(tmp_path))
    scored = training.score(rows, {name: model})
    assert scored.exceptAll(training.score(rows, again)).isEmpty()
    assert scored.columns == [*rows.columns, "top10_probability", "top10_prediction"]
    # the mean of all trees, one by one
    inputs = [r["model_input"] for r in model.transform(rows).orderBy("id").limit(50).collect()]
    for row, x in zip(scored.orderBy("id").limit(50).collect(), inputs, strict=True):
        votes = [t.predictProbability(x)[1] for f in forests for t in f.trees]
        assert row["top10_probability"] == pytest.approx(sum(votes) / 10, abs=1e-12)
        assert row["top10_prediction"] == (sum(votes) > 5)
    table = {r["feature"]: r["importance"] for r in training.importances(model, COLUMNS).collect()}
    each = [t.featureImportances.toArray() for f in forests for t in f.trees]
    assert table == pytest.approx(dict(zip(COLUMNS, sum(each) / 10, strict=True)))
    assert training.evaluate_all(rows, {name: model}).first()["roc_auc"] > 0.85
    assert not training.saw_one_class(model)
    one = training.train(rows, "ever", COLUMNS, trees=4, depth=2, tree_rows=400)
    assert training.saw_one_class(one)
    assert training.score(rows, {name: one}).where("top10_probability <> 1 OR NOT top10_prediction").isEmpty()


def _shuffle_files(spark):
    """Names of the shuffle files on this machine's disk."""
    import os

    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in folders for _, _, files in os.walk(d.getPath()) for f in files if f.startswith("shuffle_")}


def test_stored_tables_and_forests_leave_no_shuffle_files(spark, rows):
    import time

    before = _shuffle_files(spark)
    materialize(rows.groupBy("flag").count(), "counts")
    assert not _shuffle_files(spark) - before
    model = training.train(rows, "target_top_10", COLUMNS, trees=4, depth=3, tree_rows=800, key="id")
    for _ in range(40):
        # what nothing refers to is deleted in the background
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.25)
    assert not left and len(model.stages) == 4
