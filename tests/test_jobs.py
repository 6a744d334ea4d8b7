"""The whole pipeline on the toy lake, from CSV files to per-race predictions."""

import pytest
from pyspark.sql import functions as F

from paddock import jobs
from paddock.__main__ import main, parser
from paddock.sources import files, toy


@pytest.fixture(scope="module")
def home(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("pipeline")
    for name, df in toy.lake(spark).items():
        df.write.option("header", True).option("nullValue", "\\N").csv(f"{home}/raw/{name}.csv")
    stats = jobs.ingest(spark, f"{home}/raw", f"{home}/lake")
    assert stats.where("ok").count() == 8
    assert jobs.validate(spark, f"{home}/lake").where("NOT ok").isEmpty()
    table = jobs.build(spark, f"{home}/lake", f"{home}/marts")
    assert table.count() == 350
    jobs.train(spark, f"{home}/marts", f"{home}/models", "top10", trees=3, depth=3)
    jobs.train(spark, f"{home}/marts", f"{home}/models", "dnf", trees=10, depth=5, run="first")
    return home


def test_lake_types(spark, home):
    types = dict(spark.read.parquet(f"{home}/lake/results.parquet").dtypes)
    assert types["resultId"] == "int" and types["points"] == "float"
    assert types["milliseconds"] == "double" and types["positionText"] == "string"


def test_year_filter_reads_one_folder(spark, home):
    one_year = jobs.feature_table(spark, f"{home}/marts").where("year = 2019")
    plan = one_year._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and one_year.count() == 50


def test_training_left_its_records(spark, home):
    runs = {r["name"]: r for r in spark.read.parquet(f"{home}/models/runs").collect()}
    assert runs["trees"]["text"] == "10" and 0 <= runs["val_accuracy"]["value"] <= 1
    names = spark.read.text(f"{home}/models/dnf_classifier_features").collect()
    assert len(names) == 24 and names[0]["value"] == "grid_position"


def test_evaluate_and_report(spark, home):
    table = {r["model"]: r for r in jobs.evaluate(
        spark, f"{home}/marts", f"{home}/models", f"{home}/reports").collect()}
    assert table["top10"]["accuracy"] == 1.0 and table["top10"]["roc_auc"] == 1.0
    assert table["dnf"]["n_rows"] == 100
    made = jobs.report(spark, f"{home}/marts", f"{home}/reports")
    assert set(made) == {"top10_report", "dnf_report", "drift", "drift_summary"}
    assert made["drift"].count() == 24
    assert made["drift_summary"].first()["features"] == 24


def test_predict(spark, home):
    marts, models = f"{home}/marts", f"{home}/models"
    one = jobs.predict(spark, marts, models, race_id=26, output=f"{home}/one", kind="json")
    assert one.count() == 10 and one.columns[0] == "race_id" and len(one.columns) == 12
    assert spark.read.json(f"{home}/one").count() == 10
    assert jobs.predict(spark, marts, models, year=2015).count() == 50
    jobs.export_features(spark, marts, f"{home}/features")
    back = jobs.predict_csv(spark, f"{home}/features/split=test", models)
    assert back.count() == 100 and "dnf_probability" in back.columns
    direct = jobs.predict_batch(spark, marts, models)
    both = back.select("result_id", "dnf_probability").join(
        direct.select("result_id", F.col("dnf_probability").alias("p")), "result_id"
    )
    assert both.where("abs(dnf_probability - p) > 1e-9").isEmpty() and both.count() == 100


def test_predict_batch(spark, home):
    scored = jobs.predict_batch(
        spark, f"{home}/marts", f"{home}/models", [2020], f"{home}/batch"
    )
    assert scored.count() == 50
    races = files.glob(spark, f"{home}/batch/by_race/year=2020/round=*/race_id=*")
    assert len(races) == 5
    top = jobs.top_finishers(scored)
    assert top.count() == 50 and {r["label"] for r in top.select("label").collect()} == {"TOP-10"}
    overall, by_year = jobs.prediction_accuracy(scored)
    assert overall.first()["top10_accuracy"] == 1.0 and by_year.count() == 1


def test_command_line(spark, home, capsys):
    main(["validate", "--lake-dir", f"{home}/lake"])
    assert "constructors" in capsys.readouterr().out
    steps = parser()._subparsers._group_actions[0].choices
    assert len(steps) == 14
