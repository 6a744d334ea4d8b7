"""The steps of the pipeline from CSV files to predictions, each on folders.

State passes between steps as tables and stored models, so each step can run as its
own Spark application: ``python -m paddock <step> --help``.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.functions.scalars import summary_label
from paddock.operators import metrics, quality, splits, summaries
from paddock.plans import features as ft
from paddock.plans import declared, marts, reports, training, warehouse
from paddock.plans.staging import NAMES, stage
from paddock.scratch import materialize
from paddock.sources import csv_lake, files, lake, schemas, sinks, toy

log = logging.getLogger(__name__)


def generate_toy(
    spark: SparkSession, lake_dir: str, seasons: int = 7, rounds: int = 5, drivers: int = 10
) -> DataFrame:
    """Write the toy lake; returns table names and row counts."""
    counts = []
    for name, df in toy.lake(spark, seasons, rounds, drivers).items():
        path = f"{lake_dir}/{name}.parquet"
        csv_lake.write_table(df, path)
        counts.append((name, spark.read.parquet(path).count()))
    return spark.createDataFrame(counts, "table string, n_rows bigint")


def ingest(spark: SparkSession, raw_dir: str, lake_dir: str) -> DataFrame:
    """Convert every CSV file to a typed Parquet table; returns statistics per file."""
    return csv_lake.convert_all(spark, raw_dir, lake_dir)


def validate(spark: SparkSession, lake_dir: str) -> DataFrame:
    """Required and optional tables with their missing columns."""
    tables = lake.read_tables(spark, lake_dir)
    return quality.check_columns(spark, tables, schemas.REQUIRED, schemas.OPTIONAL)


def register(spark: SparkSession, lake_dir: str, database: str | None = None) -> DataFrame:
    """Register the lake as ``raw_`` views; returns their row counts.

    Views end with the session.  With a database the tables are entered in the catalog,
    which may outlast it.
    """
    names = lake.register(spark, lake_dir)
    if database:
        lake.register_tables(spark, lake_dir, database)
    return lake.inventory(spark, names=names)


def sql(spark: SparkSession, lake_dir: str, text: str) -> DataFrame:
    """Ad-hoc SQL over the ``raw_`` views of a lake."""
    lake.register(spark, lake_dir)
    return lake.query(spark, text)


def test(spark: SparkSession, lake_dir: str, marts_dir: str) -> DataFrame:
    """Every declared data test with its failures, over the lake and the built marts."""
    tables = lake.read_tables(spark, lake_dir)
    built = {
        name: spark.read.parquet(f"{marts_dir}/{name}.parquet") for name in warehouse.MARTS
    }
    return declared.run({**declared_models(tables), **built})


def declared_models(tables, top_k: int = marts.TOP_K) -> dict[str, DataFrame]:
    """The staged and enriched tables by model name."""
    models = {f"stg_{t}": stage(t, tables[t]) for t in NAMES}
    models["int_results_enriched"] = marts.results_enriched(tables, top_k)
    models["int_qualifying_clean"] = marts.qualifying_clean(tables)
    return models


def build(
    spark: SparkSession, lake_dir: str, marts_dir: str, unique_qualifying: bool = False
) -> DataFrame:
    """Build all marts; returns the feature table."""
    tables = lake.read_tables(spark, lake_dir)
    built = warehouse.build(spark, tables, marts_dir, unique_qualifying=unique_qualifying)
    return built["fct_features_pre_race"]


def feature_table(spark: SparkSession, marts_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{marts_dir}/fct_features_pre_race.parquet")
    return table.select(*ft.COLUMNS)


def export_features(
    spark: SparkSession,
    marts_dir: str,
    output_dir: str | None = None,
    train_end: int = splits.TRAIN_END,
    val_years: Sequence[int] = splits.VAL_YEARS,
    test_years: Sequence[int] = splits.TEST_YEARS,
) -> dict[str, DataFrame]:
    """Train, validation and test rows; also written as CSV if a folder is given."""
    split = splits.temporal_split(
        feature_table(spark, marts_dir), train_end, val_years, test_years
    )
    if output_dir:
        sinks.write_splits(split, output_dir)
    return splits.split_frames(split)


def train(
    spark: SparkSession,
    marts_dir: str,
    models_dir: str,
    name: str,
    trees: int = training.TREES,
    depth: int = training.DEPTH,
    run: str | None = None,
    **split_years,
) -> DataFrame:
    """Train and store one model with its importances; returns train and validation metrics.

    With a run name, parameters and metrics are recorded in ``<models_dir>/runs``; the same
    name replaces them.
    """
    frames = export_features(spark, marts_dir, **split_years)
    target, stored = training.MODELS[name]
    model = training.train(frames["train"], target, trees=trees, depth=depth)
    training.save(model, models_dir, name)
    importance = training.importances(model).coalesce(1)
    importance.write.mode("overwrite").option("header", True).csv(
        f"{models_dir}/{stored}_feature_importance"
    )
    checked = materialize(training.score(frames["val"], {name: model}), "scored")
    sinks.write_csv(
        training.evaluation_report(checked, [name]), f"{models_dir}/{stored}_validation_report"
    )
    names = spark.createDataFrame([(c,) for c in ft.FEATURES], "feature string").coalesce(1)
    names.write.mode("overwrite").text(f"{models_dir}/{stored}_features")
    result = materialize(
        training.train_metrics(model, name, {n: frames[n] for n in ("train", "val")}), "metrics"
    )
    if run:
        values = {
            f"{row['split']}_{m}": row[m]
            for row in result.collect()
            for m in ("accuracy", "roc_auc", "log_loss", "positive_rate")
            if row[m] is not None
        }
        parameters = {"target": target, "trees": trees, "depth": depth, **split_years}
        sinks.record_run(spark, f"{models_dir}/runs", run, parameters, values)
    return result


def evaluate(
    spark: SparkSession, marts_dir: str, models_dir: str, reports_dir: str, **split_years
) -> DataFrame:
    """Metrics of all stored models on the test split.

    Predictions, classification report, confusion matrix and curve points are written.
    """
    test = export_features(spark, marts_dir, **split_years)["test"]
    models = training.load_all(spark, models_dir)
    scored = materialize(training.score(test, models), "scored")
    for name in models:
        rows = sinks.evaluation_rows(scored, training.MODELS[name][0], name)
        sinks.write_csv(rows, f"{reports_dir}/{name}_test_predictions")
        report = training.evaluation_report(scored, [name])
        sinks.write_csv(report, f"{reports_dir}/{name}_evaluation")
    return training.evaluate_all(test, models, scored)


def report(
    spark: SparkSession,
    marts_dir: str,
    reports_dir: str,
    with_targets: bool = False,
    **split_years,
) -> dict[str, DataFrame]:
    """Classification report per model with saved predictions, and the drift report.

    The drift report covers the features, and the two targets as well if asked to.
    """
    tables = {}
    for name in training.MODELS:
        path = f"{reports_dir}/{name}_test_predictions"
        if not files.exists(spark, path):
            log.warning("no predictions at %s; run evaluate first", path)
            continue
        tables[f"{name}_report"] = reports.report_classification(
            sinks.read_evaluation(spark, path)
        )
    frames = export_features(spark, marts_dir, **split_years)
    split = frames["train"].withColumn("split", F.lit("train")).unionByName(
        frames["test"].withColumn("split", F.lit("test"))
    )
    tables["drift"] = materialize(reports.drift_report(split, [*ft.FEATURES, *(ft.TARGETS if with_targets else ())]), "drift")
    tables["drift_summary"] = reports.drift_totals(tables["drift"])
    for name, table in tables.items():
        sinks.write_csv(table, f"{reports_dir}/{name}")
    return tables


def _write(df: DataFrame, output: str | None, kind: str = "csv") -> None:
    if output and kind == "json":
        df.write.mode("overwrite").json(output)
    elif output:
        sinks.write_csv(df, output)


def predict(
    spark: SparkSession,
    marts_dir: str,
    models_dir: str,
    year: int | None = None,
    race_id=None,
    output: str | None = None,
    kind: str = "csv",
    **split_years,
) -> DataFrame:
    """Score the rows of a year and/or race that lie in some split; selected columns."""
    frames = export_features(spark, marts_dir, **split_years)
    rows = splits.filter_race(splits.union_splits(frames), year, race_id)
    out = sinks.selected(training.score(rows, training.load_all(spark, models_dir)))
    _write(out, output, kind)
    return out


def predict_csv(
    spark: SparkSession, csv_path: str, models_dir: str, output: str | None = None
) -> DataFrame:
    """Score feature rows from CSV; all columns are kept.

    With an output, records that do not fit their header are set aside in
    ``<output>_quarantine`` with file and reason.
    """
    raw = csv_lake.scan_csv(spark, csv_path)
    out = training.score(csv_lake.typed(raw), training.load_all(spark, models_dir))
    _write(out, output)
    if output:
        sinks.write_csv(csv_lake.quarantined(raw), f"{output.rstrip('/')}_quarantine")
    return out


def predict_batch(
    spark: SparkSession,
    marts_dir: str,
    models_dir: str,
    years: Sequence[int] | None = None,
    output_dir: str | None = None,
    **split_years,
) -> DataFrame:
    """Score the test split, or the given years, with one output per race.

    Also writes the summary per race and its ten likeliest top finishers.  In a folder with
    earlier output, the races scored now replace their own; the tables are those of this run.
    """
    frames = export_features(spark, marts_dir, **split_years)
    rows = frames["test"]
    if years is not None:
        rows = splits.filter_years(splits.union_splits(frames), years)
    scored = materialize(
        training.score(rows, training.load_all(spark, models_dir)), "predictions"
    )
    if output_dir:
        sinks.write_csv(scored, f"{output_dir}/all_predictions")
        sinks.write_per_race(scored, f"{output_dir}/by_race")
        sinks.write_csv(summaries.race_summary(scored), f"{output_dir}/race_summary")
        sinks.write_csv(top_finishers(scored), f"{output_dir}/top_finishers")
    return scored


def top_finishers(scored: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` likeliest top finishers of each race with their label."""
    label = summary_label(F.col("top10_prediction"), F.col("dnf_prediction"))
    top = summaries.top_per_race(scored, "top10_probability", k).withColumn("label", label)
    return top.select(
        "year", "round", "race_id", "rank", "driver_id",
        F.coalesce("grid_position", F.lit(0)).alias("grid_position"),
        "top10_probability", "dnf_probability", "label",
    )


def prediction_accuracy(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accuracy overall and by year, for the outcomes that were predicted."""
    pairs = {
        f"{name}_accuracy": (f"{name}_prediction", target)
        for name, (target, _) in training.MODELS.items()
        if f"{name}_prediction" in scored.columns and target in scored.columns
    }
    return metrics.accuracy(scored, pairs), metrics.accuracy_by_year(scored, pairs)
