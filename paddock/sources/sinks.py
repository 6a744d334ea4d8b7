"""Where splits, predictions, importances and run metrics are written."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.sources.folders import read_folders, write_folders

# Columns of the short prediction file, in order.
SELECTED = (
    "race_id", "year", "round", "driver_id", "grid_position", "qualifying_position",
    "top10_probability", "top10_prediction", "dnf_probability", "dnf_prediction",
    "target_top_10", "target_dnf",
)


PER_RACE = ("year", "round", "race_id")


def selected(predictions: DataFrame) -> DataFrame:
    """The short form: those of the selected columns that exist."""
    return predictions.select(*[c for c in SELECTED if c in predictions.columns])


# One dialect for all files: a header, and quotes doubled inside quotes.
DIALECT = {"header": True, "escape": '"'}


def write_splits(split: DataFrame, folder: str) -> None:
    """One CSV folder per split, ``split=<name>``, with headers; earlier ones are replaced."""
    split.write.mode("overwrite").partitionBy("split").options(**DIALECT).csv(folder)


def write_csv(df: DataFrame, folder: str) -> None:
    """A CSV folder with headers in its files; an earlier one is replaced."""
    df.write.mode("overwrite").options(**DIALECT).csv(folder)


def read_csv(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    """Read a CSV folder back under the schema of ``like``; no text may span lines."""
    return spark.read.schema(like.schema).options(**DIALECT).csv(folder).select(*like.columns)


def write_per_race(predictions: DataFrame, folder: str, file_rows: int = 1_000_000) -> None:
    """One folder per race, by tasks; the races written replace their earlier files only.

    Races go to tasks by key, in as many partitions as their size asks for; a task that
    would get too much is split, so a large race becomes several files, of at most
    ``file_rows`` rows each.  With very many races a table by year is the better layout.
    """
    write_folders(predictions, PER_RACE, folder, DIALECT, file_rows)


def read_per_race(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    """Read the folders of all races back under the schema of ``like``, by tasks."""
    return read_folders(spark, PER_RACE, folder, like.schema, DIALECT)


def as_json(df: DataFrame) -> DataFrame:
    """One JSON record per row, in a column named ``record``."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))


def from_json(records: DataFrame, like: DataFrame) -> DataFrame:
    """Records of ``as_json`` as rows again, each parsed once, and the text of broken ones.

    ``broken`` is NULL for a record that is an object with values of the right types.
    """
    schema = T.StructType([*like.schema.fields, T.StructField("broken", T.StringType())])
    read = F.from_json("record", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"})
    return records.select(read.alias("row")).select("row.*")


def evaluation_rows(scored: DataFrame, target: str, name: str) -> DataFrame:
    """(actual, prediction, probability) of one model."""
    return scored.select(
        F.col(target).alias("actual"),
        F.col(f"{name}_prediction").alias("prediction"),
        F.col(f"{name}_probability").alias("probability"),
    )


def read_evaluation(spark: SparkSession, folder: str) -> DataFrame:
    """Saved evaluation rows; without a probability the prediction stands in for it."""
    raw = spark.read.options(**DIALECT).csv(folder)
    prediction = F.col("prediction").cast("boolean")
    probability = (
        F.col("probability").cast("double")
        if "probability" in raw.columns
        else prediction.cast("int").cast("double")
    )
    return raw.select(
        F.col("actual").cast("boolean").alias("actual"),
        prediction.alias("prediction"),
        probability.alias("probability"),
    )


RUNS = "kind string, name string, text string, value double, run string"


def record_run(
    spark: SparkSession,
    folder: str,
    run: str,
    parameters: Mapping[str, object],
    metrics: Mapping[str, float],
) -> None:
    """Commit one row per parameter and metric of a run to a Parquet table.

    A run has a folder of its own, which the commit replaces: one that is repeated, or
    tried again after a failure, leaves its rows once, and other runs as they are.
    """
    rows: Iterable[tuple] = [
        *[("parameter", k, str(v), None, run) for k, v in parameters.items()],
        *[("metric", k, None, float(v), run) for k, v in metrics.items()],
    ]
    writer = spark.createDataFrame(list(rows), RUNS).coalesce(1).write.partitionBy("run")
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(folder)


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    """(run, kind, name, text, value) of all recorded runs."""
    return spark.read.schema(RUNS).parquet(folder).select("run", "kind", "name", "text", "value")
