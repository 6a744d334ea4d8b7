"""Time splits and their description."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.functions.scalars import split_of

TRAIN_END = 2016
VAL_YEARS = (2017, 2018)
TEST_YEARS = (2019, 2020)
SPLITS = ("train", "val", "test")


def check_split_years(train_end: int, val_years: Sequence[int], test_years: Sequence[int]) -> None:
    """Training years lie before validation years, which do not pass test years."""
    if set(val_years) & set(test_years):
        raise ValueError("validation and test years overlap")
    if val_years and train_end >= min(val_years):
        raise ValueError("training years reach into validation years")
    if val_years and test_years and max(val_years) > min(test_years):
        raise ValueError("validation years reach into test years")


def temporal_split(
    df: DataFrame,
    train_end: int = TRAIN_END,
    val_years: Sequence[int] = VAL_YEARS,
    test_years: Sequence[int] = TEST_YEARS,
) -> DataFrame:
    """Add the name of the split; rows whose year is in none are dropped."""
    check_split_years(train_end, val_years, test_years)
    name = split_of(F.col("year"), train_end, val_years, test_years)
    # stated on the year itself, so that it reaches the scan
    in_a_split = (F.col("year") <= train_end) | F.col("year").isin([*val_years, *test_years])
    return df.where(in_a_split).withColumn("split", name)


def split_frames(split: DataFrame) -> dict[str, DataFrame]:
    return {name: split.where(F.col("split") == name).drop("split") for name in SPLITS}


def union_splits(frames: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames.values())


def filter_race(df: DataFrame, year: int | None = None, race_id=None) -> DataFrame:
    """Rows of one year, one race, or both; no filter where None."""
    if year is not None:
        df = df.where(F.col("year") == year)
    if race_id is not None:
        df = df.where(F.col("race_id") == race_id)
    return df


def filter_years(df: DataFrame, years: Sequence[int]) -> DataFrame:
    return df.where(F.col("year").isin(list(years)))


def split_distribution(split: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Rows, year range, positives and positive percentage per split and target."""
    measures = []
    for target in targets:
        positive = F.col(target).cast("int")
        measures += [
            F.sum(positive).alias(f"{target}_positive"),
            F.sum(1 - positive).alias(f"{target}_negative"),
            (F.avg(positive.cast("double")) * 100).alias(f"{target}_pct"),
        ]
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        *measures,
    )


def split_stats(split: DataFrame) -> DataFrame:
    """Rows and ``first-last`` years for each of the three splits, ``N/A`` if empty."""
    names = split.sparkSession.sql(
        "SELECT * FROM VALUES " + ", ".join(f"('{n}')" for n in SPLITS) + " AS t(split)"
    )
    found = split.groupBy("split").agg(
        F.count(F.lit(1)).alias("samples"),
        F.concat_ws("-", F.min("year"), F.max("year")).alias("years"),
    )
    return names.join(found, "split", "left").select(
        "split",
        F.coalesce("samples", F.lit(0)).alias("samples"),
        F.coalesce("years", F.lit("N/A")).alias("years"),
    )
