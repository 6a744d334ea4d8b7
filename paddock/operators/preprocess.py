"""What is learned from the training rows before a model: medians, scales, weights."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paddock.operators.selection import BUCKETS, order_statistics


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    wanted: Mapping[str, float],
    buckets: int = BUCKETS,
) -> DataFrame:
    """(feature, one column per wanted share): exact quantiles of the present values.

    A quantile lies between the values of its two neighbouring ranks, which are found by
    refinement of buckets.  A column without any value has no row.
    """
    rows = []
    for name, (n, values) in order_statistics(df, columns, list(wanted.values()), buckets).items():
        row: list = [name]
        for share in wanted.values():
            place = (n - 1) * share
            low, high = values[math.floor(place)], values[math.ceil(place)]
            row.append(low if low == high else low + (high - low) * (place - math.floor(place)))
        rows.append(tuple(row))
    schema = ", ".join(["feature string", *[f"`{name}` double" for name in wanted]])
    return df.sparkSession.createDataFrame(rows, schema)


def medians(df: DataFrame, columns: Sequence[str], **options) -> DataFrame:
    """(feature, median): exact medians of the present values."""
    return quantiles(df, columns, {"median": 0.5}, **options)


def median_values(df: DataFrame, columns: Sequence[str], **options) -> dict[str, float]:
    """Medians by column on the driver; 0.0 for a column without any value."""
    found = {r["feature"]: r["median"] for r in medians(df, columns, **options).collect()}
    return {c: found.get(c, 0.0) for c in columns}


def impute(df: DataFrame, fill: Mapping[str, float]) -> DataFrame:
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(float(v))) for c, v in fill.items()}
    )


def scales(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation by column, in one pass."""
    numbers = {c: F.col(c).cast("double") for c in columns}
    row = df.agg(
        *[F.avg(n).alias(f"mean_{c}") for c, n in numbers.items()],
        *[F.stddev_pop(n).alias(f"std_{c}") for c, n in numbers.items()],
    ).first()
    return {c: (row[f"mean_{c}"] or 0.0, row[f"std_{c}"] or 0.0) for c in columns}


def standardize(df: DataFrame, by: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Zero mean, unit variance; a constant column becomes 0."""
    return df.withColumns(
        {
            c: (F.col(c).cast("double") - F.lit(mean)) / F.lit(std if std > 0 else 1.0)
            for c, (mean, std) in by.items()
        }
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n_rows, weight): rows / (classes x rows of the class), as many as classes."""
    sizes = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    # one row per class
    classes = Window.partitionBy(F.lit(0))
    rows = F.sum("n_rows").over(classes).cast("double")
    weight = rows / (F.count(F.lit(1)).over(classes) * F.col("n_rows"))
    return sizes.select("label", "n_rows", weight.alias("weight"))
