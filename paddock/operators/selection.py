"""Exact order statistics by refinement: what is shuffled are bucket counts, not values.

The first pass over the rows finds size, smallest and largest value of every column.  Each
further pass counts the values of the intervals that still hold a wanted rank in ``BUCKETS``
buckets of equal width, and goes on with the bucket of the rank, narrowed to the smallest
and largest value in it.  A rank is found when these are equal.  A pass combines its counts
before the shuffle; columns x intervals x buckets rows are the most it moves, however many
values there are.  The intervals of a pass are a few constants of its plan.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paddock.scratch import materialize, recorded, release

BUCKETS = 1024
_INFINITE = float("inf")


@dataclass(frozen=True)
class Interval:
    """Values from ``low`` to ``high``, with so many values of the column below them."""

    low: float
    high: float
    below: int


def _same(a: float, b: float) -> bool:
    return a == b or (math.isnan(a) and math.isnan(b))


# what an interval needs to number the buckets of its values, as columns
SCALE = "low double, high double, base double, span double, by double"


def scale_of(interval: Interval) -> tuple[float, float, float, float, float]:
    """The values of ``SCALE``: ends, and finite start and width, halved where the width is not."""
    low = max(interval.low, -sys.float_info.max)
    high = min(interval.high, sys.float_info.max) if interval.high == interval.high else sys.float_info.max
    by = 2.0 if math.isinf(high - low) else 1.0
    return interval.low, interval.high, low / by, high / by - low / by, by


def bucket_of(value: Column, buckets: int) -> Column:
    """Number of the bucket of a value by the columns of ``SCALE``; it never falls as the value grows.

    Infinite values and NaN, which is the largest, have buckets of their own at the ends.
    """
    share = F.when(F.col("span") > 0, (value / F.col("by") - F.col("base")) / F.col("span")).otherwise(0.0)
    inner = F.greatest(F.lit(0), F.least(F.floor(share * buckets), F.lit(buckets - 1)))
    return (
        F.when(F.isnan(value), buckets + 1)
        .when(value == _INFINITE, buckets)
        .when(value == -_INFINITE, -1)
        .otherwise(inner)
        .cast("int")
    )


def _counted(numbers: DataFrame, wanted: Mapping[str, Mapping[Interval, list[int]]], buckets: int) -> list:
    """(feature, part, n, low, high, below) of each bucket that holds a wanted rank."""
    spark, places = numbers.sparkSession, []
    for name, parts in wanted.items():
        places += [(name, k, i.below, ranks, *scale_of(i)) for k, (i, ranks) in enumerate(parts.items())]
    # one row per column and interval: a few constants, which keep the expressions short
    intervals = spark.createDataFrame(places, f"feature string, part int, start long, ranks array<long>, {SCALE}")
    value = F.col("value")
    each = numbers.unpivot([], list(wanted), "feature", "value").join(F.broadcast(intervals.drop("start", "ranks")), "feature")
    # comparisons know NaN as equal to itself and larger than anything else
    inside = each.where((value >= F.col("low")) & (value <= F.col("high")))
    counts = inside.groupBy("feature", "part", bucket_of(value, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    # at most a bucket count of rows in each partition of the window
    along = Window.partitionBy("feature", "part").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranks = intervals.select("feature", "part", "start", "ranks")
    placed = counts.withColumn("upto", F.sum("n").over(along)).join(F.broadcast(ranks), ["feature", "part"])
    placed = placed.withColumn("through", F.col("start") + F.col("upto")).withColumn("below", F.col("through") - F.col("n"))
    holds = F.exists("ranks", lambda r: (F.col("below") <= r) & (r < F.col("through")))
    return placed.where(holds).select("feature", "part", "low", "high", "below", "through").collect()


def order_statistics(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float], buckets: int = BUCKETS
) -> dict[str, tuple[int, dict[int, float]]]:
    """For each column with values their number, and the value of each rank next to a share.

    The neighbouring ranks of share q among n values are floor and ceil of q (n - 1).
    NULLs are no values; NaN counts as the largest one.
    """
    if buckets < 2:
        raise ValueError("a pass needs two buckets at least")
    with recorded([]) as stored:
        numbers = materialize(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), "numbers")
    ends = numbers.agg(
        *[f(c).alias(f"{how}_{c}") for c in columns for how, f in (("n", F.count), ("low", F.min), ("high", F.max))]
    ).first()
    found: dict[str, tuple[int, dict[int, float]]] = {}
    wanted: dict[str, dict[Interval, list[int]]] = {}
    for c in columns:
        n, low, high = (ends[f"{how}_{c}"] for how in ("n", "low", "high"))
        if not n:
            continue
        ranks = sorted({f(s * (n - 1)) for s in shares for f in (math.floor, math.ceil)})
        known = {r: low if r == 0 else high for r in ranks if r in (0, n - 1) or _same(low, high)}
        found[c] = n, known
        if len(known) < len(ranks):
            wanted[c] = {Interval(low, high, 0): [r for r in ranks if r not in known]}
    while wanted:
        left: dict[str, dict[Interval, list[int]]] = {}
        for row in _counted(numbers, wanted, buckets):
            inside = [r for r in list(wanted[row["feature"]].values())[row["part"]] if row["below"] <= r < row["through"]]
            if _same(row["low"], row["high"]):
                found[row["feature"]][1].update(dict.fromkeys(inside, row["low"]))
            else:
                left.setdefault(row["feature"], {})[Interval(row["low"], row["high"], row["below"])] = inside
        wanted = left
    release(df.sparkSession, stored)
    return found
