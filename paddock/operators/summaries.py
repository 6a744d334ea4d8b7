"""Rankings, lookups and the tables behind the dashboard pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paddock.functions.scalars import panel_label
from paddock.operators.metrics import hit
from paddock.operators.preprocess import quantiles
from paddock.scratch import materialize


def top_per_race(
    df: DataFrame, score: str, k: int = 10, tie: str = "driver_id", race: str = "race_id"
) -> DataFrame:
    """The ``k`` rows of each race with the highest score.

    The rank filter is applied before the shuffle as well, so a race with very many
    rows sends at most ``k`` rows per task.
    """
    order = Window.partitionBy(race).orderBy(F.col(score).desc_nulls_last(), F.col(tie))
    ranked = df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.withColumn("rank", F.col("rank").cast("long"))


def top_overall(df: DataFrame, score: str, k: int = 10, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.col(score).desc_nulls_last(), *ties).limit(k)


def grid_order(df: DataFrame, tie: str = "driver_id") -> DataFrame:
    """Display order: by grid position, unknown last."""
    return df.orderBy(F.col("grid_position").asc_nulls_last(), tie)


def distinct_years(df: DataFrame, descending: bool = True) -> DataFrame:
    year = F.col("year")
    return df.select("year").distinct().orderBy(year.desc() if descending else year)


def first_per_round(df: DataFrame, order: str = "result_id") -> DataFrame:
    """Per year and round, race and circuit of the first row that has them."""
    return df.groupBy("year", "round").agg(
        F.min_by("race_id", F.when(F.col("race_id").isNotNull(), F.col(order))).alias("race_id"),
        F.min_by("circuit_id", F.when(F.col("circuit_id").isNotNull(), F.col(order))).alias(
            "circuit_id"
        ),
    )


def race_labels(races: DataFrame, names: DataFrame, circuits: DataFrame) -> DataFrame:
    """Circuit and race names with a text made of the number where a name is unknown."""
    return (
        races.join(names.select("race_id", "race_name"), "race_id", "left")
        .join(circuits.select("circuit_id", "circuit_name"), "circuit_id", "left")
        .withColumn(
            "circuit_label",
            F.coalesce("circuit_name", F.concat(F.lit("Circuit "), F.col("circuit_id"))),
        )
        .withColumn(
            "race_label", F.coalesce("race_name", F.concat(F.lit("Round "), F.col("round")))
        )
        .withColumn(
            "label", F.concat("circuit_label", F.lit(" ("), F.col("race_label"), F.lit(")"))
        )
        .drop("race_name", "circuit_name")
    )


def race_selector(df: DataFrame, names: DataFrame, circuits: DataFrame, year: int) -> DataFrame:
    """The rounds of one year with their labels."""
    rounds = first_per_round(df.where(F.col("year") == year))
    return race_labels(rounds, names, circuits)


def with_panel_labels(df: DataFrame) -> DataFrame:
    """Final label per row, with both predictions recomputed from it."""
    label = panel_label(F.col("top10_probability"), F.col("dnf_probability"))
    return df.withColumn("final_prediction", label).withColumns(
        {
            "top10_prediction": F.col("final_prediction") == "Top-10",
            "dnf_prediction": F.col("final_prediction") == "DNF",
        }
    )


def _race_measures() -> list:
    return [
        F.count(F.lit(1)).alias("drivers"),
        F.count_if("top10_prediction").alias("predicted_top10"),
        F.count_if("dnf_prediction").alias("predicted_dnf"),
        F.avg("dnf_probability").alias("avg_dnf_probability"),
        F.avg(hit("top10_prediction", "target_top_10")).alias("top10_accuracy"),
        F.avg(hit("dnf_prediction", "target_dnf")).alias("dnf_accuracy"),
    ]


def race_summary(predictions: DataFrame) -> DataFrame:
    """Drivers, predicted outcomes, mean probabilities and accuracies per race."""
    return predictions.groupBy("race_id", "year", "round").agg(
        *_race_measures(), F.avg("top10_probability").alias("avg_top10_probability")
    )


def race_panel(predictions: DataFrame) -> DataFrame:
    """The four panel numbers and accuracies per race, on the relabeled rows."""
    return with_panel_labels(predictions).groupBy("race_id").agg(*_race_measures())


def race_prediction_table(predictions: DataFrame, drivers: DataFrame) -> DataFrame:
    """Display table of scored rows with driver names, in grid order."""
    named = with_panel_labels(predictions).join(
        drivers.select("driver_id", "full_name"), "driver_id", "left"
    )
    driver = F.coalesce("full_name", F.col("driver_id").cast("string"))
    return grid_order(named).select(
        driver.alias("Driver"),
        F.col("grid_position").alias("Grid Pos"),
        F.col("qualifying_position").alias("Quali Pos"),
        F.col("top10_probability").alias("Top-10 Prob"),
        F.col("dnf_probability").alias("DNF Prob"),
        F.col("final_prediction").alias("Prediction"),
    )


def yearly_trend(df: DataFrame) -> DataFrame:
    return df.groupBy("year").agg(
        F.avg(F.col("target_top_10").cast("double")).alias("top10_rate"),
        F.avg(F.col("target_dnf").cast("double")).alias("dnf_rate"),
        F.count("race_id").alias("samples"),
    )


def dataset_overview(df: DataFrame, drivers: DataFrame) -> DataFrame:
    """One row: races, results, year range, drivers of the dimension."""
    # races first: no task ever holds the distinct races
    results = (
        df.groupBy("race_id")
        .agg(F.count(F.lit(1)).alias("n"), F.min("year").alias("lo"), F.max("year").alias("hi"))
        .agg(
            F.count("race_id").alias("races"),
            F.sum("n").alias("results"),
            F.concat_ws("-", F.min("lo"), F.max("hi")).alias("years"),
        )
    )
    total = drivers.agg(F.count(F.lit(1)).alias("drivers"))
    # two rows, each with its own columns, become one
    both = results.unionByName(total, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def dim_extracts(drivers: DataFrame, circuits: DataFrame, races: DataFrame) -> DataFrame:
    """The columns the pages read of each dimension, as (dimension, id, name, detail)."""

    def part(df: DataFrame, dimension: str, key: str, name: str, *details: str) -> DataFrame:
        detail = F.concat_ws("|", *[F.coalesce(F.col(d).cast("string"), F.lit("")) for d in details])
        return df.select(
            F.lit(dimension).alias("dimension"),
            F.col(key).cast("long").alias("id"),
            F.col(name).alias("name"),
            detail.alias("detail"),
        )

    return (
        part(drivers, "driver", "driver_id", "full_name", "nationality")
        .unionByName(part(circuits, "circuit", "circuit_id", "circuit_name", "location", "country"))
        .unionByName(part(races, "race", "race_id", "race_name", "year", "round", "circuit_id"))
    )


def feature_histogram(df: DataFrame, feature: str, bins: int = 30) -> DataFrame:
    """Rows per equal-width bin between the smallest and largest value."""
    return feature_histograms(df, [feature], bins).drop("feature")


def feature_histograms(df: DataFrame, features: Sequence[str], bins: int = 30) -> DataFrame:
    """(feature, bin, bin_start, n_rows) of every feature, in one pass for the ends and one for the bins.

    Bins are of equal width between the smallest and largest value of a feature; a constant
    has one bin, a feature without values none.
    """
    values = {f: F.col(f).cast("double") for f in features}
    ends = df.agg(*[how(v).alias(f"{n}_{f}") for f, v in values.items() for n, how in (("low", F.min), ("high", F.max))]).first()
    entries = []
    for f, value in values.items():
        low, high = ends[f"low_{f}"], ends[f"high_{f}"]
        if low is None:
            continue
        width = (high - low) / bins if high > low else 1.0
        place = F.least(F.floor((value - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
        number = F.when(value.isNotNull(), place)  # least passes over missing values
        start = F.lit(low) + number * F.lit(width)
        entries.append(F.struct(F.lit(f).alias("feature"), number.alias("bin"), start.alias("bin_start")))
    if not entries:
        return df.sparkSession.createDataFrame([], "feature string, bin int, bin_start double, n_rows long")
    each = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*").where(F.col("bin").isNotNull())
    return each.groupBy("feature", "bin", "bin_start").agg(F.count(F.lit(1)).alias("n_rows"))


def numbered(df: DataFrame, order: Sequence) -> DataFrame:
    """The rows with their ``position`` from 1 in an order, which no task computes alone.

    Rows are sorted once and stored with their place in their part.  The parts are counted,
    and the counts before a part are added to the places in it.  The rows are not sorted
    again: ``position`` is their order.
    """
    # the upper 31 bits are the part, the lower 33 the place in it
    ordered = df.sort(*order).withColumn("_place", F.monotonically_increasing_id())
    ordered = ordered.withColumn("_part", F.shiftright("_place", 33).cast("int"))
    laid = materialize(ordered.withColumn("_place", F.col("_place").bitwiseAND(2**33 - 1)), "sorted")
    # one row for each part of the sorted table
    before = F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = laid.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    placed = laid.join(F.broadcast(sizes), "_part")
    return placed.withColumn("position", F.col("_before") + F.col("_place") + 1).drop("_part", "_place", "_before")


def box_statistics(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Smallest value, quartiles and largest value per feature."""
    shares = {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0}
    return quantiles(df, features, shares)
