"""Enriched rows, facts and dimensions.

A lake is a mapping from raw table name to DataFrame.  Joins carry no hints:
Spark broadcasts a side only if its size, known or measured at run time, is under
``spark.sql.autoBroadcastJoinThreshold``, and splits skewed sort-merge joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paddock.functions.scalars import (
    as_number,
    at_most,
    did_not_finish,
    equals,
    guarded_rate,
    last_session_time,
    positions_gained,
    ratio,
)
from paddock.plans.staging import stage
from paddock.scratch import small

Lake = Mapping[str, DataFrame]

TOP_K = 10
# of the column that marks the best row of an entity in a race
FIRST = "first_of_"


def results_enriched(
    lake: Lake,
    top_k: int = TOP_K,
    results: DataFrame | None = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Results with race, circuit, driver, constructor and status; unmatched rows vanish.

    Circuits are joined to the races, which are far fewer than the results, so the
    results are never shuffled by circuit.  ``results`` may be staged rows that carry
    ``extra`` columns.
    """
    circuits = stage("circuits", lake["circuits"]).selectExpr(
        "circuit_id", "circuit_name", "country AS circuit_country"
    )
    races = (
        stage("races", lake["races"])
        .select("race_id", "year", "round", "race_name", "race_date", "circuit_id")
        .join(circuits, "circuit_id")
    )
    drivers = stage("drivers", lake["drivers"]).selectExpr(
        "driver_id",
        "driver_code",
        "full_name AS driver_name",
        "nationality AS driver_nationality",
    )
    constructors = stage("constructors", lake["constructors"]).selectExpr(
        "constructor_id", "constructor_name", "nationality AS constructor_nationality"
    )
    if results is None:
        results = stage("results", lake["results"])
    return (
        results.drop("driver_number", "finish_position_text")
        .join(small(drivers), "driver_id")
        .join(constructors, "constructor_id")
        .join(stage("status", lake["status"]), "status_id")
        .join(races, "race_id")
        .withColumn("is_top_10", at_most(F.col("finish_position_order"), top_k))
        .withColumn("is_dnf", did_not_finish(F.col("status_description")))
        .select(
            "result_id", "race_id", "driver_id", "constructor_id",
            "year", "round", "race_name", "race_date",
            "circuit_id", "circuit_name", "circuit_country",
            "driver_code", "driver_name", "driver_nationality",
            "constructor_name", "constructor_nationality",
            "grid_position", "finish_position", "finish_position_order",
            "points", "laps", "finish_time", "finish_time_ms",
            "fastest_lap", "fastest_lap_rank", "fastest_lap_time", "fastest_lap_speed",
            "status_id", "status_description", "is_top_10", "is_dnf", *extra,
        )
    )


def qualifying_clean(lake: Lake) -> DataFrame:
    """Qualifying rows with race, driver and constructor, session flags and last time."""
    races = stage("races", lake["races"]).select(
        "race_id", "year", "round", "race_name", "circuit_id"
    )
    drivers = stage("drivers", lake["drivers"]).select(
        "driver_id", "driver_code", F.col("full_name").alias("driver_name")
    )
    constructors = stage("constructors", lake["constructors"]).select(
        "constructor_id", "constructor_name"
    )
    flags = {f"completed_{q}": F.col(q).isNotNull() for q in ("q1", "q2", "q3")}
    return (
        stage("qualifying", lake["qualifying"])
        .drop("driver_number")
        .join(races, "race_id")
        .join(drivers, "driver_id")
        .join(constructors, "constructor_id")
        .withColumns(flags)
        .withColumn(
            "best_qualifying_time", last_session_time(F.col("q1"), F.col("q2"), F.col("q3"))
        )
        .select(
            "qualify_id", "race_id", "driver_id", "constructor_id",
            "year", "round", "race_name", "circuit_id",
            "driver_code", "driver_name", "constructor_name",
            "qualifying_position", "q1", "q2", "q3", *flags, "best_qualifying_time",
        )
    )


def results_fact(enriched: DataFrame, podium: int = 3) -> DataFrame:
    finish, grid = F.col("finish_position_order"), F.col("grid_position")
    return enriched.select(
        "result_id", "race_id", "driver_id", "constructor_id", "circuit_id", "status_id",
        "year", "round",
        "grid_position", "finish_position", "finish_position_order",
        "points", "laps", "finish_time_ms",
        "fastest_lap", "fastest_lap_rank", "fastest_lap_time", "fastest_lap_speed",
        positions_gained(finish, grid).alias("positions_gained"),
        "is_top_10", "is_dnf",
        equals(finish, 1).alias("is_win"),
        at_most(finish, podium).alias("is_podium"),
        equals(grid, 1).alias("started_pole"),
        equals(F.col("fastest_lap_rank"), 1).alias("had_fastest_lap"),
    )


def qualifying_fact(clean: DataFrame, top_k: int = TOP_K) -> DataFrame:
    position = F.col("qualifying_position")
    return clean.select(
        "qualify_id", "race_id", "driver_id", "constructor_id", "circuit_id", "year", "round",
        "qualifying_position", "q1", "q2", "q3", "best_qualifying_time",
        "completed_q1", "completed_q2", "completed_q3",
        equals(position, 1).alias("is_pole_position"),
        at_most(position, 3).alias("is_top_3"),
        at_most(position, top_k).alias("is_top_10"),
    )


def mark_firsts(rows: DataFrame, entities: Sequence[str] = ("driver_id", "constructor_id")) -> DataFrame:
    """Mark with 1 the best row of each entity in a race, a winning one if there is any.

    Marked rows are counted as races, and tell whether a race was won, without another
    meeting of the rows of a race.  Rows that lie by race stay where they are.
    """
    finish = F.col("finish_position_order")
    best = [F.desc(as_number(equals(finish, 1))), finish.asc_nulls_last()]

    def mark(entity: str) -> Column:
        window = Window.partitionBy("race_id", "year", entity).orderBy(*best)
        return as_number(F.row_number().over(window) == 1)

    return rows.withColumns({FIRST + entity: mark(entity) for entity in entities})


def _by_race_then_year(facts: DataFrame, entity: str, sums: dict, flags: dict) -> DataFrame:
    """Statistics per entity with distinct races and years, without a distinct aggregate.

    Grouping first by (entity, race), then (entity, year), then entity counts
    races and years exactly.  Each step combines before its shuffle, so an entity
    with very many rows never meets in one task.  Rows of whole races that ``mark_firsts``
    has marked are grouped by (entity, year) at once; flags must hold for the best row of
    a race if they hold for any.
    """
    mark = FIRST + entity
    if mark in facts.columns:
        per_year = facts.groupBy(entity, "year").agg(
            F.sum(mark).alias("races"),
            *[F.sum(c).alias(n) for n, c in sums.items()],
            *[F.sum(c * F.col(mark)).alias(n) for n, c in flags.items()],
        )
        return _over_years(per_year, entity, [*sums, *flags])
    per_race = facts.groupBy(entity, "race_id", "year").agg(
        *[F.sum(c).alias(n) for n, c in sums.items()],
        *[F.max(c).alias(n) for n, c in flags.items()],
    )
    per_year = per_race.groupBy(entity, "year").agg(
        F.count("race_id").alias("races"),
        *[F.sum(n).alias(n) for n in (*sums, *flags)],
    )
    return _over_years(per_year, entity, [*sums, *flags])


def _over_years(per_year: DataFrame, entity: str, totals: Sequence[str]) -> DataFrame:
    return per_year.groupBy(entity).agg(
        F.sum("races").alias("races"),
        F.count("year").alias("years"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        *[F.sum(n).alias(n) for n in totals],
    )


def career_statistics(facts: DataFrame, entity: str, podium: int = 3) -> DataFrame:
    """Whole-history statistics per driver or constructor."""
    finish = F.col("finish_position_order")
    return _by_race_then_year(
        facts,
        entity,
        sums={
            "career_points": F.col("points").cast("double"),
            "top_10_finishes": as_number(F.col("is_top_10")),
            "dnf_count": as_number(F.col("is_dnf")),
        },
        flags={
            "wins": as_number(equals(finish, 1)),
            "podiums": as_number(at_most(finish, podium)),
        },
    )


def _zero(name: str, kind: str = "long") -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast(kind)


def _entity_dim(entities: DataFrame, facts: DataFrame, entity: str, races_as: str) -> DataFrame:
    races = _zero("races")
    joined = entities.join(career_statistics(facts, entity), entity, "left")
    return joined.select(
        *entities.columns,
        races.alias(races_as),
        _zero("years").alias("seasons_active"),
        F.col("first_year").alias("first_season"),
        F.col("last_year").alias("last_season"),
        _zero("career_points", "double").alias("career_points"),
        *[_zero(n).alias(n) for n in ("top_10_finishes", "dnf_count", "wins", "podiums")],
        guarded_rate(_zero("top_10_finishes"), races).alias("top_10_rate"),
        guarded_rate(_zero("dnf_count"), races).alias("dnf_rate"),
    )


def driver_dim(lake: Lake, facts: DataFrame) -> DataFrame:
    drivers = stage("drivers", lake["drivers"]).select(
        "driver_id", "driver_ref", "driver_code", "driver_number",
        "forename", "surname", "full_name", "date_of_birth", "nationality",
    )
    return _entity_dim(drivers, facts, "driver_id", "total_races")


def constructor_dim(lake: Lake, facts: DataFrame) -> DataFrame:
    """As the drivers; the numerators count cars, so a rate may exceed 1."""
    constructors = stage("constructors", lake["constructors"])
    return _entity_dim(constructors, facts, "constructor_id", "total_race_entries")


def circuit_statistics(facts: DataFrame) -> DataFrame:
    one = F.lit(1)
    return _by_race_then_year(
        facts,
        "circuit_id",
        sums={
            "entries": one,
            "lap_sum": F.col("laps").cast("long"),
            "lap_count": as_number(F.col("laps").isNotNull()),
            "dnf_count": as_number(F.col("is_dnf")),
        },
        flags={},
    )


def circuit_dim(lake: Lake, facts: DataFrame) -> DataFrame:
    circuits = stage("circuits", lake["circuits"])
    return circuits.join(circuit_statistics(facts), "circuit_id", "left").select(
        *circuits.columns,
        _zero("races").alias("times_hosted"),
        _zero("years").alias("years_active"),
        F.col("first_year").alias("first_race_year"),
        F.col("last_year").alias("last_race_year"),
        ratio(F.col("lap_sum"), F.col("lap_count"), 1).alias("avg_laps_per_race"),
        ratio(F.col("dnf_count"), F.col("entries")).alias("avg_dnf_rate"),
    )


def race_dim(lake: Lake, facts: DataFrame) -> DataFrame:
    circuits = stage("circuits", lake["circuits"]).select(
        "circuit_id",
        "circuit_name",
        F.col("country").alias("circuit_country"),
        F.col("location").alias("circuit_location"),
    )
    statistics = facts.groupBy("race_id").agg(
        F.count(F.lit(1)).alias("entries"),
        F.sum(as_number(F.col("is_dnf"))).alias("dnfs"),
        F.max("laps").alias("total_laps"),
    )
    return (
        stage("races", lake["races"])
        .join(circuits, "circuit_id")
        .join(statistics, "race_id", "left")
        .select(
            "race_id", "year", "round", "race_name", "race_date", "race_time",
            "circuit_id", "circuit_name", "circuit_country", "circuit_location",
            _zero("entries").alias("total_drivers"),
            _zero("dnfs").alias("dnf_count"),
            guarded_rate(_zero("dnfs"), _zero("entries")).alias("dnf_rate"),
            "total_laps",
        )
    )
