"""A small consistent lake made of formulas.

The race and driver tables may also be handed in, so that the same rules can fill
the results of any races and drivers.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_YEAR = 2014
TEAMS = 5
CIRCUITS = 3

# Status id and description, and below the formulas of every column.
STATUS = ((1, "Finished"), (2, "+1 Lap"), (3, "Accident"), (4, "Collision"), (5, "Engine"))


def _numbers(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(1, n + 1).withColumnRenamed("id", "i")


def _text(pattern: str, *values) -> Column:
    return F.format_string(pattern, *values)


def races(spark: SparkSession, seasons: int = 7, rounds: int = 5) -> DataFrame:
    """Seasons x rounds, numbered from 1 in order of time."""
    n = F.col("i") - 1
    year = (F.lit(FIRST_YEAR) + F.floor(n / rounds)).cast("long")
    number = n % rounds + 1
    return _numbers(spark, seasons * rounds).select(
        F.col("i").alias("raceId"),
        year.alias("year"),
        number.alias("round"),
        (number % CIRCUITS + 1).alias("circuitId"),
        _text("Grand Prix %d", number).alias("name"),
        _text("%d-%02d-15", year, number).alias("date"),
        F.lit("14:00:00").alias("time"),
    )


def drivers(spark: SparkSession, n: int = 10) -> DataFrame:
    i = F.col("i")
    return _numbers(spark, n).select(
        i.alias("driverId"),
        _text("driver_%d", i).alias("driverRef"),
        i.alias("number"),
        _text("DR%02d", i).alias("code"),
        F.lit("Driver").alias("forename"),
        i.cast("string").alias("surname"),
        _text("199%d-01-01", i % 10).alias("dob"),
        F.lit("Country").alias("nationality"),
    )


def constructors(spark: SparkSession, n: int = TEAMS) -> DataFrame:
    i = F.col("i")
    return _numbers(spark, n).select(
        i.alias("constructorId"),
        _text("team_%d", i).alias("constructorRef"),
        _text("Team %d", i).alias("name"),
        F.lit("Country").alias("nationality"),
    )


def circuits(spark: SparkSession, n: int = CIRCUITS) -> DataFrame:
    i = F.col("i")
    return _numbers(spark, n).select(
        i.alias("circuitId"),
        _text("circuit_%d", i).alias("circuitRef"),
        _text("Circuit %d", i).alias("name"),
        _text("City %d", i).alias("location"),
        F.lit("Country").alias("country"),
        (i + 50.0).alias("lat"),
        (i + 4.0).alias("lng"),
        F.lit(100).alias("alt"),
    )


def status(spark: SparkSession) -> DataFrame:
    values = ", ".join(f"({i}, '{text}')" for i, text in STATUS)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(statusId, status)")


def seasons(races: DataFrame) -> DataFrame:
    return races.select("year").distinct().withColumn(
        "url", F.concat(F.lit("season/"), F.col("year"))
    )


def entries(races: DataFrame, drivers: DataFrame) -> DataFrame:
    """Every driver in every race, with a running number over (race, driver)."""
    n = drivers.count()
    return (
        races.select("raceId", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("place"))
        .withColumn("place", F.col("place").cast("long"))
        .withColumn("entryId", (F.col("raceId") - 1) * n + F.col("place"))
    )


def _team(driver: Column) -> Column:
    return F.floor((driver - 1) / 2).cast("long") + 1


def _who(entries: DataFrame) -> dict[str, Column]:
    """Driver and team of an entry: its own, or those that the place names."""
    place = F.col("place")
    named = {"driverId": place, "constructorId": _team(place)}
    return {c: F.col(c) if c in entries.columns else value for c, value in named.items()}


def qualifying(entries: DataFrame) -> DataFrame:
    """Qualifying rows of entries (entryId, raceId, place and perhaps driverId, constructorId)."""
    place, who = F.col("place"), _who(entries)

    def session(offset: int) -> Column:
        return _text("1:%d.%03d", place + offset, place)

    return entries.select(
        F.col("entryId").alias("qualifyId"),
        "raceId",
        who["driverId"].alias("driverId"),
        who["constructorId"].alias("constructorId"),
        place.alias("number"),
        place.alias("position"),
        session(20).alias("q1"),
        F.when(place <= 15, session(19)).alias("q2"),
        F.when(place <= 10, session(18)).alias("q3"),
    )


def results(entries: DataFrame) -> DataFrame:
    """Result rows of entries; places beyond the eighth retire in every third race."""
    place, who = F.col("place"), _who(entries)
    retired = (place > 8) & ((place + F.col("raceId")) % 3 == 0)

    def if_finished(value) -> Column:
        return F.when(~retired, value)

    return entries.select(
        F.col("entryId").alias("resultId"),
        "raceId",
        who["driverId"].alias("driverId"),
        who["constructorId"].alias("constructorId"),
        place.alias("number"),
        place.alias("grid"),
        if_finished(place).alias("position"),
        F.coalesce(if_finished(place.cast("string")), F.lit("R")).alias("positionText"),
        place.alias("positionOrder"),
        F.when(~retired & (place <= 10), F.greatest(26 - 2 * place, F.lit(0)))
        .otherwise(0)
        .alias("points"),
        F.when(retired, 5 * place).otherwise(50).alias("laps"),
        if_finished(_text("1:%d:%02d.%03d", place + 30, place, place)).alias("time"),
        if_finished((place + 90) * 60000).alias("milliseconds"),
        if_finished(place).alias("fastestLap"),
        if_finished(place).alias("rank"),
        if_finished(_text("1:%d.%03d", place + 25, place)).alias("fastestLapTime"),
        if_finished(200 - place).alias("fastestLapSpeed"),
        F.when(retired, 3).otherwise(1).alias("statusId"),
    )


def lake(
    spark: SparkSession, n_seasons: int = 7, n_rounds: int = 5, n_drivers: int = 10
) -> dict[str, DataFrame]:
    """All eight tables."""
    race_rows, driver_rows = races(spark, n_seasons, n_rounds), drivers(spark, n_drivers)
    pairs = entries(race_rows, driver_rows)
    return {
        "races": race_rows,
        "drivers": driver_rows,
        "constructors": constructors(spark),
        "circuits": circuits(spark),
        "status": status(spark),
        "qualifying": qualifying(pairs),
        "results": results(pairs),
        "seasons": seasons(race_rows),
    }


STARTERS = 10  # about as many drivers start in a race of ``given``


def given(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All eight tables, results and qualifying filled by the rules for given races and drivers.

    With n drivers those of each n/10-th number start in a race, by the remainders of both
    numbers; a driver drives for the team of its nation.  All keys hold.
    """
    drivers, races = tables["drivers"], tables["races"]
    step = max(1, drivers.count() // STARTERS)
    team = F.regexp_extract("nationality", "([0-9]+)$", 1).cast("long")
    starters = drivers.select(
        "driverId",
        team.alias("constructorId"),
        (F.col("driverId") % step).alias("_slot"),
        (F.floor(F.col("driverId") / step) + 1).alias("place"),
    )
    pairs = races.select("raceId", (F.col("raceId") % step).alias("_slot")).join(starters, "_slot")
    pairs = pairs.withColumn("entryId", F.col("raceId") * 100 + F.col("place")).drop("_slot")
    return {
        **{name: tables[name] for name in ("races", "drivers", "constructors", "circuits", "seasons")},
        "status": status(races.sparkSession),
        "qualifying": qualifying(pairs),
        "results": results(pairs),
    }
