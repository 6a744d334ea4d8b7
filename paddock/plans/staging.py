"""Raw tables under consistent snake_case names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.functions.scalars import joined_name

# Delivered column name -> staged column name, per raw table.
NAMES = {
    "races": {
        "raceId": "race_id", "year": "year", "round": "round", "circuitId": "circuit_id",
        "name": "race_name", "date": "race_date", "time": "race_time",
    },
    "results": {
        "resultId": "result_id", "raceId": "race_id", "driverId": "driver_id",
        "constructorId": "constructor_id", "statusId": "status_id", "number": "driver_number",
        "grid": "grid_position", "position": "finish_position",
        "positionText": "finish_position_text", "positionOrder": "finish_position_order",
        "points": "points", "laps": "laps", "time": "finish_time",
        "milliseconds": "finish_time_ms", "fastestLap": "fastest_lap",
        "rank": "fastest_lap_rank", "fastestLapTime": "fastest_lap_time",
        "fastestLapSpeed": "fastest_lap_speed",
    },
    "qualifying": {
        "qualifyId": "qualify_id", "raceId": "race_id", "driverId": "driver_id",
        "constructorId": "constructor_id", "number": "driver_number",
        "position": "qualifying_position", "q1": "q1", "q2": "q2", "q3": "q3",
    },
    "drivers": {
        "driverId": "driver_id", "driverRef": "driver_ref", "number": "driver_number",
        "code": "driver_code", "forename": "forename", "surname": "surname",
        "dob": "date_of_birth", "nationality": "nationality",
    },
    "constructors": {
        "constructorId": "constructor_id", "constructorRef": "constructor_ref",
        "name": "constructor_name", "nationality": "nationality",
    },
    "circuits": {
        "circuitId": "circuit_id", "circuitRef": "circuit_ref", "name": "circuit_name",
        "location": "location", "country": "country", "lat": "latitude", "lng": "longitude",
        "alt": "altitude",
    },
    "status": {"statusId": "status_id", "status": "status_description"},
    "seasons": {"year": "year"},
}


def stage(table: str, raw: DataFrame, *extra: str) -> DataFrame:
    """Staged form of one raw table; ``extra`` columns are kept as they are."""
    staged = raw.selectExpr(*[f"`{old}` AS {new}" for old, new in NAMES[table].items()], *extra)
    if table == "drivers":
        staged = staged.withColumn("full_name", joined_name(F.col("forename"), F.col("surname")))
    return staged
