"""Fixed values of the raw lake: types, required columns, text that means missing."""

from __future__ import annotations

# Types to give delivered columns where every value allows it.
TYPES = {
    "races": {"raceId": "int", "year": "int", "round": "int", "circuitId": "int"},
    "results": {
        "resultId": "int", "raceId": "int", "driverId": "int", "constructorId": "int",
        "number": "float", "grid": "int", "position": "float", "positionOrder": "int",
        "points": "float", "laps": "int", "milliseconds": "double", "fastestLap": "float",
        "rank": "float", "statusId": "int",
    },
    "qualifying": {
        "qualifyId": "int", "raceId": "int", "driverId": "int", "constructorId": "int",
        "number": "int", "position": "float",
    },
    "drivers": {"driverId": "int", "number": "float"},
    "constructors": {"constructorId": "int"},
    "circuits": {"circuitId": "int", "lat": "float", "lng": "float", "alt": "float"},
    "status": {"statusId": "int"},
}

REQUIRED = {
    "races": ("raceId", "year", "round", "circuitId", "name", "date"),
    "results": (
        "resultId", "raceId", "driverId", "constructorId", "grid", "position",
        "positionOrder", "points", "laps", "statusId",
    ),
    "qualifying": ("qualifyId", "raceId", "driverId", "constructorId", "position"),
    "drivers": ("driverId", "driverRef", "code", "forename", "surname", "nationality"),
    "constructors": ("constructorId", "constructorRef", "name", "nationality"),
    "circuits": ("circuitId", "circuitRef", "name", "location", "country"),
    "status": ("statusId", "status"),
}

OPTIONAL = (
    "sprint_results", "pit_stops", "lap_times", "constructor_results",
    "constructor_standings", "driver_standings", "seasons",
)

# The lake's own token, then the ones pandas reads as missing by default.
NULL_TOKENS = (
    "\\N", "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
