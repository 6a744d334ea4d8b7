"""The pre-event feature table.

Two forms exist.  ``features`` keeps the published semantics: career and venue
statistics span the whole history, and a constructor's frame may hold the
team-mate's row of the same race.  ``features_strict`` looks only at earlier races.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.functions.scalars import as_number, at_most, equals, guarded_rate, mean, ratio
from paddock.operators.ordered import CHUNK_ROWS, Laid, Past, cut_by_event, prior, with_parts, without_parts
from paddock.plans.marts import (
    FIRST,
    Lake,
    TOP_K,
    circuit_dim,
    constructor_dim,
    driver_dim,
    mark_firsts,
    qualifying_clean,
    qualifying_fact,
    results_enriched,
    results_fact,
)
from paddock.plans.staging import stage
from paddock.scratch import materialize, settled, small

ORDER = ("year", "round", "result_id")
RACE_ORDER = ("year", "round", "race_id")
# an order begins with the event; long histories are cut between two events
EVENT = ("year", "round")

# Identifiers, time and targets, then the 24 features, in table order.
KEYS = (
    "result_id", "race_id", "driver_id", "constructor_id", "circuit_id",
    "year", "round", "race_date",
)
TARGETS = ("target_top_10", "target_dnf")
FEATURES = (
    "grid_position", "qualifying_position",
    "driver_career_races", "driver_career_top10_rate", "driver_career_dnf_rate",
    "driver_career_wins",
    "driver_top10_rate_recent", "driver_dnf_rate_recent", "driver_avg_points_recent",
    "driver_avg_positions_gained_recent", "driver_races_in_window",
    "constructor_career_entries", "constructor_career_top10_rate",
    "constructor_career_dnf_rate",
    "constructor_top10_rate_recent", "constructor_dnf_rate_recent",
    "constructor_avg_points_recent",
    "circuit_avg_dnf_rate", "circuit_times_hosted",
    "driver_top10_rate_at_circuit", "driver_dnf_rate_at_circuit", "driver_races_at_circuit",
    "started_top_5", "started_top_10",
)
COLUMNS = (*KEYS, *TARGETS, *FEATURES)


def feature_columns(df: DataFrame, excluded: Sequence[str] = (*KEYS, *TARGETS)) -> list[str]:
    """All columns that are neither identifiers, time nor targets, in table order."""
    return [c for c in df.columns if c not in set(excluded)]


def _zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def qualifying_positions(lake: Lake) -> DataFrame:
    """Qualifying position per race and driver, for rows whose dimensions exist."""
    rows = stage("qualifying", lake["qualifying"]).select(
        "race_id", "driver_id", "constructor_id", "qualifying_position"
    )
    for table, key in (
        ("races", "race_id"), ("drivers", "driver_id"), ("constructors", "constructor_id"),
    ):
        rows = rows.join(stage(table, lake[table]).select(key), key)
    return rows.drop("constructor_id")


# what the feature plans need of the results fact, with the race's date
SOURCE = (
    "result_id", "race_id", "driver_id", "constructor_id", "circuit_id", "year", "round",
    "race_date", "grid_position", "finish_position_order", "points", "laps",
)


def _source_columns(*extra: str) -> list:
    """Flags are kept as 0/1, so that the windows read them as they are."""
    return [
        *SOURCE,
        as_number(F.col("is_top_10")).alias("is_top_10"),
        as_number(F.col("is_dnf")).alias("is_dnf"),
        (F.col("finish_position_order") - F.col("grid_position")).alias("positions_gained"),
        *extra,
    ]


def stored_rows(rows: DataFrame) -> DataFrame:
    """Result rows stored by event in each file: equal values lie together, also when shuffled."""
    return materialize(rows.sortWithinPartitions(*RACE_ORDER), "result_rows")


def source_rows(
    lake: Lake, top_k: int = TOP_K, unique_qualifying: bool = False, results: DataFrame | None = None
) -> DataFrame:
    """Result rows for the feature plans, straight from the lake.

    The date comes with the enriched rows, which have already met their race.  If the
    caller guarantees one qualifying row per race and driver, the position is joined
    first, on the keys the results already lie by.  Otherwise ``features`` joins it
    last, because extra qualifying rows must not count in any window.  ``results`` may be
    staged results that carry their ``qualifying_position`` already.
    """
    if results is not None:
        enriched = results_enriched(lake, top_k, results, ["qualifying_position"])
        return mark_firsts(enriched.select(*_source_columns("qualifying_position")))
    if not unique_qualifying:
        return mark_firsts(results_enriched(lake, top_k).select(*_source_columns()))
    # a result keeps only races and drivers that exist, and so does its qualifying row
    known = stage("constructors", lake["constructors"]).select("constructor_id")
    qualifying = (
        stage("qualifying", lake["qualifying"])
        .join(known, "constructor_id", "left_semi")
        .select("race_id", "driver_id", "qualifying_position")
    )
    results = stage("results", lake["results"]).join(
        qualifying, ["race_id", "driver_id"], "left"
    )
    enriched = results_enriched(lake, top_k, results, ["qualifying_position"])
    return mark_firsts(enriched.select(*_source_columns("qualifying_position")))


def rows_of_marts(
    results: DataFrame,
    races: DataFrame,
    qualifying: DataFrame,
    unique_qualifying: bool = False,
) -> DataFrame:
    """The same rows from stored facts and the race dimension."""
    rows = results.join(races.select("race_id", "race_date"), "race_id")
    if not unique_qualifying:
        return rows.select(*_source_columns())
    positions = qualifying.select("race_id", "driver_id", "qualifying_position")
    rows = rows.join(positions, ["race_id", "driver_id"], "left")
    return rows.select(*_source_columns("qualifying_position"))


@dataclass(frozen=True)
class Windows:
    """How far the windows look back, in which order, and how long a chunk may get."""

    order: tuple[str, ...] = ORDER
    recent: int = 5
    dnf_recent: int = 10
    chunk_rows: int = CHUNK_ROWS


def _recent(windows: Windows, gained: bool) -> dict[str, Past]:
    recent, long = windows.recent, windows.dnf_recent
    wanted = {
        "_top": Past("sum", "is_top_10", recent),
        "_n": Past("count", None, recent),
        "_dnf": Past("sum", "is_dnf", long),
        "_n_dnf": Past("count", None, long),
        "_points": Past("sum", "points", recent),
        "_n_points": Past("count", "points", recent),
    }
    if gained:
        wanted["_gained"] = Past("sum", "positions_gained", recent)
        wanted["_n_gained"] = Past("count", "positions_gained", recent)
    return wanted


def _form(prefix: str) -> list[Column]:
    return [
        mean(F.col("_top"), F.col("_n")).alias(f"{prefix}_top10_rate_recent"),
        mean(F.col("_dnf"), F.col("_n_dnf")).alias(f"{prefix}_dnf_rate_recent"),
        mean(F.col("_points"), F.col("_n_points")).alias(f"{prefix}_avg_points_recent"),
    ]


# what the windows read of a result, beside keys and order
_MEASURES = ("is_top_10", "is_dnf", "points", "positions_gained")


def laid_out(rows: DataFrame, key: str, windows: Windows = Windows(), *more: str) -> Laid:
    """The narrow columns of stored result rows, long histories of an entity in parts."""
    columns = dict.fromkeys((key, *more, *windows.order, "result_id", *_MEASURES))
    return cut_by_event(rows.select(*columns), [key], windows.order, EVENT, windows.chunk_rows)


def _driver_columns() -> list[Column]:
    return [
        *_form("driver"),
        mean(F.col("_gained"), F.col("_n_gained")).alias("driver_avg_positions_gained_recent"),
        F.col("_n").alias("driver_races_in_window"),
    ]


def driver_form(
    rows: DataFrame, windows: Windows = Windows(), laid: Laid | None = None
) -> DataFrame:
    """Per result: the driver's recent rates, points, places and row count; NULL on an empty frame.

    ``rows`` is a stored table in which ``result_id`` names a row.
    """
    laid = laid or laid_out(rows, "driver_id", windows)
    return prior(laid, _recent(windows, True)).select("result_id", *_driver_columns())


def constructor_form(rows: DataFrame, windows: Windows = Windows()) -> DataFrame:
    """Per result: the constructor's recent rates and points over its previous rows."""
    laid = laid_out(rows, "constructor_id", windows)
    return prior(laid, _recent(windows, False)).select("result_id", *_form("constructor"))


_VISITS = {"_top": Past("sum", "is_top_10"), "_dnf": Past("sum", "is_dnf"), "_n": Past("count")}


def _circuit_columns() -> list[Column]:
    return [
        mean(F.col("_top"), F.col("_n")).alias("driver_top10_rate_at_circuit"),
        mean(F.col("_dnf"), F.col("_n")).alias("driver_dnf_rate_at_circuit"),
        F.col("_n").alias("driver_races_at_circuit"),
    ]


def circuit_form(
    rows: DataFrame, windows: Windows = Windows(), laid: Laid | None = None
) -> DataFrame:
    """Per result: the driver's rates and row count over all earlier rows at the same circuit.

    A driver's rows lie in order, and so do those at one circuit: the layout by driver
    serves both windows.
    """
    laid = laid or laid_out(rows, "driver_id", windows, "circuit_id")
    return prior(laid, _VISITS, ["driver_id", "circuit_id"]).select("result_id", *_circuit_columns())


def with_forms(rows: DataFrame, windows: Windows = Windows()) -> DataFrame:
    """The rows with the columns of ``constructor_form``, ``driver_form`` and ``circuit_form``.

    The rows themselves pass through all windows, so that no result has to meet them again.
    Those by driver come last and together: rows that lie by driver need no other place for
    the driver's windows at a circuit.
    """

    def passed(laid: Laid, onto: DataFrame | None, columns: list[Column], wanted: dict, *keys: str) -> DataFrame:
        out = prior(laid, wanted, keys, onto, keep_part=True)
        return out.select(*[c for c in out.columns if c not in wanted], *columns)

    teams = cut_by_event(rows, ["constructor_id"], windows.order, EVENT, windows.chunk_rows)
    out = passed(teams, None, _form("constructor"), _recent(windows, False), "constructor_id")
    laid = cut_by_event(rows, ["driver_id"], windows.order, EVENT, windows.chunk_rows)
    out = with_parts(laid, out)
    out = passed(laid, out, _driver_columns(), _recent(windows, True), "driver_id")
    out = passed(laid, out, _circuit_columns(), _VISITS, "driver_id", "circuit_id")
    return without_parts(out)


def prerace_base(lake: Lake, top_k: int = TOP_K) -> DataFrame:
    """Results with their qualifying row, if any, and the date of their race.

    The enriched rows have met their race and circuit already, so the date comes with
    them, and a qualifying row needs its constructor only.
    """
    facts = results_enriched(lake, top_k).select(
        "result_id", "race_id", "driver_id", "constructor_id", "circuit_id", "year", "round",
        "grid_position",
        F.col("is_top_10").alias("target_top_10"),
        F.col("is_dnf").alias("target_dnf"),
        "race_date",
    )
    known = stage("constructors", lake["constructors"]).select("constructor_id")
    qualifying = (
        stage("qualifying", lake["qualifying"])
        .join(known, "constructor_id", "left_semi")
        .select("race_id", "driver_id", "qualifying_position", "q1", "q2", "q3")
    )
    joined = facts.join(qualifying, ["race_id", "driver_id"], "left")
    return joined.select(
        "result_id", "race_id", "driver_id", "constructor_id", "circuit_id", "year", "round",
        "qualifying_position", "q1", "q2", "q3", "grid_position", "target_top_10", "target_dnf",
        "race_date",
    )


def _finish(rows: DataFrame) -> DataFrame:
    """Cold-start fallbacks, targets and grid flags; columns in table order."""
    grid = F.col("grid_position")

    def fallback(name: str, career: str | None = None) -> Column:
        steps = [F.col(name)] + ([F.col(career)] if career else []) + [F.lit(0.0)]
        return F.coalesce(*steps).alias(name)

    computed = {
        "target_top_10": F.col("is_top_10").cast("boolean"),
        "target_dnf": F.col("is_dnf").cast("boolean"),
        "started_top_5": at_most(grid, 5),
        "started_top_10": at_most(grid, 10),
    }
    for who in ("driver", "constructor"):
        for what in ("top10_rate", "dnf_rate"):
            name = f"{who}_{what}_recent"
            computed[name] = fallback(name, f"{who}_career_{what}")
        computed[f"{who}_avg_points_recent"] = fallback(f"{who}_avg_points_recent")
    for name in (
        "driver_avg_positions_gained_recent",
        "driver_top10_rate_at_circuit",
        "driver_dnf_rate_at_circuit",
    ):
        computed[name] = fallback(name)
    return rows.select(*[computed[c].alias(c) if c in computed else c for c in COLUMNS])


# what the feature table takes of each dimension
_CAREER = {
    "driver": (
        "driver_id",
        "total_races AS driver_career_races",
        "top_10_rate AS driver_career_top10_rate",
        "dnf_rate AS driver_career_dnf_rate",
        "wins AS driver_career_wins",
    ),
    "constructor": (
        "constructor_id",
        "total_race_entries AS constructor_career_entries",
        "top_10_rate AS constructor_career_top10_rate",
        "dnf_rate AS constructor_career_dnf_rate",
    ),
    "circuit": (
        "circuit_id",
        "avg_dnf_rate AS circuit_avg_dnf_rate",
        "times_hosted AS circuit_times_hosted",
    ),
}


def features(
    lake: Lake,
    windows: Windows = Windows(),
    top_k: int = TOP_K,
    unique_qualifying: bool = False,
    rows: DataFrame | None = None,
    dims: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One row per result with 24 features; published semantics.

    The result rows are stored once and feed the dimensions and all windows.  They pass
    through the windows of the constructor, then of the driver and of the driver at a circuit,
    and meet the drivers where they lie.  ``rows`` and the dimensions (``driver``,
    ``constructor``, ``circuit``) may be stored tables.
    """
    if rows is None:
        rows = stored_rows(source_rows(lake, top_k, unique_qualifying))
    stored = dims is not None
    if not stored:
        dims = {
            "driver": driver_dim(lake, rows),
            "constructor": constructor_dim(lake, rows),
            "circuit": circuit_dim(lake, rows),
        }
    dims = {name: dims[name].selectExpr(*columns) for name, columns in _CAREER.items()}
    if not stored:
        # their few columns, stored: their true size decides between broadcast and shuffle
        # before the long side is planned; an aggregate would be taken to be as large as it
        dims = {name: materialize(dim, name) for name, dim in dims.items()}
    marks = [c for c in rows.columns if c.startswith(FIRST)]
    out = with_forms(rows.drop("laps", "finish_position_order", *marks), windows)
    out = (
        out.drop("points", "positions_gained")
        .join(small(dims["driver"]), "driver_id", "left")
        .join(small(dims["constructor"]), "constructor_id", "left")
        .join(small(dims["circuit"]), "circuit_id", "left")
    )
    if "qualifying_position" not in rows.columns:
        # the shuffles of the windows go before those of the lines begin
        out = materialize(out, "window_rows")
        out = out.join(qualifying_positions(lake), ["race_id", "driver_id"], "left")
    return _finish(out)


def event_history(
    rows: DataFrame,
    keys: Sequence[str],
    windows: Windows = Windows(),
    race_order: Sequence[str] = RACE_ORDER,
) -> DataFrame:
    """Per entity and race: aggregates over earlier *races*, recent and since the start.

    Rows of one race are added up first, so no row of the race itself can count.
    """
    per_race = rows.groupBy(*keys, *race_order).agg(
        F.sum("is_top_10").alias("top"),
        F.sum("is_dnf").alias("dnf"),
        F.count(F.lit(1)).alias("n"),
        F.sum("points").alias("points"),
        F.count("points").alias("n_points"),
        F.sum("positions_gained").alias("gained"),
        F.count("positions_gained").alias("n_gained"),
        F.max(as_number(equals(F.col("finish_position_order"), 1))).alias("won"),
    )
    per_race = materialize(per_race, "race_sums")
    recent, long = windows.recent, windows.dnf_recent
    wanted = {
        f"_{c}": Past("sum", c, recent)
        for c in ("top", "n", "points", "n_points", "gained", "n_gained")
    }
    wanted |= {"_dnf": Past("sum", "dnf", long), "_n_dnf": Past("sum", "n", long)}
    wanted["_races"] = Past("count", None, recent)
    wanted |= {f"ever_{c}": Past("sum", c) for c in ("top", "dnf", "n", "won")}
    wanted["ever_races"] = Past("count")
    # the first key orders the rows of all
    laid = cut_by_event(per_race, keys[:1], race_order, EVENT, windows.chunk_rows)
    out = prior(laid, wanted, keys)
    return out.select(*dict.fromkeys((*keys, *race_order)), *wanted)


def _career(prefix: str, races: str) -> list[Column]:
    count = F.col("ever_races")
    return [
        count.alias(races),
        guarded_rate(_zero(F.col("ever_top")), count).alias(f"{prefix}career_top10_rate"),
        guarded_rate(_zero(F.col("ever_dnf")), count).alias(f"{prefix}career_dnf_rate"),
        _zero(F.col("ever_won")).alias(f"{prefix}career_wins"),
    ]


def career_asof(
    rows: DataFrame,
    entity: str,
    windows: Windows = Windows(),
    race_order: Sequence[str] = RACE_ORDER,
) -> DataFrame:
    """Career statistics of an entity before each of its races."""
    past = event_history(rows, [entity], windows, race_order)
    return past.select(entity, "race_id", *_career("", "career_races"))


def constructor_form_strict(
    rows: DataFrame, windows: Windows = Windows(), race_order: Sequence[str] = RACE_ORDER
) -> DataFrame:
    """Constructor form over the previous races instead of the previous rows."""
    past = event_history(rows, ["constructor_id"], windows, race_order)
    form = past.select("constructor_id", "race_id", *_form("constructor"))
    return rows.join(form, ["constructor_id", "race_id"], "left")


def features_strict(
    lake: Lake,
    windows: Windows = Windows(),
    top_k: int = TOP_K,
    unique_qualifying: bool = False,
    race_order: Sequence[str] = RACE_ORDER,
    rows: DataFrame | None = None,
) -> DataFrame:
    """The same columns, each computed from earlier races only."""
    if rows is None:
        rows = stored_rows(source_rows(lake, top_k, unique_qualifying))

    histories = {
        ("constructor_id",): [
            *_career("constructor_", "constructor_career_entries"),
            *_form("constructor"),
        ],
        ("circuit_id",): [
            ratio(F.col("ever_dnf"), F.col("ever_n")).alias("circuit_avg_dnf_rate"),
            F.col("ever_races").alias("circuit_times_hosted"),
        ],
        ("driver_id",): [
            *_career("driver_", "driver_career_races"),
            *_form("driver"),
            mean(F.col("_gained"), F.col("_n_gained")).alias("driver_avg_positions_gained_recent"),
            F.col("_races").alias("driver_races_in_window"),
        ],
        ("driver_id", "circuit_id"): [
            mean(F.col("ever_top"), F.col("ever_n")).alias("driver_top10_rate_at_circuit"),
            mean(F.col("ever_dnf"), F.col("ever_n")).alias("driver_dnf_rate_at_circuit"),
            F.col("ever_races").alias("driver_races_at_circuit"),
        ],
    }

    def met(out: DataFrame, keys: tuple[str, ...]) -> DataFrame:
        """The rows with one more history, whose shuffles go before the next one begins."""
        past = event_history(rows, keys, windows, race_order)
        return out.join(past.select(*keys, "race_id", *histories[keys]), [*keys, "race_id"], "left")

    out, stored = rows.drop("laps", "points", "finish_position_order", "positions_gained"), []
    *first, last = histories
    for keys in first:
        out, path = settled(partial(met, out, keys), "strict_rows", *stored)
        stored = [path]
    out = met(out, last)
    if "qualifying_position" not in rows.columns:
        out = out.join(qualifying_positions(lake), ["race_id", "driver_id"], "left")
    return _finish(out)
