"""The feature table on the toy lake, with known values, and its variants."""

import pytest
from pyspark.sql import functions as F

from paddock.operators import quality
from paddock.plans import features as ft
from paddock.plans import marts
from paddock.scratch import materialize
from paddock.sources import toy

# Known values of four results (rates with three digits).
KNOWN = {
    251: dict(
        driver_career_races=35, driver_career_wins=35, driver_career_dnf_rate=0.0,
        driver_avg_points_recent=24.0, driver_dnf_rate_recent=0.0,
        constructor_career_entries=35, constructor_career_top10_rate=2.0,
        constructor_career_dnf_rate=0.0, constructor_dnf_rate_recent=0.0,
        constructor_avg_points_recent=22.8, circuit_avg_dnf_rate=0.057,
        circuit_times_hosted=14, driver_dnf_rate_at_circuit=0.0, driver_races_at_circuit=10,
    ),
    252: dict(constructor_avg_points_recent=23.2),
    259: dict(
        driver_career_races=35, driver_career_wins=0, driver_career_dnf_rate=0.314,
        driver_avg_points_recent=4.8, driver_dnf_rate_recent=0.3,
        constructor_career_dnf_rate=0.657, constructor_dnf_rate_recent=0.3,
        constructor_avg_points_recent=4.0, driver_dnf_rate_at_circuit=0.4,
        driver_races_at_circuit=10,
    ),
    260: dict(
        driver_career_dnf_rate=0.343, driver_avg_points_recent=4.8, driver_dnf_rate_recent=0.3,
        constructor_dnf_rate_recent=0.2, constructor_avg_points_recent=5.6,
        driver_dnf_rate_at_circuit=0.2, driver_races_at_circuit=10,
    ),
}


@pytest.fixture(scope="module")
def lake(spark):
    return {name: materialize(df, f"toy_{name}") for name, df in toy.lake(spark).items()}


@pytest.fixture(scope="module")
def table(lake):
    return materialize(ft.features(lake), "toy_features")


@pytest.mark.parametrize("result_id", KNOWN)
def test_known_values(table, result_id):
    row = table.where(F.col("result_id") == result_id).first().asDict()
    got = {c: round(float(row[c]), 9) for c in KNOWN[result_id]}
    assert got == KNOWN[result_id]


def test_shape(table):
    assert tuple(table.columns) == ft.COLUMNS
    assert table.count() == 350
    assert ft.feature_columns(table) == list(ft.FEATURES) and len(ft.FEATURES) == 24
    failures = quality.feature_contract(table, ft.feature_columns(table), "result_id")
    assert all(r["failures"] == 0 for r in failures.collect())


@pytest.mark.parametrize("options", [
    dict(windows=ft.Windows(chunk_rows=5)), dict(unique_qualifying=True),
])
def test_same_rows_by_another_plan(lake, table, options):
    other = ft.features(lake, **options)
    assert table.exceptAll(other).isEmpty() and other.exceptAll(table).isEmpty()


def test_duplicate_qualifying_rows_do_not_enter_the_windows(lake, table):
    twice = dict(lake)
    twice["qualifying"] = lake["qualifying"].union(lake["qualifying"].where("raceId = 3"))
    out = ft.features(twice)
    assert out.count() == 350 + 10
    assert out.distinct().exceptAll(table).isEmpty()


def test_first_race_falls_back_to_career_then_zero(table):
    row = table.where("race_id = 1 AND driver_id = 9").first()
    assert row["driver_races_in_window"] == 0 and row["driver_avg_points_recent"] == 0.0
    assert row["driver_top10_rate_recent"] == row["driver_career_top10_rate"]
    assert row["driver_dnf_rate_at_circuit"] == 0.0


def test_rates_lie_between_0_and_1_except_the_constructors(table):
    # cars over races: up to 2.0, also where recent form falls back to it
    rates = [c for c in ft.FEATURES if "rate" in c and not c.startswith("constructor_")]
    outside = [F.count_if(~F.col(c).between(0, 1)).alias(c) for c in rates]
    assert set(table.agg(*outside).first()) == {0}


@pytest.mark.parametrize("last_race", [12, 20])
def test_only_the_strict_table_ignores_later_races(lake, last_race):
    rows = materialize(ft.source_rows(lake, unique_qualifying=True), "rows")
    early = materialize(rows.where(F.col("race_id") <= last_race), "early")
    changed = {}
    for build in (ft.features, ft.features_strict):
        before, after = (build(lake, unique_qualifying=True, rows=r) for r in (early, rows))
        report = quality.changed_values(before, after, "result_id", ft.FEATURES)
        changed[build.__name__] = {r["feature"] for r in report.where("changed > 0").collect()}
    assert changed["features_strict"] == set()
    assert "driver_career_races" in changed["features"]


def test_strict_form_does_not_see_the_own_race(lake):
    rows = materialize(ft.source_rows(lake), "rows")
    form = ft.constructor_form_strict(rows).where("race_id = 26 AND constructor_id = 1")
    values = {r["constructor_avg_points_recent"] for r in form.collect()}
    assert values == {23.0}


def test_entities_without_facts_keep_their_row(spark, lake):
    more = dict(lake)
    idle = toy.drivers(spark, 11)
    more["drivers"] = idle
    enriched = marts.results_enriched(more)
    row = marts.driver_dim(more, enriched).where("driver_id = 11").first()
    assert row["total_races"] == 0 and row["wins"] == 0 and row["first_season"] is None
    assert row["top_10_rate"] == 0.0 and row["full_name"] == "Driver 11"
    circuits = dict(lake)
    circuits["circuits"] = toy.circuits(spark, 4)
    row = marts.circuit_dim(circuits, enriched).where("circuit_id = 4").first()
    assert row["times_hosted"] == 0 and row["avg_dnf_rate"] is None


def test_unmatched_results_vanish(lake):
    fewer = dict(lake)
    fewer["circuits"] = lake["circuits"].where("circuitId <> 2")
    enriched = marts.results_enriched(fewer)
    assert enriched.where("circuit_id = 2").isEmpty() and not enriched.isEmpty()


def test_toy_lake_keys(spark, lake):
    assert lake["results"].count() == 350 and lake["races"].count() == 35
    for child, key, parent in (
        ("results", "raceId", "races"), ("results", "driverId", "drivers"),
        ("results", "statusId", "status"), ("qualifying", "raceId", "races"),
        ("races", "circuitId", "circuits"), ("results", "constructorId", "constructors"),
    ):
        assert quality.orphans(lake[child], key, lake[parent], key).isEmpty()
    assert lake["results"].where("points < 0").isEmpty()
    assert toy.lake(spark, 2, 3, 4)["results"].count() == 24


def test_marked_rows_give_the_same_careers(lake):
    """With a driver that has several rows in a race, and wins with the later one."""
    plain = marts.results_enriched(lake).select(*ft._source_columns())
    again = plain.where("driver_id % 3 = 1").selectExpr(
        "* EXCEPT (result_id, finish_position_order)",
        "result_id + 10000 AS result_id",
        "CASE WHEN race_id % 4 = 0 THEN 1 WHEN race_id % 4 = 1 THEN NULL ELSE 3 END AS finish_position_order",
    )
    rows = materialize(plain.unionByName(again), "plain_rows")
    marked = materialize(marts.mark_firsts(rows), "marked_rows")
    for entity in ("driver_id", "constructor_id"):
        want, got = (marts.career_statistics(r, entity) for r in (rows, marked))
        assert got.exceptAll(want.select(*got.columns)).isEmpty() and got.count() == want.count() > 1
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "race_id" not in plan.split("Relation")[0]


def test_lines_of_an_order_are_shuffled_once(spark):
    from paddock.plans.staging import stage
    from paddock.sources import binding

    folder = "/root/testdata/sf0.001"
    lake = binding.lake(spark, folder)
    want = ft.source_rows(lake, binding.TOP_K, unique_qualifying=True)
    results = stage("results", binding.results(spark, folder, qualified=True), "qualifying_position")
    got = ft.source_rows(lake, binding.TOP_K, True, results)
    columns = [c for c in want.columns if not c.startswith(marts.FIRST)]
    assert got.select(*columns).exceptAll(want.select(*columns)).isEmpty() and got.count() == want.count() > 0
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = binding.results(spark, folder)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("hashpartitioning(l_orderkey") == 1 and "hashpartitioning(l_orderkey#" in plan
    assert not any("hashpartitioning(" in line and "l_suppkey" in line and "l_orderkey" in line for line in plan.splitlines())
