"""Plans of several large steps hold the shuffles and tables of one step at a time."""

import pytest

from paddock.plans import declared, warehouse
from paddock.plans import features as ft
from paddock.scratch import materialize, recorded, settled
from paddock.sources import files, toy


@pytest.fixture(scope="module")
def lake(spark):
    return {name: materialize(df, f"toy_{name}") for name, df in toy.lake(spark, 2, 2, 4).items()}


@pytest.fixture(scope="module")
def rows(lake):
    return ft.stored_rows(ft.source_rows(lake, unique_qualifying=True))


def test_what_is_stored_on_the_way_goes(spark):
    with recorded([]) as outer:
        first, path = settled(lambda: materialize(spark.range(5), "passing"), "first")
        second, _ = settled(lambda: first.where("id > 1"), "second", path)
    assert second.count() == 3
    assert [p.rsplit("/", 1)[1].split("-")[0] for p in outer if files.exists(spark, p)] == ["second"]


def test_strict_features_keep_one_step(spark, lake, rows):
    with recorded([]) as paths:
        table = ft.features_strict(lake, unique_qualifying=True, rows=rows)
    left = [p.rsplit("/", 1)[1] for p in paths if files.exists(spark, p)]
    assert sum(p.startswith("strict_rows") for p in left) == 1
    assert sum(p.startswith("race_sums") for p in left) == 1
    assert table.count() == rows.count()


def test_qualifying_rows_come_after_the_windows(spark, lake):
    table = ft.features(lake)
    assert any("/window_rows-" in f for f in table.inputFiles())


def test_the_last_mart_is_written_of_stored_features(spark, lake, rows, tmp_path):
    with recorded([]) as paths:
        tables = warehouse.build(spark, lake, f"{tmp_path}/marts", unique_qualifying=True, rows=rows)
    stored = [p for p in paths if "/features-" in p]
    assert len(stored) == 1 and not files.exists(spark, stored[0])
    assert tables["fct_features_pre_race"].count() == rows.count()


def test_declared_models_are_checked_one_by_one(spark):
    models = {
        model: spark.range(3).selectExpr(*{f"id AS {c}" for c in (key, *present, *[r[0] for r in relations])})
        for model, (key, present, relations) in declared.DECLARED.items()
    }
    plan = declared.run(models)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
