"""The declared data tests find what is wrong."""

from paddock import jobs
from paddock.plans import declared


def test_every_declared_test_is_there():
    tests = [(len(present), len(relations)) for _, present, relations in declared.DECLARED.values()]
    assert (len(tests), sum(n for n, _ in tests), sum(n for _, n in tests)) == (17, 52, 10)


def test_suite_over_the_toy_lake(spark, tmp_path):
    jobs.generate_toy(spark, f"{tmp_path}/lake", seasons=2, rounds=2, drivers=4)
    jobs.build(spark, f"{tmp_path}/lake", f"{tmp_path}/marts")
    found = jobs.test(spark, f"{tmp_path}/lake", f"{tmp_path}/marts").collect()
    assert len(found) == 79 and {r["failures"] for r in found} == {0}


def test_failures_are_counted(spark):
    good = {
        model: spark.range(3).selectExpr(*{f"id AS {c}" for c in (key, *present, *[r[0] for r in relations])})
        for model, (key, present, relations) in declared.DECLARED.items()
    }
    bad = spark.createDataFrame([(1, 0, 9), (1, None, 9), (None, 2, None)], "result_id int, race_id int, driver_id int")
    bad = bad.selectExpr("*", "0 AS constructor_id", "true AS is_top_10", "CAST(NULL AS BOOLEAN) AS is_dnf")
    found = {
        (r["column"], r["test"]): r["failures"]
        for r in declared.run({**good, "fct_results": bad}).where("model = 'fct_results'").collect()
    }
    assert found == {
        ("result_id", "unique"): 1, ("result_id", "not_null"): 1, ("race_id", "not_null"): 1,
        ("driver_id", "not_null"): 1, ("constructor_id", "not_null"): 0, ("is_top_10", "not_null"): 0,
        ("is_dnf", "not_null"): 3, ("race_id", "in dim_race"): 0, ("driver_id", "in dim_driver"): 2,
        ("constructor_id", "in dim_constructor"): 0,
    }


def test_a_model_is_read_once(spark, tmp_path):
    rows = [(1, 7, "a"), (1, 8, None), (2, 9, "b"), (None, None, "c"), (None, 7, None), (3, 8, "d"), (3, 8, "d")]
    spark.createDataFrame(rows, "id int, up int, name string").write.parquet(f"{tmp_path}/model")
    spark.createDataFrame([(7,), (7,), (8,), (None,)], "key int").write.parquet(f"{tmp_path}/parent")
    model, parent = spark.read.parquet(f"{tmp_path}/model"), spark.read.parquet(f"{tmp_path}/parent")
    found = declared.checked(model, "id", ["id", "name"], [("up", parent, "key")])
    assert {(r["column"], r["test"]): r["failures"] for r in found.collect()} == {
        ("id", "unique"): 2, ("id", "not_null"): 2, ("name", "not_null"): 2, ("up", "0"): 1,
    }
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count(f"{tmp_path}/model") == 1 and plan.count(f"{tmp_path}/parent") == 1
    empty = declared.checked(model.limit(0), "id", ["id"], [("up", parent, "key")])
    assert {r["failures"] for r in empty.collect()} == {0}
