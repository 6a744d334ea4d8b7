from paddock.sources import sinks

SCHEMA = (
    "result_id string, year int, round int, race_id bigint, name string, top10_probability double, "
    "top10_prediction boolean, race_date date"
)


def test_folders_are_read_by_tasks_as_spark_reads_them(spark, tmp_path):
    names = ['a,"b"', None, "", " x ", "é=/%", "plain"]
    data = [
        (f"{i}-{i % 3}", None if i % 11 == 0 else 2000 + i % 2, i % 4, i % 7, names[i % 6], i / 7 if i % 5 else None, i % 3 == 0, None)
        for i in range(120)
    ]
    rows = spark.createDataFrame(data, SCHEMA)
    path = f"{tmp_path}/per race"
    sinks.write_per_race(rows, path, 3)
    found, known = sinks.read_per_race(spark, path, rows), sinks.read_csv(spark, path, rows)
    assert found.dtypes == rows.dtypes and found.count() == 120
    assert sorted(map(str, found.collect())) == sorted(map(str, known.collect()))


def test_reading_folders_lists_them_in_tasks(spark, tmp_path):
    """Neither files nor folders are planned on the driver, and what is hidden is no row."""
    rows = spark.range(60).selectExpr(
        "int(2000 + id % 2) AS year", "int(id) AS round", "id AS race_id", "id / 3 AS top10_probability"
    )
    path = f"{tmp_path}/out"
    sinks.write_per_race(rows, path)
    (tmp_path / "out" / "year=2000" / "round=0" / "race_id=0" / "_left.csv").write_text("top10_probability\n9.0\n")
    found = sinks.read_per_race(spark, path, rows)
    assert not found.inputFiles()
    assert found.exceptAll(rows).isEmpty() and rows.exceptAll(found).isEmpty()
