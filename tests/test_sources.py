import time
from pathlib import Path

import pytest

from paddock import scratch
from paddock.operators import quality
from paddock.plans import catalog
from paddock.sources import csv_lake, files, lake, schemas, sinks, toy


def put(folder: Path, name: str, text: str) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    return str(folder / name)


def test_csv_null_tokens_quotes_and_line_breaks(spark, tmp_path):
    path = put(tmp_path, "x.csv", 'a,b,c\n1,\\N,"p ""q"", r"\nNA,x,"two\nlines"\n3,,null\n')
    rows = [tuple(r)[:3] for r in csv_lake.scan_csv(spark, path).orderBy("c").collect()]
    assert set(rows) == {("1", None, 'p "q", r'), (None, "x", "two\nlines"), ("3", None, None)}


def test_types_are_given_to_whole_columns_or_not_at_all(spark, tmp_path):
    path = put(
        tmp_path, "results.csv",
        "resultId,grid,points,text,flag,big,frac\n1,3.0,1.5,7,True,5,1.5\n2,\\N,2,R,False,6,2\n",
    )
    table = csv_lake.typed(csv_lake.scan_csv(spark, path), {"resultId": "int", "grid": "int",
                                                           "points": "float", "text": "int"})
    assert dict(table.dtypes) == {
        "resultId": "int", "grid": "int", "points": "float", "text": "string",
        "flag": "boolean", "big": "bigint", "frac": "double",
    }
    assert [r["grid"] for r in table.orderBy("resultId").collect()] == [3, None]


def test_records_that_do_not_fit_are_set_aside(spark, tmp_path):
    text = 'a,b,c\n1,x,2\n2,y\n3,"q, ""r""",4,5\n4,,\n5,"two\nlines",6\n6,"z,z",7,"8,8",9\n'
    path = put(tmp_path, "x.csv", text)
    raw = csv_lake.scan_csv(spark, path)
    rows = csv_lake.typed(raw)
    assert dict(rows.dtypes) == {"a": "bigint", "b": "string", "c": "bigint"}
    assert {tuple(r) for r in rows.collect()} == {(1, "x", 2), (4, None, None), (5, "two\nlines", 6)}
    assert rows.select("c").count() == rows.agg({"c": "count"}).first()[0] + 1 == 3
    aside = {(r["file"].rsplit("/", 1)[1], r["reason"], r["record"]) for r in csv_lake.quarantined(raw).collect()}
    assert aside == {
        ("x.csv", "2 fields, fewer than the 3 of the header", "2,y"),
        ("x.csv", "4 fields, more than the 3 of the header", '3,"q, ""r""",4,5'),
        ("x.csv", "5 fields, more than the 3 of the header", '6,"z,z",7,"8,8",9'),
    }


def test_one_bad_file_does_not_stop_the_rest(spark, tmp_path):
    raw, lake_dir = tmp_path / "raw", str(tmp_path / "lake")
    put(raw, "Status.csv", "statusId,status\n1,Finished\n2,+1 Lap\n")
    put(raw / "bad.csv", "part.csv.gz", "no archive at all")
    put(raw, "seasons.csv", "year,url\n2014,u\n2015\n2016,v,w\n")
    for _ in range(2):  # a second run replaces what the first one left
        stats = {r["table"]: r for r in csv_lake.convert_all(spark, str(raw), lake_dir).collect()}
        assert {t: r["ok"] for t, r in stats.items()} == {"status": True, "bad": False, "seasons": True}
        assert stats["status"]["n_rows"] == 2 and stats["status"]["n_columns"] == 2
        assert stats["status"]["parquet_mb"] > 0 and stats["bad"]["error"]
        assert (stats["seasons"]["n_rows"], stats["seasons"]["n_quarantined"]) == (1, 2)
        assert spark.read.parquet(f"{lake_dir}/_quarantine/seasons.parquet").count() == 2
    assert list(lake.read_tables(spark, lake_dir)) == ["seasons", "status"]
    put(raw, "seasons.csv", "year,url\n2014,u\n")
    csv_lake.convert_csv(spark, f"{raw}/seasons.csv", lake_dir)
    assert not files.exists(spark, f"{lake_dir}/_quarantine/seasons.parquet")
    assert csv_lake.convert_all(spark, str(tmp_path / "none"), str(tmp_path / "l2")).count() == 0


def test_a_hint_that_fails_is_seen_while_writing(spark, tmp_path):
    """Hinted columns take no pass of their own; the table is right after the second write."""
    path = put(tmp_path, "qualifying.csv", "qualifyId,raceId,number,note\n1,10,3.0,a\n2,x,\\N,b\n3,12,5,c\n")
    stats = csv_lake.convert_csv(spark, path, str(tmp_path / "lake"))
    table = spark.read.parquet(f"{tmp_path}/lake/qualifying.parquet")
    assert dict(table.dtypes) == {"qualifyId": "int", "raceId": "string", "number": "int", "note": "string"}
    assert stats[:5] == ("qualifying", True, 3, 0, 4) and table.count() == 3
    assert {(r["raceId"], r["number"]) for r in table.collect()} == {("10", 3), ("x", None), ("12", 5)}


def test_lake_views_and_inventory(spark, tmp_path):
    for name, df in toy.lake(spark, 2, 2, 3).items():
        csv_lake.write_table(df, f"{tmp_path}/{name}.parquet")
    names = lake.register(spark, str(tmp_path), "t1_")
    assert names == sorted(f"t1_{n}" for n in toy.lake(spark))
    counts = {r["table_name"]: r["n_rows"] for r in lake.inventory(spark, "t1_").collect()}
    assert counts["t1_results"] == 12 and list(counts) == sorted(counts)
    assert lake.query(spark, "SELECT count(*) AS n FROM t1_races").first()["n"] == 4
    assert lake.register(spark, f"{tmp_path}/missing") == []
    found = lake.read_tables(spark, str(tmp_path))
    checks = quality.check_columns(spark, found, schemas.REQUIRED, schemas.OPTIONAL)
    assert all(r["ok"] for r in checks.collect()) and checks.count() == 8


def test_required_columns_ignore_case(spark):
    mixed = spark.range(2).selectExpr(
        "id AS raceid", "2020 AS YEAR", "1 AS Round", "1 AS circuitID", "'n' AS NAME", "'d' AS date"
    )
    assert quality.missing_columns(mixed, schemas.REQUIRED["races"]) == []
    few = mixed.select("raceid", "YEAR")
    assert quality.missing_columns(few, schemas.REQUIRED["races"]) == [
        "circuitid", "date", "name", "round",
    ]
    rows = quality.check_columns(spark, {"races": few}, {"races": schemas.REQUIRED["races"],
                                                         "status": schemas.REQUIRED["status"]})
    assert {r["table"]: (r["present"], r["ok"]) for r in rows.collect()} == {
        "races": (True, False), "status": (False, False),
    }


@pytest.mark.parametrize("file_rows", [1_000_000, 20])
def test_one_folder_per_race(spark, tmp_path, file_rows):
    rows = spark.range(130).selectExpr(
        "2020 AS year", "IF(id < 100, 1, 2) AS round", "IF(id < 100, 7, 8) AS race_id",
        "id AS driver_id",
    )
    sinks.write_per_race(rows, f"{tmp_path}/out", file_rows)
    found = files.glob(spark, f"{tmp_path}/out/year=2020/round=*/race_id=*")
    assert [f.rsplit("/", 1)[1] for f in found] == ["race_id=7", "race_id=8"]
    parts = files.glob(spark, f"{tmp_path}/out/year=2020/round=1/race_id=7/*.csv")
    assert (len(parts) == 1) == (file_rows > 100)
    assert all(len(Path(f.removeprefix("file:")).read_text().splitlines()) <= file_rows + 1 for f in parts)
    back = sinks.read_csv(spark, f"{tmp_path}/out", rows)
    assert back.exceptAll(rows).isEmpty() and back.count() == 130
    # a race that is written again, and a new one; the others stay as they are
    more = spark.range(3).selectExpr("2020 AS year", "IF(id < 2, 1, 3) AS round", "IF(id < 2, 7, 9) AS race_id", "id + 500 AS driver_id")
    sinks.write_per_race(more, f"{tmp_path}/out", file_rows)
    back = sinks.read_csv(spark, f"{tmp_path}/out", rows)
    assert {r["race_id"]: r["n"] for r in back.groupBy("race_id").agg({"*": "count"}).toDF("race_id", "n").collect()} == {7: 2, 8: 30, 9: 1}


def test_very_many_races(spark, tmp_path):
    """Folders are made by tasks: ten milliseconds for each on the driver would take longer."""
    rows = spark.range(6000).selectExpr("2020 AS year", "id % 300 AS round", "id % 3000 AS race_id", "id AS driver_id")
    started = time.perf_counter()
    for _ in range(2):
        sinks.write_per_race(rows, f"{tmp_path}/out")
    assert time.perf_counter() - started < 60
    back = sinks.read_csv(spark, f"{tmp_path}/out", rows)
    assert back.count() == 6000 and back.exceptAll(rows).isEmpty()
    names = [p.name for p in (tmp_path / "out").rglob("*") if p.is_file()]
    assert len(names) == 3000 and all(n.startswith("part-") for n in names)


def test_race_files_hold_what_spark_writes(spark, tmp_path):
    odd = ["plain", 'a "quoted" one', "a,b", "", None, " blank ", "tab\t", "ü", "back\\slash"]
    data = [(2020, 1, r, i, v) for i, v in enumerate(odd) for r in ("7", "a/b=c %", None)]
    schema = "year int, round int, race_id string, driver_id int, `the,note` string"
    rows = spark.createDataFrame(data, schema).coalesce(1)
    sinks.write_per_race(rows, f"{tmp_path}/ours")
    rows.write.partitionBy("year", "round", "race_id").options(**sinks.DIALECT).csv(f"{tmp_path}/sparks")

    def texts(folder):
        found = {}
        for path in (tmp_path / folder).rglob("part-*.csv"):
            found.setdefault(str(path.parent.relative_to(tmp_path / folder)), []).append(path.read_text().splitlines())
        return {name: sorted(sum((t[1:] for t in files), [files[0][0]])) for name, files in found.items()}

    assert texts("ours") == texts("sparks") and len(texts("ours")) == 3


def test_broken_json_records_keep_their_text(spark):
    like = spark.sql("SELECT 1 AS race_id, CAST(0.5 AS DOUBLE) AS p, true AS yes")
    texts = ['{"race_id":1,"p":null,"yes":true}', '{"race_id":2', '{"race_id":"x","p":0.25,"yes":false}', "no json"]
    records = spark.createDataFrame([(t,) for t in texts], "record string")
    rows = [tuple(r) for r in sinks.from_json(records, like).collect()]
    assert rows[0] == (1, None, True, None)
    assert [r[-1] for r in rows[1:]] == texts[1:]


def test_saved_evaluation_without_probability(spark, tmp_path):
    put(tmp_path, "e.csv", "actual,prediction\nTrue,True\nFalse,True\n")
    rows = sinks.read_evaluation(spark, str(tmp_path / "e.csv")).collect()
    assert [(r["actual"], r["prediction"], r["probability"]) for r in rows] == [
        (True, True, 1.0), (False, True, 1.0),
    ]


def test_a_run_is_recorded_once(spark, tmp_path):
    for run, trees in (("a", 5), ("1", 6), ("x/y z", 7), ("a", 8)):
        sinks.record_run(spark, f"{tmp_path}/runs", run, {"trees": trees}, {"accuracy": 0.5})
    rows = sinks.read_runs(spark, f"{tmp_path}/runs").collect()
    assert {(r["run"], r["text"]) for r in rows if r["name"] == "trees"} == {("a", "8"), ("1", "6"), ("x/y z", "7")}
    assert len(rows) == 6 and {r["value"] for r in rows if r["kind"] == "metric"} == {0.5}


def test_json_keeps_missing_fields(spark, tmp_path):
    record = sinks.as_json(spark.sql("SELECT 1 AS race_id, CAST(NULL AS DOUBLE) AS p")).first()
    assert record["record"] == '{"race_id":1,"p":null}'
    assert sinks.selected(spark.sql("SELECT 1 AS other, 2 AS race_id")).columns == ["race_id"]


def test_texts_with_quotes_come_back(spark, tmp_path):
    rows = spark.createDataFrame([('say "hi", ok', 1), ("a\\b", 2), ('"', 3), ("x,y", 4)], "a string, b int")
    sinks.write_csv(rows, f"{tmp_path}/out")
    assert sinks.read_csv(spark, f"{tmp_path}/out", rows).exceptAll(rows).isEmpty()
    typed = csv_lake.typed(csv_lake.scan_csv(spark, f"{tmp_path}/out"))
    assert {(r["a"], r["b"]) for r in typed.collect()} == {tuple(r) for r in rows.collect()}


def test_files_of_a_folder_keep_their_own_header(spark, tmp_path):
    put(tmp_path / "t.csv", "1.csv", "a,b\n1,x\n")
    put(tmp_path / "t.csv", "2.csv", "b,a\ny,2\n")
    put(tmp_path / "t.csv", "3.csv", 'a,b,c\n3,"two\nlines",9\n')
    table = csv_lake.typed(csv_lake.scan_csv(spark, f"{tmp_path}/t.csv"))
    assert {(r["a"], r["b"], r["c"]) for r in table.collect()} == {
        (1, "x", None), (2, "y", None), (3, "two\nlines", 9),
    }


def test_only_a_file_with_line_breaks_is_read_whole(spark, tmp_path):
    put(tmp_path / "t.csv", "long.csv", "a,b\n" + "".join(f"{i},text {i}\n" for i in range(20000)))
    put(tmp_path / "t.csv", "lines.csv", 'a,b\n1,"two\nlines"\n')
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        raw = csv_lake.scan_csv(spark, f"{tmp_path}/t.csv")
        assert raw.count() == 20001
        tasks = raw.where("b LIKE 'text%'").selectExpr("spark_partition_id() AS p").distinct().count()
        assert tasks > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_tables_in_a_database(spark, tmp_path):
    toy.status(spark).write.parquet(f"{tmp_path}/status.parquet")
    names = lake.register_tables(spark, str(tmp_path), "paddock_test")
    assert names == ["paddock_test.raw_status"] and spark.table(names[0]).count() == 5
    lake.analyze_tables(spark, names)
    found = {r["column_name"]: r for r in lake.statistics(spark, names).collect()}
    assert (found["statusId"]["n_rows"], found["statusId"]["n_nulls"], found["statusId"]["min"], found["statusId"]["max"]) == (5, 0, "1", "5")
    assert set(found) == {"statusId", "status"} and found["status"]["min"] is None
    # the planner sizes a join by the rows it knows
    spark.conf.set("spark.sql.cbo.enabled", "true")
    try:
        plan = spark.table(names[0]).where("statusId > 3")._jdf.queryExecution().optimizedPlan().stats().toString()
        assert "rowCount=" in plan
    finally:
        spark.conf.unset("spark.sql.cbo.enabled")
    spark.sql("DROP DATABASE paddock_test CASCADE")


def test_stored_tables_can_be_released(spark):
    with scratch.recorded([]) as made:
        one = scratch.materialize(spark.range(3), "one")
        with scratch.recorded([]) as inner:
            two = scratch.materialize(spark.range(4), "two")
    outside = scratch.materialize(spark.range(5), "outside")
    assert (len(made), len(inner)) == (1, 1)
    assert scratch.reads(one.where("id > 0"), made) and not scratch.reads(two, made)
    paths = list(made)
    scratch.release(spark, made)
    assert made == [] and not files.exists(spark, paths[0])
    assert two.count() == 4 and outside.count() == 5 and not scratch.reads(outside, [])


def test_every_prediction_is_read_back_from_its_record(spark):
    folder = "/root/testdata/sf0.001"
    read = catalog.predictions_json(spark, folder)
    whole = read.where("broken IS NULL")
    rows = sinks.selected(catalog._scored(spark, folder))
    assert whole.drop("broken").exceptAll(rows).isEmpty() and rows.exceptAll(whole.drop("broken")).isEmpty()
    assert read.where("broken IS NOT NULL").count() == rows.where("driver_id % 2 = 1").count()


def test_only_few_rows_are_small(spark):
    df = spark.range(100)
    assert "broadcast" in scratch.small(df, 800)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in scratch.small(df, 799)._jdf.queryExecution().analyzed().toString().lower()
