import pytest
from pyspark.sql import functions as F

from paddock.functions import scalars as s


def one(spark, schema, row, column):
    return spark.createDataFrame([row], schema).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("status,expected", [
    ("Finished", False), ("+1 Lap", False), ("+12 Laps", False), ("Accident", True),
    ("finished", True), ("", True), (None, True),
])
def test_did_not_finish(spark, status, expected):
    assert one(spark, "x string", (status,), s.did_not_finish(F.col("x"))) is expected


@pytest.mark.parametrize("value,expected", [(1, True), (10, True), (11, False), (0, True), (None, False)])
def test_at_most(spark, value, expected):
    assert one(spark, "x int", (value,), s.at_most(F.col("x"), 10)) is expected


@pytest.mark.parametrize("first,last,expected", [
    ("A", "B", "A B"), ("A", None, "A "), (None, "B", " B"), (None, None, " "),
])
def test_joined_name(spark, first, last, expected):
    got = one(spark, "a string, b string", (first, last), s.joined_name(F.col("a"), F.col("b")))
    assert got == expected


@pytest.mark.parametrize("n,m,expected", [
    (1, 3, 0.333), (2, 3, 0.667), (1, 2000, 0.001), (1, 2001, 0.0), (7, 5, 1.4), (0, 5, 0.0),
    (5, 0, 0.0), (None, None, 0.0),
])
def test_guarded_rate(spark, n, m, expected):
    got = one(spark, "n int, m int", (n, m), s.guarded_rate(F.col("n"), F.col("m")))
    assert got == expected


def test_positions_gained_and_session_time(spark):
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    assert one(spark, "a int, b int", (5, 2), s.positions_gained(a, b)) == 3
    assert one(spark, "a int, b int", (None, 2), s.positions_gained(a, b)) is None
    best = s.last_session_time(a, b, c)
    assert one(spark, "a string, b string, c string", ("1", "2", None), best) == "2"
    assert one(spark, "a string, b string, c string", ("1", None, "3"), best) == "3"


def test_the_two_labels_prefer_different_outcomes(spark):
    summary = s.summary_label(F.col("a") > 0.5, F.col("b") > 0.5)
    panel = s.panel_label(F.col("a"), F.col("b"))
    both = (0.9, 0.87)
    assert one(spark, "a double, b double", both, summary) == "TOP-10"
    assert one(spark, "a double, b double", both, panel) == "DNF"
    assert one(spark, "a double, b double", (0.5, 0.5), panel) == "Outside Top-10"
    assert one(spark, "a double, b double", (0.1, 0.2), summary) == "11th-20th"
