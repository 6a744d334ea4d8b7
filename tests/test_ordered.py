"""Aggregates over earlier rows, whole and cut, against a plain Python loop."""

import random

import pytest
from pyspark.sql import functions as F

from paddock.operators.ordered import Past, cut_by_event, lay_out, prior, with_parts

WANTED = {
    "sum3": Past("sum", "x", 3),
    "n3": Past("count", None, 3),
    "nx10": Past("count", "x", 10),
    "sum_all": Past("sum", "x"),
    "n_all": Past("count"),
    "nx_all": Past("count", "x"),
}


def brute(rows):
    """rows: (key, a, b, x); expected values by (key, a, b)."""
    out, groups = {}, {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    for key, group in groups.items():
        group.sort(key=lambda r: (r[1], r[2]))
        for i, (_, a, b, _x) in enumerate(group):
            xs = [r[3] for r in group[:i]]
            known = [x for x in xs if x is not None]
            last3 = [x for x in xs[-3:] if x is not None]
            out[(key, a, b)] = {
                "sum3": sum(last3) if last3 else None,
                "n3": len(xs[-3:]),
                "nx10": len([x for x in xs[-10:] if x is not None]),
                "sum_all": sum(known) if known else None,
                "n_all": len(xs),
                "nx_all": len(known),
            }
    return out


def skewed(n, seed):
    """One key holds most rows, one key is NULL, the rest are short."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = rng.choice([1, 1, 1, 1, None, None, rng.randrange(2, 40)])
        x = None if rng.random() < 0.2 else float(rng.randrange(9))
        rows.append((key, rng.randrange(30), i, x))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("chunk_rows", [10**6, 400, 150, 20, 3])
def test_prior_equals_loop(spark, seed, chunk_rows):
    rows = skewed(3000 if chunk_rows > 3 else 300, seed)
    df = spark.createDataFrame(rows, "key int, a int, b int, x double")
    laid = lay_out(df, ["key"], ["a", "b"], chunk_rows)
    assert laid.table.select("_part").distinct().count() >= (1 if chunk_rows == 10**6 else 2)
    got = {
        (r["key"], r["a"], r["b"]): {n: r[n] for n in WANTED}
        for r in prior(laid, WANTED).collect()
    }
    assert got == brute(rows)


def test_long_keys_are_in_many_parts(spark):
    rows = [(1, i, i, 1.0) for i in range(5000)] + [(2, i, i, 1.0) for i in range(50)]
    df = spark.createDataFrame(rows, "key int, a int, b int, x double")
    laid = lay_out(df, ["key"], ["a", "b"], 500)
    sizes = laid.table.groupBy("_part").count().agg(F.count("*"), F.max("count")).first()
    assert sizes[0] >= 9 and sizes[1] < 1500
    plan = prior(laid, WANTED)._jdf.queryExecution().toString()
    assert "_part" in plan


@pytest.mark.parametrize("chunk_rows", [10**6, 500, 60])
def test_frames_longer_than_a_part(spark, chunk_rows):
    df = spark.range(3000).selectExpr("1 AS key", "id AS a", "cast(id AS double) AS x")
    wanted = {"sum200": Past("sum", "x", 200), "n200": Past("count", None, 200)}
    out = prior(lay_out(df, ["key"], ["a"], chunk_rows), wanted).collect()
    assert len(out) == 3000
    for r in out:
        low = max(0, r["a"] - 200)
        assert r["n200"] == r["a"] - low
        assert r["sum200"] == (sum(range(low, r["a"])) or (0.0 if r["a"] > low else None))


def test_finer_keys_follow_the_same_parts(spark):
    rows = skewed(2000, 5)
    df = spark.createDataFrame(rows, "key int, a int, b int, x double").withColumn("odd", F.expr("b % 2"))
    out = prior(lay_out(df, ["key"], ["a", "b"], 150), WANTED, ["key", "odd"])
    assert out.columns == [*df.columns, *WANTED]
    got = {(r["key"], r["a"], r["b"]): {n: r[n] for n in WANTED} for r in out.collect()}
    want = brute([r for r in rows if r[2] % 2]) | brute([r for r in rows if not r[2] % 2])
    assert got == want
    with pytest.raises(ValueError):
        prior(lay_out(df, ["key"], ["a", "b"]), WANTED, ["odd"])


def _events(spark):
    """One long key, one NULL key and short ones; several rows for an event."""
    rng = random.Random(7)
    rows = [(rng.choice([1, 1, 1, None, rng.randrange(2, 60)]), rng.randrange(200), i, float(i % 7)) for i in range(2000)]
    return rows, spark.createDataFrame(rows, "key int, a int, b int, x double")


@pytest.mark.parametrize("chunk_rows", [10**6, 300, 40])
def test_rows_cut_by_event_stay_where_they_are(spark, chunk_rows):
    rows, df = _events(spark)
    laid = cut_by_event(df, ["key"], ["a", "b"], ["a"], chunk_rows)
    assert laid.whole == (chunk_rows == 10**6)
    parts = {(r["key"], r["_part"]) for r in laid.table.collect()}
    assert (max(p for k, p in parts if k == 1) > 1) == (not laid.whole)
    assert {p for k, p in parts if k not in (1, None)} == {0}
    got = {(r["key"], r["a"], r["b"]): {n: r[n] for n in WANTED} for r in prior(laid, WANTED).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("chunk_rows", [40, 10**6])
def test_rows_of_one_layout_pass_through_another(spark, chunk_rows):
    rows, df = _events(spark)
    df = df.withColumn("other", F.col("b") % 3)
    by_key, by_other = (cut_by_event(df, [k], ["a", "b"], ["a"], chunk_rows) for k in ("key", "other"))
    first = prior(by_other, {"n_other": Past("count")}, keep_part=True)
    out = prior(by_key, WANTED, onto=with_parts(by_key, first))
    assert out.columns == [*df.columns, "n_other", *WANTED]
    got = {(r["key"], r["a"], r["b"]): {n: r[n] for n in WANTED} for r in out.collect()}
    assert got == brute(rows)


def test_windows_over_whole_keys_share_a_shuffle(spark):
    _, df = _events(spark)
    df = df.withColumn("odd", F.col("b") % 2)
    laid = cut_by_event(df, ["key"], ["a", "b"], ["a"])
    first = prior(laid, WANTED, keep_part=True)
    more = prior(laid, {"n_odd": Past("count")}, ["key", "odd"], onto=first)
    plan = more._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_many_short_chunks_do_not_make_tasks(spark):
    df = spark.range(20_000).selectExpr("id % 50 AS key", "id AS a", "1.0 AS x")
    laid = cut_by_event(df, ["key"], ["a"], ["a"], 4)
    assert laid.table.select("key", "_part").distinct().count() == 5_000
    assert laid.table.rdd.getNumPartitions() <= 64


@pytest.mark.parametrize("chunk_rows", [40, 10**6])
def test_rows_are_shuffled_without_what_the_windows_add_up(spark, chunk_rows):
    _, df = _events(spark)
    laid = cut_by_event(df, ["key"], ["a", "b"], ["a"], chunk_rows)
    plan = prior(laid, {"n": Past("count", None, 2)})._jdf.queryExecution().optimizedPlan()
    text = plan.toString()
    moved = text[text.index("RepartitionByExpression") :]
    assert "_value_n" not in moved
