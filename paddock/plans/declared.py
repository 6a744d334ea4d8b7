"""The declared data tests of staging, intermediate tables and marts, as one suite."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.scratch import materialize

# For each model its unique key, its columns that are never missing, and
# (column, model, column) of each key that must exist elsewhere.
DECLARED: dict[str, tuple[str, tuple[str, ...], tuple[tuple[str, str, str], ...]]] = {
    "stg_races": ("race_id", ("race_id", "year", "circuit_id"), ()),
    "stg_results": ("result_id", ("result_id", "race_id", "driver_id", "constructor_id"), ()),
    "stg_qualifying": ("qualify_id", ("qualify_id", "race_id", "driver_id"), ()),
    "stg_drivers": ("driver_id", ("driver_id", "full_name"), ()),
    "stg_constructors": ("constructor_id", ("constructor_id", "constructor_name"), ()),
    "stg_circuits": ("circuit_id", ("circuit_id", "circuit_name"), ()),
    "stg_status": ("status_id", ("status_id", "status_description"), ()),
    "stg_seasons": ("year", ("year",), ()),
    "int_results_enriched": (
        "result_id",
        ("result_id", "race_id", "driver_id", "constructor_id", "is_top_10", "is_dnf"),
        (
            ("race_id", "stg_races", "race_id"),
            ("driver_id", "stg_drivers", "driver_id"),
            ("constructor_id", "stg_constructors", "constructor_id"),
        ),
    ),
    "int_qualifying_clean": (
        "qualify_id",
        ("qualify_id", "race_id", "driver_id"),
        (("race_id", "stg_races", "race_id"), ("driver_id", "stg_drivers", "driver_id")),
    ),
    "dim_driver": ("driver_id", ("driver_id", "full_name"), ()),
    "dim_constructor": ("constructor_id", ("constructor_id", "constructor_name"), ()),
    "dim_circuit": ("circuit_id", ("circuit_id", "circuit_name"), ()),
    "dim_race": ("race_id", ("race_id", "year", "race_name", "race_date"), ()),
    "fct_results": (
        "result_id",
        ("result_id", "race_id", "driver_id", "constructor_id", "is_top_10", "is_dnf"),
        (
            ("race_id", "dim_race", "race_id"),
            ("driver_id", "dim_driver", "driver_id"),
            ("constructor_id", "dim_constructor", "constructor_id"),
        ),
    ),
    "fct_qualifying": (
        "qualify_id",
        ("qualify_id", "race_id", "driver_id"),
        (("race_id", "dim_race", "race_id"), ("driver_id", "dim_driver", "driver_id")),
    ),
    "fct_features_pre_race": (
        "result_id",
        ("result_id", "race_id", "driver_id", "target_top_10", "target_dnf"),
        (),
    ),
}


def checked(
    df: DataFrame,
    key: str,
    present: Sequence[str],
    relations: Sequence[tuple[str, DataFrame, str]] = (),
) -> DataFrame:
    """(column, test, failures) of one model, which is read once.

    ``relations`` are (column, parent, key of the parent).  The rows meet the distinct keys
    of all parents, are counted by key, and the counts are added up.  ``unique`` counts
    repeated keys, ``not_null`` missing values, the others rows whose key the parent
    (by number) lacks.  A model without rows has no failures.
    """
    rows = df.select(*dict.fromkeys([key, *present, *[column for column, _, _ in relations]]))
    for k, (column, parent, parent_key) in enumerate(relations):
        known = parent.select(F.col(parent_key).alias(column)).dropna().distinct()
        rows = rows.join(known.withColumn(f"_known_{k}", F.lit(True)), column, "left")
    counts = {("not_null", c): F.count_if(F.col(c).isNull()) for c in present}
    for k, (column, _, _) in enumerate(relations):
        lost = F.col(column).isNotNull() & F.col(f"_known_{k}").isNull()
        counts[k, column] = F.count_if(lost)
    names = [f"_n{i}" for i in range(len(counts))]
    by_key = rows.groupBy(F.col(key).alias("_key")).agg(
        F.count(F.lit(1)).alias("_rows"), *[c.alias(n) for c, n in zip(counts.values(), names)]
    )
    repeated = F.count_if(F.col("_key").isNotNull() & (F.col("_rows") > 1))
    total = by_key.agg(repeated.alias("_repeated"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    tests = [(key, "unique", "_repeated")]
    tests += [(column, str(test), name) for (test, column), name in zip(counts, names)]
    cells = ", ".join(f"'{column}', '{test}', `{name}`" for column, test, name in tests)
    return total.selectExpr(f"stack({len(tests)}, {cells}) AS (column, test, failures)")


def run(models: Mapping[str, DataFrame]) -> DataFrame:
    """(model, column, test, failures) of every declared test, one pass over each model."""
    parts = []
    for model, (key, present, relations) in DECLARED.items():
        parents = [(column, models[parent], parent_key) for column, parent, parent_key in relations]
        named = {str(k): f"in {parent}" for k, (_, parent, _) in enumerate(relations)}
        test = F.col("test")
        if named:
            test = F.coalesce(F.create_map(*[F.lit(x) for pair in named.items() for x in pair])[test], test)
        # stored one by one: the shuffles of a model go before the next one is read
        found = materialize(checked(models[model], key, present, parents), "failures")
        parts.append(found.select(F.lit(model).alias("model"), "column", test.alias("test"), "failures"))
    return reduce(DataFrame.unionAll, parts)
