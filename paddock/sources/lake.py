"""Parquet tables of a folder as views, with ad-hoc SQL and an inventory."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.sources import files

log = logging.getLogger(__name__)


def read_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All ``*.parquet`` tables of a folder by lower-cased name."""
    if not files.exists(spark, folder):
        log.warning("no such folder: %s", folder)
        return {}
    found = files.glob(spark, f"{folder}/*.parquet")
    if not found:
        log.warning("no Parquet tables in %s", folder)
    return {files.stem(path): spark.read.parquet(path) for path in found}


def register(spark: SparkSession, folder: str, prefix: str = "raw_") -> list[str]:
    """Register every table of a folder as a view; returns the view names."""
    names = []
    for stem, table in read_tables(spark, folder).items():
        table.createOrReplaceTempView(f"{prefix}{stem}")
        names.append(f"{prefix}{stem}")
    return names


# what the catalog can keep column statistics of
_COUNTED = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)

STATISTICS = (
    "table_name string, column_name string, n_rows long, n_nulls long, min string, max string, distinct_count long"
)


def register_tables(
    spark: SparkSession, folder: str, database: str, prefix: str = "raw_", location: str | None = None
) -> list[str]:
    """Register every table of a folder in a database of the catalog; returns their names.

    With a catalog that lasts (spark.sql.catalogImplementation=hive, or another one) later
    sessions find them; the files stay where they are.
    """
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")
    names = []
    for stem in read_tables(spark, folder):
        name = f"`{database}`.`{prefix}{stem}`"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=f"{folder}/{stem}.parquet", source="parquet")
        names.append(f"{database}.{prefix}{stem}")
    return names


def analyze_tables(spark: SparkSession, names: Sequence[str]) -> None:
    """Compute row counts and column statistics, and enter them in the catalog.

    With ``spark.sql.cbo.enabled`` the planner estimates filters and joins from them; their
    sizes decide on broadcasts in any case.  One pass over each table.
    """
    for name in names:
        fields = [f.name for f in spark.table(name).schema.fields if isinstance(f.dataType, _COUNTED)]
        columns = ", ".join(f"`{f}`" for f in fields)
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS" + (f" FOR COLUMNS {columns}" if fields else ""))


def statistics(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """What the catalog knows of each column; reads no table.

    ``distinct_count`` is an estimate, the others are exact.  The smallest and largest
    values are kept of numbers and days.
    """
    rows = []
    for name in names:
        whole = dict(spark.sql(f"DESCRIBE EXTENDED {name}").select("col_name", "data_type").collect())
        n_rows = int(whole["Statistics"].split(", ")[-1].removesuffix(" rows"))
        for field in spark.table(name).schema.fields:
            if not isinstance(field.dataType, _COUNTED):
                continue
            known = dict(spark.sql(f"DESCRIBE EXTENDED {name} `{field.name}`").collect())
            found = {k: None if v in (None, "NULL") else v for k, v in known.items()}
            whole_number = {k: int(found[k]) if found[k] else None for k in ("num_nulls", "distinct_count")}
            rows.append((name, field.name, n_rows, whole_number["num_nulls"], found["min"], found["max"], whole_number["distinct_count"]))
    return spark.createDataFrame(rows, STATISTICS)


def query(spark: SparkSession, text: str, description: str = "") -> DataFrame:
    """Run ad-hoc SQL over the registered views."""
    if description:
        log.info(description)
    return spark.sql(text)


def inventory(
    spark: SparkSession, prefix: str = "", names: Sequence[str] | None = None
) -> DataFrame:
    """Row counts of the named views, or of all tables and views with a prefix, by name."""
    if names is None:
        names = [t.name for t in spark.catalog.listTables() if t.name.startswith(prefix)]
    names = sorted(names)
    if not names:
        return spark.createDataFrame([], "table_name string, n_rows bigint")
    counts = [
        spark.table(f"`{n}`").agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(n).alias("table_name"), "n_rows")
        for n in names
    ]
    return reduce(DataFrame.union, counts).orderBy("table_name")
