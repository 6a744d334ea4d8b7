"""CSV files to a typed Parquet lake."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.sources import files
from paddock.sources.schemas import NULL_TOKENS, TYPES

log = logging.getLogger(__name__)

# of a record that does not fit its header: its text, its file and the fields expected
_BAD, _FILE, _FIELDS = "_bad_record", "_bad_file", "_fields"

STATS = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("n_quarantined", T.LongType()),
        T.StructField("n_columns", T.IntegerType()),
        T.StructField("csv_mb", T.DoubleType()),
        T.StructField("parquet_mb", T.DoubleType()),
        T.StructField("compression_pct", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ]
)


def _layouts(spark: SparkSession, path: str) -> dict[tuple[str, bool], list[str]]:
    """Files of a path by their header line and by whether a quoted field spans lines.

    Each line of a file without such fields holds an even number of quotes.  One row a
    file reaches the driver, which lists the files in any case.
    """
    quotes = F.length(F.regexp_replace("value", '[^"]', ""))
    place = F.struct("_metadata.file_block_start", F.monotonically_increasing_id())
    by_file = (
        spark.read.text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            "value",
            place.alias("place"),
            (quotes % 2 == 1).alias("odd"),
        )
        .groupBy("file")
        .agg(F.min_by("value", "place").alias("header"), F.max("odd").alias("spans"))
        .orderBy("file")
    )
    found: dict[tuple[str, bool], list[str]] = {}
    for row in by_file.toLocalIterator():
        found.setdefault((row["header"], row["spans"]), []).append(row["file"])
    return found


def scan_csv(
    spark: SparkSession, path: str, null_tokens: Sequence[str] = NULL_TOKENS
) -> DataFrame:
    """All columns as text with the null tokens replaced, one row for each record.

    Files may have their columns in different orders, or lack some: each is read by its
    own header, and a missing column is NULL.  Only a file in which a quoted field spans
    lines is read by one task; all others are split.  A record with more or fewer fields
    than its header is marked; ``fitting`` and ``quarantined`` tell the two kinds apart.
    """
    parts = []
    for (_, spans), paths in _layouts(spark, path).items():
        names = spark.read.option("header", True).option("escape", '"').csv(paths[0]).columns
        schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, _BAD)])
        # pruned columns would not be counted, so that no record would be too short or long
        reader = spark.read.schema(schema).option("header", True).option("escape", '"').option("columnPruning", False)
        marked = reader.option("columnNameOfCorruptRecord", _BAD).option("multiLine", spans).csv(paths)
        # Spark refuses to read the marks alone, so they always come with the first field
        first = F.length(F.coalesce(F.col(f"`{names[0]}`"), F.lit("")))
        mark = F.when(first >= 0, F.col(_BAD))
        parts.append(marked.withColumns({_BAD: mark, _FILE: F.col("_metadata.file_path"), _FIELDS: F.lit(len(names))}))
    if not parts:
        # no file has a line
        return spark.read.option("header", True).csv(path)
    raw = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return raw.select(
        *[
            F.when(~F.col(f"`{n}`").isin(list(null_tokens)), F.col(f"`{n}`")).alias(n)
            for n in _names(raw)
        ],
        *[c for c in (_BAD, _FILE, _FIELDS) if c in raw.columns],
    )


def _names(raw: DataFrame) -> list[str]:
    return [n for n in raw.columns if n not in (_BAD, _FILE, _FIELDS)]


def _fits(raw: DataFrame) -> Column:
    return F.col(_BAD).isNull() if _BAD in raw.columns else F.lit(True)


def fitting(raw: DataFrame) -> DataFrame:
    """The records that have as many fields as their header."""
    return raw.where(_fits(raw)).select(*[F.col(f"`{n}`") for n in _names(raw)])


def quarantined(raw: DataFrame) -> DataFrame:
    """(file, reason, record) of every other record."""
    bare = F.regexp_replace(_BAD, '"([^"]|"")*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1
    how = F.when(fields > F.col(_FIELDS), "more").otherwise("fewer")
    reason = F.concat(fields.cast("string"), F.lit(" fields, "), how, F.lit(" than the "), F.col(_FIELDS).cast("string"), F.lit(" of the header"))
    return raw.where(~_fits(raw)).select(F.col(_FILE).alias("file"), reason.alias("reason"), F.col(_BAD).alias("record"))


# Shapes of numbers.  Casting only text of that shape is much cheaper than letting
# the cast fail on everything else.
_WHOLE = r"^\s*[+-]?\d+\s*$"
_NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)\s*$"


def _as_type(column: Column, kind: str) -> Column:
    """The column as a type; NULL where the text is not of that type."""
    if kind in ("int", "bigint"):
        whole = F.when(column.rlike(_WHOLE), column.try_cast(kind))
        # as in a numeric column that is then cut to whole numbers: "3.0" is 3
        cut = F.when(column.rlike(_NUMBER), column.try_cast("double").try_cast(kind))
        return F.coalesce(whole, cut)
    if kind in ("float", "double"):
        return F.when(column.rlike(_NUMBER), column.try_cast(kind))
    if kind == "boolean":
        lowered = F.lower(column)
        return F.when(lowered == "true", F.lit(True)).when(lowered == "false", F.lit(False))
    return column.try_cast(kind)


# What a present value can be read as, most special first.
_KINDS = ("bigint", "double", "boolean", "string")


def _kind(column: Column) -> Column:
    """Number of the most special kind that a present value has; NULL for a missing one."""
    # up to 18 digits always fit; longer ones are tried
    short = column.rlike(r"^\s*[+-]?\d{1,18}\s*$")
    whole = short | (column.rlike(_WHOLE) & column.try_cast("bigint").isNotNull())
    lowered = F.lower(column)
    return (
        F.when(column.isNull(), None)
        .when(whole, 0)
        .when(column.rlike(_NUMBER), 1)
        .when((lowered == "true") | (lowered == "false"), 2)
        .otherwise(3)
    )


def _bits(column: Column) -> Column:
    """One bit for each kind that occurs among the values of a column."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1), _kind(column)))


def _kind_of(bits: int | None) -> str:
    """The type that fits all values of a column."""
    present = {k for b, k in enumerate(_KINDS) if (bits or 0) >> b & 1}
    if len(present) == 1:
        return present.pop()
    return "double" if present == {"bigint", "double"} else "string"


def _inferred(raw: DataFrame, names: Sequence[str]) -> dict[str, str]:
    """The types that fit all values of these columns, in one pass."""
    if not names:
        return {}
    bits = [_bits(F.col(f"`{n}`")).alias(f"bits{i}") for i, n in enumerate(names)]
    return {n: _kind_of(b) for n, b in zip(names, fitting(raw).agg(*bits).first(), strict=True)}


def _cast(name: str, kind: str) -> Column:
    column = F.col(f"`{name}`")
    return column if kind == "string" else _as_type(column, kind)


def _misfits(name: str, kind: str) -> Column:
    """Number of present values that the type cannot take."""
    return F.count_if(F.col(f"`{name}`").isNotNull() & _cast(name, kind).isNull())


def typed(raw: DataFrame, hints: Mapping[str, str] | None = None) -> DataFrame:
    """Give each text column of the fitting records a type, for the whole column or not at all.

    A hinted type is used if every present value can be read as it; otherwise, and
    for columns without a hint, the first of bigint, double, boolean that fits all
    values; otherwise text.  A whole-number hint gives a whole-number column even where
    values are missing.  All values of all columns are checked in one pass.
    """
    rows, names = fitting(raw), _names(raw)
    hints = {k: v for k, v in (hints or {}).items() if k in names}
    checks = [_bits(F.col(f"`{n}`")).alias(f"bits{i}") for i, n in enumerate(names)]
    checks += [_misfits(n, hints[n]).alias(f"not{i}") for i, n in enumerate(names) if n in hints]
    found = rows.agg(*checks).first()
    kinds = {}
    for i, n in enumerate(names):
        kinds[n] = hints[n] if n in hints and not found[f"not{i}"] else _kind_of(found[f"bits{i}"])
        if n in hints and found[f"not{i}"]:
            log.warning("column %s cannot be read as %s", n, hints[n])
    return rows.select(*[_cast(n, kinds[n]).alias(n) for n in names])


def write_table(df: DataFrame, path: str) -> None:
    """Store a table; one that is there already is replaced."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def _write_observed(raw: DataFrame, kinds: Mapping[str, str], target: str) -> dict[str, int]:
    """Store the typed records; their number, that of the others, and misfits by place.

    The numbers are observed while the rows are written, so nothing is read for them.
    """
    seen = Observation()
    good = _fits(raw)
    measures = [F.count_if(good).alias("rows"), F.count_if(~good).alias("bad")]
    for i, (name, kind) in enumerate(kinds.items()):
        if kind != "string":
            lost = good & F.col(f"`{name}`").isNotNull() & F.col(f"_typed_{i}").isNull()
            measures.append(F.count_if(lost).alias(f"not{i}"))
    cast = {f"_typed_{i}": _cast(n, k) for i, (n, k) in enumerate(kinds.items())}
    rows = raw.withColumns(cast).observe(seen, *measures).where(good)
    write_table(rows.select(*[F.col(f"_typed_{i}").alias(n) for i, n in enumerate(kinds)]), target)
    return seen.get


def _session_apart(spark: SparkSession) -> SparkSession:
    """A session with the same settings, in which rows may be observed.

    A session that has observed anything can no longer be part of a task, as it is in those
    that apply a stored model.
    """
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if session.conf.isModifiable(name):
            session.conf.set(name, value)
    return session


def convert_csv(
    spark: SparkSession, csv_path: str, lake: str, table: str | None = None
) -> tuple:
    """One CSV file or folder to ``lake/<table>.parquet``; returns its statistics.

    Hinted types are tried while the table is written; only where one does not fit are the
    values looked at and the table written again.  Columns without a hint take a
    pass of their own.  Records that do not fit their header go to
    ``lake/_quarantine/<table>.parquet`` with file and reason.
    """
    table = table or files.stem(csv_path)
    target, aside = f"{lake}/{table}.parquet", f"{lake}/_quarantine/{table}.parquet"
    raw = scan_csv(_session_apart(spark), csv_path)
    names, hints = _names(raw), TYPES.get(table, {})
    inferred = _inferred(raw, [n for n in names if n not in hints])
    kinds = {n: hints.get(n) or inferred[n] for n in names}
    seen = _write_observed(raw, kinds, target)
    wrong = [n for i, n in enumerate(names) if seen.get(f"not{i}")]
    if wrong:
        log.warning("columns of %s without their hinted type: %s", table, ", ".join(wrong))
        kinds.update(_inferred(raw, wrong))
        seen = _write_observed(raw, kinds, target)
    if seen["bad"]:
        write_table(quarantined(raw), aside)
    else:
        files.remove(spark, aside)
    before, after = files.size(spark, csv_path), files.size(spark, target)
    mb = 1024.0 * 1024.0
    saved = (1 - after / before) * 100 if before > 0 else 0.0
    return (
        table, True, seen["rows"], seen["bad"], len(names), before / mb, after / mb, saved, None
    )


def convert_all(spark: SparkSession, raw: str, lake: str) -> DataFrame:
    """Every ``*.csv`` in name order; one bad file does not stop the others.

    One row of statistics per file.
    """
    rows = []
    for path in files.glob(spark, f"{raw}/*.csv"):
        try:
            rows.append(convert_csv(spark, path, lake))
        except Exception as problem:  # noqa: BLE001 - reported per table
            log.error("cannot convert %s: %s", path, problem)
            rows.append((files.stem(path), False, *[None] * 6, str(problem)))
    if not rows:
        log.warning("no CSV files in %s", raw)
    return spark.createDataFrame(rows, STATS)
