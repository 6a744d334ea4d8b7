"""Exact duplicates by a tree merge of sorted digest runs.

Every input partition is a run: one row for each distinct digest in it, with the row
that should stay and the number of copies.  Rounds merge ``FAN_IN`` neighbouring runs
each, as in a binomial tree, until one run (spread over all tasks by digest) is left.
A digest held by a third of all rows therefore never meets more than ``FAN_IN`` rows in
one group.  The answers go down the same tree.

Two texts are the same when SHA-256, a 64-bit hash and the length of the normalised
text all agree; every merge groups by all three, so one digest alone never decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, identified, materialize, run_of

FAN_IN = 16
KEY = ("digest", "check", "size")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """tag, id, chars, the three parts of the key, and the row itself in ``row``.

    A null text counts as empty.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    normal = F.translate(text, SPACE, "")
    return identified(
        docs,
        id=docs[id_col],
        chars=F.length(text),
        digest=F.unhex(F.sha2(normal, 256)),
        check=F.xxhash64(normal),
        size=F.length(normal),
        row=F.struct("*"),
    )


def _merged(rows: DataFrame) -> DataFrame:
    return rows.groupBy("run", *KEY).agg(F.min("best").alias("best"), F.sum("n").alias("n"))


def merge_runs(rows: DataFrame, fan_in: int = FAN_IN) -> list[DataFrame]:
    """Stored levels of the tree over ``digests()`` rows, from single runs to the root."""
    if fan_in < 2:
        raise ValueError("fan_in is at least 2")
    best = F.struct(-F.col("chars"), F.col("id").isNull(), F.col("id"), F.col("tag"))
    single = rows.select(
        run_of(F.col("tag")).alias("run"), *KEY, best.alias("best"), F.lit(1).cast("long").alias("n")
    )
    levels = [materialize(_merged(single), "digest_run")]
    runs = 1 + (levels[0].agg(F.max("run")).first()[0] or 0)
    while runs > 1:
        parents = levels[-1].withColumn("run", F.floor(F.col("run") / fan_in))
        levels.append(materialize(_merged(parents), "digest_run"))
        runs = -(-runs // fan_in)
    return levels


def assign(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = FAN_IN
) -> DataFrame:
    """tag, id, keep_id, group_size, kept and digest (binary) of every row.

    Of equal texts the one with the most characters stays, then the smallest id; a null
    id comes last, and of rows equal in both the first one stays, so that a group keeps
    exactly one row.  Null and empty texts are equal.  An empty table gives no rows.
    """
    return assign_rows(materialize(digests(docs, id_col, text_col).drop("row"), "digests"), fan_in)


def assign_rows(rows: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """``assign`` for a stored table with the columns of ``digests()``."""
    levels = merge_runs(rows, fan_in)
    answer = levels[-1]
    for level in reversed(levels[:-1]):
        down = level.select("run", *KEY).withColumn("parent", F.floor(F.col("run") / fan_in))
        answer = down.join(answer.withColumnRenamed("run", "parent"), ["parent", *KEY]).drop("parent")
    found = rows.withColumn("run", run_of(F.col("tag"))).join(answer, ["run", *KEY])
    return found.select(
        "tag",
        "id",
        F.col("best.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("best.tag") == F.col("tag")).alias("kept"),
        "digest",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    stored = materialize(digests(docs, id_col, text_col), "documents")
    kept = assign_rows(stored).where("kept").select("tag")
    return stored.select("tag", "row").join(kept, "tag", "left_semi").select("row.*")
