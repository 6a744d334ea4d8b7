"""What several operators share: words, row identities, stored tables, salted joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.scratch import materialize, new_path

__all__ = ["SPACE", "SPACES", "attach", "identified", "materialize", "new_path", "run_of", "words"]

SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
# monotonically_increasing_id puts the partition above these bits
_RUN_BITS = 33


def words(text: Column) -> Column:
    """Array of the maximal runs of non-space characters; null gives an empty array."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACES)
    )


def identified(docs: DataFrame, **columns: Column) -> DataFrame:
    """``columns`` of each row with a number of its own in ``tag``.

    Identifiers of the input may be null or repeated, the tag is neither.  It depends on
    how the input is split, so the caller stores the result before using it twice.
    """
    named = [value.alias(name) for name, value in columns.items()]
    return docs.select(F.monotonically_increasing_id().alias("tag"), *named)


def run_of(tag: Column) -> Column:
    """Number of the input partition that a tag came from."""
    return F.shiftright(tag, _RUN_BITS)


def attach(many: DataFrame, one: DataFrame, keys: Sequence[str], tag: str = "tag") -> DataFrame:
    """Inner join of a table with tags to a table with unique, non-null ``keys``.

    A key may hold any share of ``many``.  It first meets ``one`` once for each input
    partition that its tags name, then spreads over the rows of that partition, so that no
    task gets more rows of a key than there are partitions, or rows in one of them.
    """
    keys = list(keys)
    salted = many.withColumn("_run", run_of(F.col(tag)))
    spread = salted.select("_run", *keys).distinct().join(one, keys)
    return salted.join(spread, ["_run", *keys]).drop("_run")
