"""Sampling sources to target weights by Poisson replication.

Each source has a rate: how often one of its documents appears on average.  A document's
own number of appearances is Poisson distributed with that mean, found by inverting the
distribution at a number in [0, 1) hashed from a seed and the document's id.  Documents
are repeated that often and put into one global random order.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

SEED = "mix-1"
FLATTEN = 0.5  # weight of a source: its rows to this power
_BITS = 52  # of the hash that become a number in [0, 1)


def uniform(key: Column) -> Column:
    """A number in [0, 1) from 52 bits of an MD5 digest, the same on every engine."""
    return F.conv(F.substring(F.md5(key), 1, _BITS // 4), 16, 10).cast("double") / float(1 << _BITS)


def rates(
    docs: DataFrame, total: float | None = None, weights: Mapping[str, float] | None = None
) -> DataFrame:
    """source, rows and rate of every source, from all rows.

    ``total`` is the expected number of rows of the mix, by default that of the input.
    Without ``weights`` a source weighs the square root of its rows.  Sources that
    ``weights`` does not name get none.
    """
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
    if weights is None:
        weighed = counts.withColumn("weight", F.pow(F.col("rows").cast("double"), F.lit(FLATTEN)))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("source") == name, float(value)).otherwise(weight)
        weighed = counts.withColumn("weight", weight)
    stored = materialize(weighed, "source_weights")
    sums = stored.agg(F.sum("weight").alias("weight"), F.sum("rows").alias("rows")).first()
    wanted = (sums["rows"] or 0) if total is None else total
    share = wanted / sums["weight"] if sums["weight"] else 0.0
    return stored.select("source", "rows", (F.col("weight") * share / F.col("rows")).alias("rate"))


def distribution(rate: Column) -> Column:
    """Cumulative Poisson probabilities of 0, 1, 2, ... until the rest is below 1e-13."""
    longest = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")
    # exp(-rate) times 1, rate, rate^2/2, ... by logarithms, so that large rates do not underflow
    log = F.when(rate > 0, F.ln(rate))
    terms = F.transform(
        F.sequence(F.lit(0), longest),
        lambda k: F.exp(k * log - rate - F.aggregate(
            F.when(k > 0, F.sequence(F.lit(1), k)).otherwise(F.array().cast("array<int>")),
            F.lit(0.0), lambda s, i: s + F.ln(i.cast("double")))),
    )
    sums = F.aggregate(
        terms,
        F.array().cast("array<double>"),
        lambda done, p: F.concat(done, F.array(F.coalesce(F.get(done, F.size(done) - 1), F.lit(0.0)) + p)),
    )
    return F.when(rate > 0, sums).otherwise(F.array(F.lit(1.0)))


def mix(
    docs: DataFrame,
    total: float | None = None,
    weights: Mapping[str, float] | None = None,
    seed: str = SEED,
    id_col: str = "doc_id",
) -> DataFrame:
    """``row``, id, source, rate, n_copies, copy (from 1) and order, sorted by order.

    Every row of the input comes as often as drawn, in the struct ``row``.  A null source
    is a source of its own.  Rows with the same id are drawn alike, and null ids share
    one draw.  The order depends on seed, id and copy only.  An empty table gives no rows.

    The table of sources joins by Spark's own size check; the sort-merge join that a long
    one needs leaves hot sources to adaptive execution.
    """
    by_source = rates(docs, total, weights)
    cumulative = materialize(
        by_source.select(F.col("source").alias("of"), "rate", distribution(F.col("rate")).alias("upto")),
        "poisson",
    )
    given = docs.select(F.struct("*").alias("row"), docs[id_col].alias("id"), docs["source"].alias("source"))

    def hashed(*parts: Column) -> Column:
        return F.concat_ws(":", F.lit(seed), *[p.cast("string") for p in parts])

    drawn = given.withColumn("drawn", uniform(hashed(F.col("id")))).join(
        cumulative, F.col("source").eqNullSafe(F.col("of"))
    )
    counted = drawn.withColumn("n_copies", F.size(F.filter("upto", lambda p: p <= F.col("drawn"))))
    copies = counted.where("n_copies > 0").select(
        "row", "id", "source", "rate", "n_copies", F.explode(F.sequence(F.lit(1), F.col("n_copies"))).alias("copy")
    )
    order = F.md5(hashed(F.lit("order"), F.col("id"), F.col("copy")))
    # MD5 digests are uniform, so range partitions by them are even whatever the source
    return copies.withColumn("order", order).sort("order")
