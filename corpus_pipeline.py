"""Corpus pipeline: quality rules, exact and near duplicates, source weights, packing.

``STAGES`` are (name, function) pairs.  A function takes the session, the documents its
predecessor kept, and the folder of the tables; all but the last return documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from paddock.llm import exact_dedup, minhash_dedup, packing, quality_rules, source_mix
from paddock.scratch import materialize, reads, recorded, release

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# tables that the last stage stored on the way to its result
_held: list[str] = []


def _releasing(stage: Stage) -> Stage:
    """A stage that first deletes what the one before stored, as only its output is still read."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if not reads(docs, _held):
            release(spark, _held)
        with recorded(_held):
            return stage(spark, docs, sf_dir)

    return run_stage


@_releasing
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the limits of their language and source."""
    return quality_rules.keep_good(docs)


@_releasing
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


@_releasing
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with similar five-word shingles."""
    return minhash_dedup.drop_near_copies(docs)


@_releasing
def weigh(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out by the weights of their sources, in random order."""
    return source_mix.mix(docs).select("row.*")


@_releasing
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: one row for each piece of a document."""
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("source weights", weigh),
    ("packing", pack),
]

# The near-duplicate and packing stages are no SQL; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``, each stored and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: list[str] = []
    for name, stage in STAGES[:-1]:
        with recorded([]) as output:
            docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
        release(spark, before)
        before = output
    return STAGES[-1][1](spark, docs, sf_dir)
