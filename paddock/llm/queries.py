"""The operators as registered queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.scratch import materialize, new_path

from . import (
    exact_dedup,
    hard_negatives,
    lexical_search,
    minhash_dedup,
    ngram_join,
    packing,
    quality_classifier,
    quality_rules,
    secret_scan,
    source_mix,
    substring_dedup,
    url_filter,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SPAM_LABELS = ("casino", "win", "pills", "poker", "loan", "bet")


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Which of equal texts stays."""
    found = exact_dedup.assign(_table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


@_query
def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of 15 words and more that come earlier in the corpus, to the byte."""
    found = substring_dedup.repeats(_table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("start").alias("start_byte"), F.col("end").alias("end_byte"),
        "n_words", "n_chunks", F.col("first_ids").alias("first_doc_ids"),
    )


@_query
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and the verdict by limits of each language and source."""
    return quality_rules.judge(_table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


@_query
def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written to archives and read back by byte ranges."""
    archives = new_path(spark, "warc")
    warc.write(_table(spark, folder, "pages"), archives)
    records = materialize(warc.read(spark, archives, with_payload=False), "records")

    def page(name: str):
        return F.nullif(F.split(name, ":")[2], F.lit("")).cast("long")

    return warc.resolved(records).select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )


@_query
def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learned from the labels that are not held out."""
    docs = _table(spark, folder, "documents")
    return quality_classifier.score(docs, quality_classifier.fit(docs, _table(spark, folder, "labels")))


@_query
def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Rules, then the sites of the corpus with a spam word in their name."""
    pages = _table(spark, folder, "pages")
    return url_filter.judge(pages, url_filter.sites_with(pages, SPAM_LABELS))


@_query
def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document, from a ledger that starts empty."""
    found, _ = secret_scan.scan(_table(spark, folder, "documents"))
    base = [r.name for r in secret_scan.BASE]

    def listed(spans):
        parts = F.transform(
            spans,
            lambda f: F.concat_ws(":", F.split(f["rule"], "@")[0], f["start"].cast("string"), f["end"].cast("string")),
        )
        return F.array_join(parts, ",")

    def number(name: str):
        return F.size(F.filter("found", lambda f: f["rule"] == name)).cast("long")

    return found.select(
        F.col("id").alias("doc_id"),
        *[number(r.name).alias(f"n_{r.kind}") for r in secret_scan.BASE],
        F.sha2(listed(F.filter("found", lambda f: f["rule"].isin(base))), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )


@_query
def op8_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """As many rows as documents, sources weighed by the square root of their rows."""
    mixed = source_mix.mix(_table(spark, folder, "documents"))
    return mixed.select(
        F.col("id").alias("doc_id"), "source", "n_copies", "copy", F.col("order").alias("shuffle_key"),
        F.col("row.lang").alias("lang"), F.col("row.text").alias("text"),
    )


@_query
def op9_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose two-word shingles are similar by 0.8 or more."""
    return minhash_dedup.cluster(_table(spark, folder, "documents"), width=2).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept"
    )


@_query
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Sequences of 1,024 words; one row for each piece of a document."""
    return packing.pack(_table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "shard", "bin", "slot", "piece", "first_word", "n_words", "source"
    )


@_query
def op11_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose five-word shingles are similar by 0.8 or more."""
    return ngram_join.join(_table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id"
    )


@_query
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Ten negatives for each of five positives of every hundredth vector."""
    vectors = _table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors, moved, F.col("vec_id") % 100 == 0)


@_query
def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    found = lexical_search.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select("item_id", "rank", F.col("id").alias("doc_id"), "score")
