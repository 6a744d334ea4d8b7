from collections import Counter

from helpers import SCHEMA, WORD, documents, empty, prose, rows
from pyspark.sql import functions as F

from paddock.llm import quality_rules


def base(text):
    text = text or ""
    words = WORD.findall(text)
    seen = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = set()
    for k in range(len(words) - 4):
        if seen[tuple(words[k : k + 5])] > 1:
            covered.update(range(k, k + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
        len(covered), len(words) < 10 or 100 * len(covered) > 20 * len(words),
    )


def test_base_counts(spark):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    found = quality_rules.judge(documents(spark)).select("doc_id", *names, "kept").collect()
    assert Counter(tuple(r)[:7] for r in found) == Counter((r[0], *base(r[1])) for r in rows())
    assert not [r for r in found if r["base_failed"] and r["kept"]]


def test_buckets_hold_their_values(spark):
    values = spark.range(0, 5000).union(spark.range(10**12, 10**12 + 50)).withColumn("b", quality_rules.bucket(F.col("id")))
    top = values.withColumn("top", quality_rules.top_of(F.col("b"))).collect()
    assert all(r["id"] <= r["top"] <= r["id"] * (1 + 1 / 32) + 1 for r in top)
    assert [r["b"] for r in top] == sorted(r["b"] for r in top)


def test_sketches_merge(spark):
    measured = quality_rules.materialize(quality_rules.measured(documents(spark)), "measured")
    parts = [quality_rules.sketch(measured.where(f"n_words % 2 = {k}")) for k in (0, 1)]
    merged = parts[0].union(parts[1]).groupBy("lang", "source", "rate", "bucket").agg(F.sum("n").alias("n"))
    assert merged.exceptAll(quality_rules.sketch(measured)).count() == 0


def test_limits_follow_the_source(spark):
    plain = [(i, prose(i, 60), "en", "plain", *[None] * 5) for i in range(80)]
    code = [(1000 + i, prose(i, 60).replace(" ", " | "), "en", "tables", *[None] * 5) for i in range(80)]
    odd = [(2000, prose(7, 60).replace(" ", " | "), "en", "plain", *[None] * 5)]
    found = quality_rules.judge(spark.createDataFrame(plain + code + odd, SCHEMA))
    kept = {r["doc_id"] for r in found.where("kept").collect()}
    assert 2000 not in kept
    assert sum(i in kept for i in range(80)) >= 76
    assert sum(1000 + i in kept for i in range(80)) >= 76


def test_limits_move_smoothly_with_the_rows(spark):
    """From one row to many the limit of a group leaves that of its language in small steps."""

    def limit(n):
        # the language's quartiles are 0, its limit is 60; the group's own limit is 40 + 60
        rows = [("en", "own", "symbol_rate", 40, n), ("en", "other", "symbol_rate", 0, 10**6)]
        sketched = spark.createDataFrame(rows, "lang string, source string, rate string, bucket int, n long")
        return quality_rules.limits(sketched).where("source_2 = 'own'").first()["symbol_rate_max"]

    found = [limit(n) for n in (1, 5, 10, 20, 48, 49, 50, 51, 100, 10_000)]
    assert found == sorted(found) and found[0] < 65 and found[-1] >= 99
    assert max(found[4:8]) - min(found[4:8]) <= 1


def test_rows_stay_whole(spark):
    docs = documents(spark)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert kept.count() == quality_rules.judge(docs).where("kept").count() > 0


def test_empty(spark):
    assert quality_rules.judge(empty(spark)).count() == 0
    assert quality_rules.keep_good(empty(spark)).count() == 0
