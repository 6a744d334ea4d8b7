import math
import re
from collections import Counter

import pytest
from helpers import documents, empty, prose, rows

from paddock.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def found(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    """(item, rank, doc, score); docs and items are (id, text)."""
    counts = [(i, Counter(found(t))) for i, t in docs if found(t)]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for row, (i, c) in enumerate(counts):
            m = 25 + 75 * sum(c.values()) * n_docs // n_terms
            score = 0
            for t in found(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
            if score:
                scored.append((-score, i is None, i, row))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, r, s[2], -s[0]) for r, s in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def items():
    texts = [r[1] for r in rows()[:6]]
    asked = [(i, t) for i, t in enumerate(texts)]
    asked += [(20, None), (21, ""), (22, "?! --"), (23, "one ONE one"), (23, "here same again"), (None, "other line"), (24, prose(1, 400)), (25, "  ß é")]
    return asked


def result(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("shard,block", [(4096, 256), (7, 3)])
def test_like_brute_force(spark, shard, block):
    docs = documents(spark)
    asked = spark.createDataFrame([(i, t, 1, "x") for i, t in items()], "item_id long, text string, tag int, id string").repartition(3)
    got = result(lexical_search.search(docs, asked, shard=shard, block=block))
    want = brute([(r[0], r[1]) for r in rows()], items())
    assert got == want


def test_small_k_and_pruning(spark):
    # rare terms fill the ranks first, common ones decide between equal scores
    data = [(i, f"rare{i % 5} " + "common often " * (1 + i % 3) + prose(i, 5)) for i in range(300)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    asked = [(1, "rare1 common"), (2, "common often common"), (3, "rare2 rare3 often"), (4, "absent")]
    got = result(lexical_search.search(docs, spark.createDataFrame(asked, "item_id long, text string"), k=3, shard=16))
    assert got == brute(data, asked, k=3)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert lexical_search.search(empty(spark), none).count() == 0
    assert lexical_search.search(documents(spark), none).count() == 0
    some = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert lexical_search.search(empty(spark), some).count() == 0


def test_terms():
    text = "A-b_C9 éÉ x\x7fy\x00z"
    assert [t.decode() for t in lexical_search.terms(text)] == found(text) == ["a", "b", "c9", "éÉ x", "y", "z"]
