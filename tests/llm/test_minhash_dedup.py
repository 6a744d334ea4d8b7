import random

import numpy as np
import pytest
from helpers import SCHEMA, documents, empty, prose, rows

from paddock.llm import components, minhash_dedup


def shingle_set(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    n = max(1, len(words) - width + 1)
    return frozenset(tuple(words[k : k + width]) for k in range(n))


def brute(texts, width, percent=80):
    """Smallest row number reachable, for every row."""
    sets = [shingle_set(t, width) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


@pytest.mark.parametrize("width", [2, 5])
def test_like_brute_force(spark, width):
    data = rows()
    found = minhash_dedup.cluster(documents(spark), width=width).collect()
    root, sizes = brute([r[1] for r in data], width)
    ids = [r[0] for r in data]
    # the smallest id of each component, nulls last; texts without words stand alone
    group = {}
    for i, r in enumerate(root):
        group.setdefault(r, []).append(i)
    want = []
    for members in group.values():
        known = [ids[m] for m in members if ids[m] is not None]
        for m in members:
            least = (min(known) if known else None) if sizes[m] else ids[m]
            want.append((ids[m], sizes[m], least))
    key = lambda r: tuple(map(str, r))
    assert sorted([(r["id"], r["n_shingles"], r["component_id"]) for r in found], key=key) == sorted(want, key=key)
    assert sum(r["kept"] for r in found) == len(group)


def family(r, base, n, changes):
    """Copies of a text with some words exchanged, each its own way."""
    out = []
    for _ in range(n):
        words = list(base)
        for k in r.sample(range(len(words)), changes):
            words[k] = f"x{r.random()}"
        out.append(" ".join(words))
    return out


def test_copies_that_only_their_source_joins(spark):
    """Copies are similar to the source, not to each other; chains and strangers come along."""
    r = random.Random(3)
    base = prose(1, 120).split(" ")
    texts = family(r, base, 60, 6) + [" ".join(base)] + family(r, prose(2, 120).split(" "), 40, 10)
    chain = prose(4, 100).split(" ")
    for _ in range(25):
        chain = chain[4:] + [f"y{r.random()}" for _ in range(4)]
        texts.append(" ".join(chain))
    root, _ = brute(texts, 2)
    assert len(set(root)) < len(texts) - 60
    docs = spark.createDataFrame([(i, t, *[None] * 7) for i, t in enumerate(texts)], SCHEMA).repartition(4)
    found = {x["id"]: x["component_id"] for x in minhash_dedup.cluster(docs, width=2).collect()}
    assert [found[i] for i in range(len(texts))] == root


def test_signatures_estimate_similarity():
    r = np.random.default_rng(1)
    shared, one, two = (np.unique(r.integers(0, 2**63, 3000).astype(np.uint64)) for _ in range(3))
    a, b = np.union1d(shared, one[:400]), np.union1d(shared, two[:400])
    found = minhash_dedup.signatures([a, b], 512)
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((found[0] == found[1]).mean() - true) < 0.06


def test_components(spark):
    links = [(k, k + 1) for k in range(0, 30)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3), (500, 400)]
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    want = {k: 0 for k in range(1, 31)} | {k: 100 for k in range(101, 140)} | {500: 400}
    assert {r["node"]: r["to"] for r in found} == want and len(found) == len(want)


def test_rows_stay_whole(spark):
    docs = documents(spark)
    kept = minhash_dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert kept.count() == minhash_dedup.cluster(docs).where("kept").count()


def test_empty(spark):
    assert minhash_dedup.cluster(empty(spark)).count() == 0
    assert minhash_dedup.drop_near_copies(empty(spark)).count() == 0


def test_confirmed_links_are_named_so(spark):
    columns = minhash_dedup.cluster(empty(spark)).columns
    assert "n_confirmed_links" in columns and "n_links" not in columns


def test_one_family_of_5000_copies(spark):
    """Each copy with some words changed its own way: many are linked by other copies only."""
    r = random.Random(12)
    base = prose(8, 40).split(" ")
    texts = [t for changes in (1, 2, 3, 4, 5) for t in family(r, base, 1000, changes)]
    sets = [sorted(shingle_set(t, 2)) for t in texts]
    sizes, postings = np.array([len(s) for s in sets]), {}
    for i, s in enumerate(sets):
        for token in s:
            postings.setdefault(token, []).append(i)
    postings = {token: np.array(rows) for token, rows in postings.items()}
    root = np.arange(len(texts))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        common = np.bincount(np.concatenate([postings[t] for t in s]), minlength=len(sets))
        for j in np.flatnonzero(100 * common >= 80 * (sizes + sizes[i] - common)).tolist():
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    want = [find(i) for i in range(len(texts))]
    assert 1000 < len(set(want)) < 4000
    docs = spark.createDataFrame([(i, t, *[None] * 7) for i, t in enumerate(texts)], SCHEMA).repartition(6)
    found = {x["id"]: x["component_id"] for x in minhash_dedup.cluster(docs, width=2).collect()}
    assert [found[i] for i in range(len(texts))] == want
