import random

import numpy as np
import pytest
from helpers import SCHEMA, documents, empty, prose, rows
from test_minhash_dedup import brute, family

from paddock.llm import ngram_join
from paddock.llm.shingles import Opened


def found(spark, texts, **more):
    docs = spark.createDataFrame([(i, t, *[None] * 7) for i, t in enumerate(texts)], SCHEMA).repartition(4)
    return {x["id"]: x["component_id"] for x in ngram_join.join(docs, **more).collect()}


@pytest.mark.parametrize("width", [2, 5])
def test_like_brute_force(spark, width):
    data = rows()
    got = [(r["id"], r["n_shingles"], r["component_id"]) for r in ngram_join.join(documents(spark), width=width).collect()]
    root, sizes = brute([r[1] for r in data], width)
    ids, group, want = [r[0] for r in data], {}, []
    for i, r in enumerate(root):
        group.setdefault(r, []).append(i)
    for members in group.values():
        known = [ids[m] for m in members if ids[m] is not None]
        for m in members:
            want.append((ids[m], sizes[m], (min(known) if known else None) if sizes[m] else ids[m]))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_links_across_groups(spark, monkeypatch):
    """Families far larger than a group, chains, shared passages and members linked by one other only."""
    monkeypatch.setattr(ngram_join, "GROUP", 7)
    monkeypatch.setattr(ngram_join, "MEETINGS", 40)
    r = random.Random(5)
    base, passage = prose(1, 150).split(" "), prose(9, 60)
    texts = [t for changes in (1, 2, 3, 4, 6) for t in family(r, base, 30, changes)] + [" ".join(base)]
    texts += [passage + " " + prose(100 + k, 40 + k) for k in range(40)]
    chain = prose(4, 100).split(" ")
    for _ in range(40):
        chain = chain[3:] + [f"y{r.random()}" for _ in range(3)]
        texts.append(" ".join(chain))
    r.shuffle(texts)
    root, _ = brute(texts, 5)
    assert 60 < len(set(root)) < len(texts) - 60
    assert [v for _, v in sorted(found(spark, texts).items())] == root


def test_order_of_tokens_changes_no_result(spark, monkeypatch):
    r = random.Random(6)
    texts = [t for s in range(12) for t in family(r, prose(s, 80).split(" "), 6, 1)]
    root, _ = brute(texts, 5)
    assert len(set(root)) < len(texts)
    monkeypatch.setattr(ngram_join, "GROUP", 3)
    for sample, often, known in ((1, 2, 1 << 20), (1, 2, 5), (3, 1000, 10)):
        for name, value in (("SAMPLE", sample), ("OFTEN", often), ("KNOWN", known)):
            monkeypatch.setattr(ngram_join, name, value)
        assert [v for _, v in sorted(found(spark, texts).items())] == root


def test_first_tokens():
    one = np.arange(10, 20, dtype=np.uint64)
    none = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int32)
    assert ngram_join.first_tokens(one, none, 80).tolist() == [10, 11, 12]
    shared = np.array([10, 12], dtype=np.uint64), np.array([5, 3], dtype=np.int32)
    assert ngram_join.first_tokens(one, shared, 80).tolist() == [11, 13, 14]
    # 80 % of six are five of them: two first ones
    assert len(ngram_join.first_tokens(one[:6], none, 80)) == 2
    many = np.arange(100, dtype=np.uint64)
    assert len(ngram_join.first_tokens(many, none, 80)) == 30 and ngram_join.needed(100, 80) == 8


def test_union_bounds_what_is_opened():
    sets = [np.array(s, dtype=np.uint64) for s in ([1, 2, 3, 4, 5], [1, 2, 3, 4, 6], [7, 8])]
    block = Opened(sets)
    assert block.linked(np.array([1, 2, 3, 4, 5], dtype=np.uint64), 80).tolist() == [0]
    assert block.linked(np.array([1, 2, 3, 4], dtype=np.uint64), 80).tolist() == [0, 1]
    assert block.linked(np.array([1, 9, 10], dtype=np.uint64), 30).tolist() == []
    assert block.linked(np.array([], dtype=np.uint64), 80).tolist() == []
    assert Opened([]).linked(np.array([1], dtype=np.uint64), 80).tolist() == []


def test_empty(spark):
    assert ngram_join.join(empty(spark)).count() == 0
    assert found(spark, [None, "", " \n"]) == {0: 0, 1: 1, 2: 2}
