import hashlib
import math
from collections import Counter

import pytest
from helpers import SCHEMA, documents, empty, rows

from paddock.llm import source_mix


def drawn(i, rate):
    u = int(hashlib.md5(":".join([source_mix.SEED] + [str(i)] * (i is not None)).encode()).hexdigest()[:13], 16) / 2**52
    k, total = 0, math.exp(-rate)
    while total <= u and k < 500:
        k += 1
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
    return k


def test_like_brute_force(spark):
    data = rows()
    sizes = Counter(r[3] for r in data)
    unit = len(data) / sum(n**0.5 for n in sizes.values())
    want = Counter()
    for r in data:
        for copy in range(1, drawn(r[0], unit * sizes[r[3]] ** -0.5) + 1):
            want[r[0], r[3], copy] += 1
    found = source_mix.mix(documents(spark)).collect()
    assert Counter((r["id"], r["source"], r["copy"]) for r in found) == want
    assert [r["order"] for r in found] == sorted(r["order"] for r in found)


def test_rates_reach_the_weights(spark):
    data = [(i, "x", None, "big" if i % 4 else "small", *[None] * 5) for i in range(8000)]
    docs = spark.createDataFrame(data, SCHEMA)
    found = source_mix.mix(docs, total=10_000, weights={"big": 0.5, "small": 0.5})
    got = {r["source"]: r["count"] for r in found.groupBy("source").count().collect()}
    assert got == {"big": pytest.approx(5000, rel=0.06), "small": pytest.approx(5000, rel=0.06)}
    counts = [r["n"] for r in found.where("source = 'small'").groupBy("id").count().withColumnRenamed("count", "n").collect()]
    assert max(counts) >= 6  # 2,000 draws with mean 2.5
    none = source_mix.mix(docs, weights={"small": 1.0})
    assert none.where("source = 'big'").count() == 0


def test_large_rates_do_not_underflow(spark):
    docs = spark.createDataFrame([(i, "x", None, "a", *[None] * 5) for i in range(40)], SCHEMA)
    found = source_mix.mix(docs, total=40 * 900)
    assert found.count() == pytest.approx(36_000, rel=0.02)


def test_rows_stay_whole(spark):
    docs = documents(spark)
    assert source_mix.mix(docs).select("row.*").columns == docs.columns


def test_empty(spark):
    assert source_mix.mix(empty(spark)).count() == 0
    nothing = source_mix.mix(documents(spark), weights={})
    assert nothing.count() == 0
