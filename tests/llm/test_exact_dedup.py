import hashlib
import re
from collections import Counter, defaultdict

import pytest
from helpers import SCHEMA, documents, empty, rows

from paddock.llm import exact_dedup


def brute(data):
    groups = defaultdict(list)
    for i, text in [(r[0], r[1] or "") for r in data]:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text)].append((-len(text), i is None, i or 0, i))
    out = Counter()
    for key, members in groups.items():
        best = min(members, key=lambda m: m[:3])
        for m in members:
            out[m[3], best[3], len(members), hashlib.sha256(key.encode()).hexdigest()] += 1
    return out, len(groups)


@pytest.mark.parametrize("fan_in", [2, 3, 16])
def test_like_brute_force(spark, fan_in):
    found = exact_dedup.assign(documents(spark, 9), fan_in=fan_in).collect()
    want, groups = brute(rows())
    assert Counter((r["id"], r["keep_id"], r["group_size"], r["digest"].hex()) for r in found) == want
    kept = [r for r in found if r["kept"]]
    assert len(kept) == groups
    assert all(r["id"] == r["keep_id"] for r in kept)


def test_levels_end_in_one_run(spark):
    docs = documents(spark, 9)
    levels = exact_dedup.merge_runs(
        exact_dedup.materialize(exact_dedup.digests(docs).drop("row"), "digests"), fan_in=2
    )
    assert levels[-1].select("run").distinct().count() == 1
    assert levels[-1].count() == brute(rows())[1]


def test_rows_stay_whole(spark):
    kept = exact_dedup.drop_copies(documents(spark))
    assert kept.schema.simpleString() == documents(spark).schema.simpleString()
    assert kept.count() == brute(rows())[1]


def test_empty(spark):
    assert exact_dedup.assign(empty(spark)).count() == 0
    assert exact_dedup.drop_copies(empty(spark)).count() == 0


def test_hot_copy(spark):
    data = [(i, "same" if i % 3 else f"text {i}", *[None] * 7) for i in range(300)]
    found = exact_dedup.assign(spark.createDataFrame(data, SCHEMA).repartition(20), fan_in=4)
    assert found.where("group_size = 200 and keep_id = 1").count() == 200
