from collections import Counter, defaultdict

import pandas as pd
from helpers import WORD, documents, empty, rows

from paddock.llm import packing


def naive(cut, capacity):
    """Best fit by looking at every open bin, in the order they reached their room."""
    bins, clock, out = [], 0, []
    many = Counter(cut["cluster"])
    for size, source, cluster in zip(cut["n_words"], cut["source"], cut["cluster"], strict=True):
        able = [
            b for b in bins if b["room"] >= size and source not in b["sources"] and cluster not in b["clusters"]
        ]
        clock += 1
        if able:
            best = min(able, key=lambda b: (b["room"], b["at"]))
        else:
            best = {"room": capacity, "sources": set(), "clusters": set(), "n": len(bins), "slots": 0}
            bins.append(best)
        best["room"] -= size
        best["at"] = clock
        best["sources"].add(source)
        if many[cluster] > 1:
            best["clusters"].add(cluster)
        out.append((best["n"], best["slots"]))
        best["slots"] += 1
    return out


def test_like_naive_best_fit():
    import random

    r = random.Random(5)
    data = pd.DataFrame(
        {
            "shard": 0,
            "tag": range(900),
            "id": [str(k) for k in range(900)],
            "source": [r.choice(["hot"] * 30 + [f"s{k}" for k in range(70)]) for _ in range(900)],
            "n_words": [r.randint(1, 260) for _ in range(900)],
            "cluster": [r.choice([r.randint(0, 40), 10_000 + k]) for k in range(900)],
        }
    )
    done = packing.pack_shard(data, 200)
    assert list(zip(done["bin"], done["slot"], strict=True)) == naive(packing.pieces(data, 200), 200)


def test_nothing_is_lost_and_limits_hold(spark):
    found = packing.pack(documents(spark), capacity=50, shard_rows=40).collect()
    want = Counter((r[0], len(WORD.findall(r[1] or ""))) for r in rows() if WORD.findall(r[1] or ""))
    words = Counter()
    for r in found:
        words[r["id"]] += r["n_words"]
    total = Counter()
    for (i, n), times in want.items():
        total[i] += n * times
    assert words == total
    bins = defaultdict(list)
    for r in found:
        bins[r["shard"], r["bin"]].append(r)
    for members in bins.values():
        assert sum(m["n_words"] for m in members) <= 50
        assert len({m["source"] for m in members}) == len(members)
        assert sorted(m["slot"] for m in members) == list(range(len(members)))
    assert len({r["shard"] for r in found}) > 1


def test_duplicates_part(spark):
    data = [(i, "same words here", None, f"s{i}", *[None] * 5) for i in range(30)]
    from helpers import SCHEMA

    found = packing.pack(spark.createDataFrame(data, SCHEMA)).collect()
    assert len({r["bin"] for r in found}) == 30


def test_empty(spark):
    assert packing.pack(empty(spark)).count() == 0
