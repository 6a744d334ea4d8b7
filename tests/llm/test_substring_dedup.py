import random

import numpy as np
import pytest
from helpers import SCHEMA, documents, empty, prose, rows

from paddock.llm import substring_dedup


def slow_cuts(data, mean):
    """The rolling hash a byte at a time."""
    ends = []
    for i in range(len(data)):
        total = 0
        for back in range(substring_dedup._SPAN):
            if i - back >= 0:
                total += int(substring_dedup._GEAR[data[i - back]]) << back
        if (total & 0xFFFFFFFF) >> 8 < (1 << 24) // mean:
            ends.append(i + 1)
    ends = [e for e in ends if e < len(data) and (data[e] & 0xC0) != 0x80]
    return [*ends, len(data)] if data else []


def brute(data, mean, min_words):
    """Passages as (id, start, end), rows in the order of their ids."""
    seen, out = set(), []
    for i, text in data:
        raw = (text or "").encode()
        ends = slow_cuts(raw, mean)
        start, run = 0, []
        for end in [*ends, None]:
            chunk = None if end is None else raw[start:end]
            if chunk is not None and chunk in seen:
                run.append((start, end))
            else:
                if run:
                    out.append((i, run[0][0], run[-1][1]))
                run = []
                seen.add(chunk)
            start = end

    def words(i, a, b):
        raw = (dict(data)[i] or "").encode()
        space = b" \t\n\x0b\x0c\r"
        return sum(raw[k] not in space and (k == 0 or raw[k - 1] in space) for k in range(a, b))

    return sorted(x for x in out if words(*x) >= min_words)


def test_like_brute_force(spark):
    data = [(r[0], r[1]) for r in rows()[:-3]]
    docs = spark.createDataFrame([(*d, *[None] * 7) for d in data], SCHEMA).repartition(4)
    found = substring_dedup.passages(docs, min_words=6).collect()
    assert sorted((r["id"], r["start"], r["end"]) for r in found) == brute(data, substring_dedup.MEAN, 6)


def test_pieces_of_long_texts_agree(monkeypatch):
    data = prose(5, 3000).encode()
    whole = substring_dedup.cuts(data)
    monkeypatch.setattr(substring_dedup, "_BATCH", 777)
    assert np.array_equal(whole, substring_dedup.cuts(data))
    assert 25 < np.diff(whole).mean() < 60


def test_inserted_passages_are_found(spark):
    r = random.Random(9)
    passage = prose(77, 60)
    texts = []
    for k in range(40):
        words = prose(1000 + k, 300).split(" ")
        at = r.randint(1, 299)
        texts.append(" ".join([*words[:at], *([passage] if k % 4 == 0 else []), *words[at:]]))
    docs = spark.createDataFrame([(i, t, *[None] * 7) for i, t in enumerate(texts)], SCHEMA)
    found = substring_dedup.passages(docs).collect()
    assert {x["id"] for x in found} == set(range(4, 40, 4))
    assert all(x["first_ids"] == [0] for x in found)
    cut = {x["doc_id"]: x["text"] for x in substring_dedup.drop_passages(docs).collect()}
    assert cut[0] == texts[0] and cut[1] == texts[1]
    assert all(len(texts[k]) - len(cut[k]) > len(passage) / 2 for k in range(4, 40, 4))


def test_cut_texts_are_what_the_spans_leave(spark):
    docs = documents(spark)
    assert substring_dedup.drop_passages(docs).columns == docs.columns
    once = docs.where("doc_id < 30").dropDuplicates(["doc_id"]).cache()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in once.collect()}
    spans = {}
    for p in substring_dedup.passages(once).collect():
        spans.setdefault(p["id"], []).append((p["start"], p["end"]))
    assert spans
    for r in substring_dedup.drop_passages(once).collect():
        raw, at, left = texts[r["doc_id"]], 0, b""
        for a, b in sorted(spans.get(r["doc_id"], [])):
            left, at = left + raw[at:a], b
        assert (r["text"] or "") == (left + raw[at:]).decode()


@pytest.mark.parametrize("text", ["", "é", "日本" * 50, "\x00\x00 \x00"])
def test_cuts_like_the_slow_way(text):
    data = text.encode()
    assert substring_dedup.cuts(data, 4).tolist() == slow_cuts(data, 4)


def test_empty(spark):
    assert substring_dedup.passages(empty(spark)).count() == 0
    assert substring_dedup.drop_passages(empty(spark)).count() == 0


def placed(passages, seed=3):
    """Texts that hold each passage twice, and where the later one and what surrounds it agree."""
    r, texts, spans = random.Random(seed), [], []
    for k, passage in enumerate(passages):
        pair = []
        for side in range(2):
            before, after = (prose(10_000 + 4 * k + 2 * side + j, r.randint(1, 60)) + " " * j for j in range(2))
            pair.append(((before + " ").encode(), passage.encode(), (" " + after).encode()))
        texts += [b"".join(x).decode() for x in pair]
        (b0, p, a0), (b1, _, a1) = pair
        left = next(n for n in range(min(len(b0), len(b1)) + 1) if b0[-n - 1 : -n or None] != b1[-n - 1 : -n or None])
        right = next(n for n in range(min(len(a0), len(a1)) + 1) if a0[n : n + 1] != a1[n : n + 1])
        while (b1[len(b1) - left] if left else 0) & 0xC0 == 0x80:
            left -= 1
        while right and a1[right] & 0xC0 == 0x80:
            right -= 1
        spans.append((2 * k + 1, len(b1) - left, len(b1) + len(p) + right))
    return texts, spans


def test_no_passage_of_51_words_is_lost(spark):
    r = random.Random(5)
    passages = [prose(50_000 + k, r.choice([51, 52, 60, 100])) for k in range(400)]
    passages += [" ".join(r.choices("abcdefghij", k=51)) for _ in range(100)]
    texts, spans = placed(passages)
    docs = spark.createDataFrame([(i, t, *[None] * 7) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    found = substring_dedup.repeats(docs).collect()
    assert sorted((x["id"], x["start"], x["end"]) for x in found) == sorted(spans)
    for x in found:
        raw = texts[x["id"]].encode()
        begun = [k for k in range(x["start"], x["end"]) if raw[k] != 32 and (k == 0 or raw[k - 1] == 32)]
        assert x["n_words"] == len(begun) and x["first_ids"] == [x["id"] - 1]


@pytest.mark.parametrize("unit", ["a ", "ha ho ", "日本 ", "0123456789 " * 5, "x" * 30 + " "])
def test_periodic_passages_are_found(spark, unit):
    passage = (unit * 2000)[: 60 * len(unit)].strip()
    texts, _ = placed([passage])
    docs = spark.createDataFrame([(i, t, *[None] * 7) for i, t in enumerate(texts)], SCHEMA)
    [found] = [x for x in substring_dedup.repeats(docs).collect() if x["id"] == 1]
    start = texts[1].encode().index(passage.encode())
    # equal places of a period cannot be told apart, so less than a period may stay at the start
    assert found["start"] < start + len(unit.encode()) and found["end"] >= start + len(passage.encode())


def test_long_equal_stretches_share_an_anchor(monkeypatch):
    r = random.Random(2)
    length = substring_dedup.ANCHOR + substring_dedup.WINDOW - 1
    for alphabet in ("ab", "abcdefgh ", "a", "é日 x"):
        for _ in range(200):
            same = "".join(r.choices(alphabet, k=r.randint(1, 9)))
            same = (same * length)[: length * 2].encode()[: length + 3].decode(errors="ignore").encode()
            one, two = (
                "".join(r.choices(alphabet, k=r.randint(0, 200))).encode() + same
                + "".join(r.choices(alphabet, k=r.randint(0, 200))).encode() for _ in range(2)
            )
            sets = [{t[p : p + n] for p, n in substring_dedup.anchors(t)} for t in (one, two)]
            assert sets[0] & sets[1]
    data = (prose(5, 3000) + "a" * 3000).encode()
    whole = substring_dedup.anchors(data)
    monkeypatch.setattr(substring_dedup, "_BATCH", 777)
    assert whole == substring_dedup.anchors(data)
    assert max(b[0] - a[0] for a, b in zip(whole, whole[1:], strict=False)) <= substring_dedup.WINDOW


def test_repeats_of_nothing(spark):
    assert substring_dedup.repeats(empty(spark)).count() == 0


def test_both_ends_of_a_repeat_are_cut(spark):
    texts, spans = placed([prose(70_000 + k, 51 + k) for k in range(20)])
    docs = spark.createDataFrame([(i, t, *[None] * 7) for i, t in enumerate(texts)], SCHEMA)
    cut = {x["doc_id"]: x["text"] for x in substring_dedup.drop_repeats(docs).collect()}
    expected = dict(enumerate(texts))
    for i, start, end in spans:
        raw = texts[i].encode()
        expected[i] = (raw[:start] + raw[end:]).decode()
    assert cut == expected


def slow_anchors(data):
    """The anchors of a text, one place and one window at a time."""
    size, window, n = substring_dedup.ANCHOR, substring_dedup.WINDOW, len(data)
    if n <= size:
        return [(0, n)] if n else []

    def key(p):
        gears = (int(substring_dedup._GEAR[b]) << (15 - k) for k, b in enumerate(data[p : p + 16]))
        inside = data[p] & 0xC0 == 0x80
        return (2**32 - 1 if inside else sum(gears) * 0x9E3779B1 % 2**32, p)

    keys = [key(p) for p in range(n - size + 1)]
    least = sorted({min(keys[p : p + window])[1] for p in range(max(1, len(keys) - window + 1))})
    least = [p for p in least if data[p] & 0xC0 != 0x80]
    kept = []
    for p, after in zip(least, [*least[1:], n], strict=True):
        q = p + size
        while q < n and q > p + size - 3 and data[q] & 0xC0 == 0x80:
            q -= 1
        if kept and after - kept[-1][0] <= window and data[p:q] == data[kept[-1][0] : sum(kept[-1])]:
            continue
        kept.append((p, q - p))
    return kept


def test_texts_are_hashed_together(monkeypatch):
    r, texts = random.Random(4), []
    for alphabet in ("ab", "a", "abcdefgh ", "é日 x", "𝒳é日"):
        for size in (0, 1, 20, 55, 56, 57, 60, 101, 102, 103, 400):
            text = "".join(r.choices(alphabet, k=size))
            texts += [text.encode(), (text[:7] * 40).encode()]
    r.shuffle(texts)
    calls, hashed = [], substring_dedup.rolling
    monkeypatch.setattr(substring_dedup, "rolling", lambda raw: calls.append(len(raw)) or hashed(raw))
    substring_dedup.anchors_of([prose(k, 60).encode() for k in range(500)])
    assert len(calls) <= 1 + sum(calls) // substring_dedup._SLICE
    expected = [(i, *x) for i, t in enumerate(texts) for x in slow_anchors(t)]
    for length in (substring_dedup._SLICE, 777):
        monkeypatch.setattr(substring_dedup, "_SLICE", length)
        text, at, size, digest, check = (x.tolist() for x in substring_dedup.anchors_of(texts))
        assert list(zip(text, at, size, strict=True)) == expected
        named = {(texts[i][p : p + n], d, c) for i, p, n, d, c in zip(text, at, size, digest, check, strict=True)}
        assert len(named) == len({x[0] for x in named}) == len({x[1] for x in named}) == len({x[2] for x in named})
