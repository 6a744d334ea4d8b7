"""The corpus pipeline against its stages done one after the other in plain Python."""

import sys
from collections import Counter
from pathlib import Path

import pytest
from helpers import WORD, prose
from test_minhash_dedup import brute

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents():
    rows = []
    for i in range(60):
        text = prose(i, 40 + i)
        rows.append((i, text, "en", "big" if i % 3 else f"s{i % 4}", len(text)))
    rows += [(100 + i, rows[i][1].replace(" ", "\n"), *rows[i][2:]) for i in range(5)]  # exact copies
    rows += [(200 + i, rows[i][1] + " one more", *rows[i][2:]) for i in range(10, 20)]  # near copies
    rows += [(300 + i, rows[i][1].replace(" ", "*** "), *rows[i][2:]) for i in range(30, 33)]  # symbols
    rows += [(400, None, "en", "big", None), (401, "", None, None, 0), (402, "too short", "en", "big", 9)]
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(documents(), SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def kept(spark, folder):
    """What each stage leaves."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, folder), name.replace(" ", "_"))
        out.append(docs)
    return out


def test_stages_keep_the_columns_of_documents(kept):
    for docs in kept[:-1]:
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_each_stage_does_its_part(kept):
    ids = [sorted(r["doc_id"] for r in docs.collect()) for docs in kept[:3]]
    # symbols and texts of under ten words go, clean documents stay
    assert ids[0] == [*range(60), *range(100, 105), *range(210, 220)]
    # of an exact copy and its source the smaller id stays
    assert ids[1] == [*range(60), *range(210, 220)]
    text = {r[0]: r[1] for r in documents()}
    root, _ = brute([text[i] for i in ids[1]], 5)
    assert ids[2] == [ids[1][k] for k in sorted(set(root))]
    assert set(ids[1]) - set(ids[2]) == set(range(210, 220))


def test_mixed_documents_are_all_packed(kept):
    mixed, packed = (docs.collect() for docs in kept[3:])
    want, got = Counter(), Counter()
    for r in mixed:
        want[r["doc_id"]] += len(WORD.findall(r["text"]))
    for r in packed:
        got[r["doc_id"]] += r["n_words"]
    assert got == want and len(want) > 20


def test_run_is_the_stages_in_turn(spark, folder, kept):
    columns = sorted(kept[-1].columns)
    got, want = (Counter(map(tuple, df.select(*columns).collect())) for df in (corpus_pipeline.run(spark, folder), kept[-1]))
    # bins may differ with the order in which rows of the same id arrive, their words not
    place = [columns.index(c) for c in ("doc_id", "n_words", "first_word")]
    short = lambda rows: Counter(tuple(r[p] for p in place) for r in rows.elements())
    assert short(got) == short(want)
