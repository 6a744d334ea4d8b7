"""Ranked lexical search by pipelined term partitioning.

The vocabulary of the items is dealt to owners by how common a term is, rare terms to the
first.  Documents are dealt into shards of about ``SHARD`` rows.  A bundle is an item in a
shard: it carries its weighted terms and a sparse set of document accumulators, and passes
through the owners one after the other.  Each owner is a cogroup of the bundles with the
postings of its terms: it adds integer contributions to the accumulators and sends the
bundle on.  The last one selects the best of its shard, a window the best of all.

What a bundle carries stays small without changing a result.  Later owners can add at most
``rest``, the sum of weight and largest posting value of their terms.  An accumulator that
cannot reach the k-th best of its shard with that is dropped, and no new one is begun once
``rest`` alone is below it; equal scores stay, as the identifier decides between them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import identified, materialize

K = 10
# shares of the documents up to which a term belongs to an owner; the last owner has the rest
OWNERS = (1 / 256, 1 / 32, 1 / 8)
SHARD = 4096  # documents whose accumulators meet in one task
BLOCK = 256  # items whose bundles meet in one task

_ROWS = 1 << 16  # postings sent on together
_TERM = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
# every byte of a term to itself, A-Z in lower case; the others separate terms
_FOLDED = bytes(ord(chr(b).lower()) if b < 0x80 and b in _TERM else b if b in _TERM else 0x20 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and non-ASCII characters; A-Z count as lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLDED).split() if text else []


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (tag, id, text) to postings, and one row with an empty term for each text.

    That row has the number of terms as its frequency and alone carries the id.
    """
    for batch in batches:
        rows: list[int] = []
        named: list[int | None] = []
        words: list[bytes] = []
        often: list[int] = []
        total: list[int] = []

        def flush(batch=batch):
            nonlocal rows, named, words, often, total
            out = pa.RecordBatch.from_arrays(
                [
                    batch.column("tag").take(pa.array(rows, pa.int32())),
                    batch.column("id").take(pa.array(named, pa.int32())),
                    pa.array(words, pa.binary()),
                    pa.array(often, pa.int64()),
                    pa.array(total, pa.int64()),
                ],
                names=["tag", "id", "term", "tf", "n"],
            )
            rows, named, words, often, total = [], [], [], [], []
            return out

        for i, text in enumerate(batch.column("text").to_pylist()):
            found = terms(text)
            if not found:
                continue
            counts = Counter(found)
            size = len(counts) + 1
            rows += [i] * size
            named += [i, *[None] * (size - 1)]
            words += [b"", *counts]
            often += [len(found), *counts.values()]
            total += [len(found)] * size
            if len(rows) >= _ROWS:
                yield flush()
        if rows:
            yield flush()


def _postings(rows: DataFrame) -> DataFrame:
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_counted, f"tag long, id {kind}, term binary, tf long, n long")


def _bundles(items: DataFrame, vocabulary: DataFrame, stages: int) -> DataFrame:
    """item, terms, weights, ends and rests: what an item carries through its owners."""
    each = items.where(F.length("term") > 0).join(vocabulary, "term").where("weight > 0")
    of = F.sort_array(F.collect_list(F.struct("stage", "number", (F.col("weight") * F.col("tf")).alias("weight"))))
    bundle = each.groupBy(F.col("tag").alias("item")).agg(
        of.alias("of"),
        *[F.count(F.when(F.col("stage") <= s, True)).alias(f"end{s}") for s in range(stages)],
        *[
            F.coalesce(F.sum(F.when(F.col("stage") > s, F.col("weight") * F.col("tf") * F.col("most"))), F.lit(0)).alias(f"rest{s}")
            for s in range(stages)
        ],
    )
    return bundle.select(
        "item",
        F.col("of.number").alias("terms"),
        F.col("of.weight").alias("weights"),
        F.array(*[f"end{s}" for s in range(stages)]).alias("ends"),
        F.array(*[f"rest{s}" for s in range(stages)]).alias("rests"),
        F.array().cast("array<long>").alias("docs"),
        F.array().cast("array<long>").alias("scores"),
        F.lit(0).cast("long").alias("floor"),
    )


_CARRIED = "shard long, block long, item long, terms array<long>, weights array<long>, ends array<long>, rests array<long>, docs array<long>, scores array<long>, floor long"


def _parts(column: pa.ChunkedArray) -> list[np.ndarray]:
    """Each list of a list column as an array."""
    whole = column.combine_chunks()
    values, ends = whole.flatten().to_numpy(zero_copy_only=False), np.cumsum(whole.value_lengths().to_numpy(zero_copy_only=False))
    return np.split(values, ends[:-1])


def _scored(bundles: pa.Table, postings: pa.Table, stage: int, k: int):
    """For each bundle its position, document tags and scores after ``stage``, and its floor."""
    term = postings.column("number").to_numpy()
    order = np.argsort(term, kind="stable")
    term, tags = term[order], postings.column("tag").to_numpy()[order]
    value = postings.column("value").to_numpy()[order]
    carried = {name: _parts(bundles.column(name)) for name in ("terms", "weights", "ends", "rests", "docs", "scores")}
    floors = bundles.column("floor").to_pylist()
    universe = np.unique(np.concatenate([tags, *carried["docs"]]))
    at = np.searchsorted(universe, tags)
    for i in range(len(bundles)):
        ends, rests = carried["ends"][i], carried["rests"][i]
        first = ends[stage - 1] if stage else 0
        own, weights = carried["terms"][i][first : ends[stage]], carried["weights"][i][first : ends[stage]]
        total = np.zeros(len(universe), dtype=np.int64)
        begun = np.searchsorted(universe, carried["docs"][i])
        total[begun] = carried["scores"][i]
        lows, highs = np.searchsorted(term, own, "left"), np.searchsorted(term, own, "right")
        for low, high, weight in zip(lows.tolist(), highs.tolist(), weights.tolist(), strict=True):
            total[at[low:high]] += weight * value[low:high]  # a document has one posting of a term
        if stage and rests[stage - 1] < floors[i]:  # what has not begun cannot come that far
            have = begun
        else:
            have = np.flatnonzero(total)
        scores = total[have]
        floor = max(floors[i], int(np.partition(scores, -k)[-k])) if len(scores) >= k else floors[i]
        kept = scores + rests[stage] >= max(floor, 1)
        yield i, universe[have[kept]], scores[kept], floor


def _owner(stage: int, k: int):
    def run(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        if not len(bundles):
            return bundles
        docs, scores, floors = [], [], []
        for _, tags, found, floor in _scored(bundles, postings, stage, k):
            docs.append(tags)
            scores.append(found)
            floors.append(floor)
        for name, values in (("docs", docs), ("scores", scores)):
            bundles = bundles.set_column(bundles.schema.get_field_index(name), name, pa.array(values, pa.list_(pa.int64())))
        return bundles.set_column(bundles.schema.get_field_index("floor"), "floor", pa.array(floors, pa.int64()))

    return run


def _selector(stage: int, k: int):
    """The last owner: the best of its shard as (item, tag, score)."""

    def run(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        columns: list[list] = [[], [], []]
        if len(bundles):
            items = bundles.column("item").to_pylist()
            for i, tags, scores, floor in _scored(bundles, postings, stage, k):
                best = scores >= max(floor, 1)
                columns[0] += [items[i]] * int(best.sum())
                columns[1] += tags[best].tolist()
                columns[2] += scores[best].tolist()
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["item", "tag", "score"])

    return run


def _dealt(count: int, size: int) -> int:
    return max(1, -(-count // size))


def _cell(tag: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(tag), F.lit(parts)).cast("long")


def _each(df: DataFrame, name: str, parts: int) -> DataFrame:
    """Every row once for each of ``parts`` cells."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))


def search(
    docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", shard: int = SHARD, block: int = BLOCK,
) -> DataFrame:
    """item_id, rank, id and score of the ``k`` best documents of every item.

    N documents have a term, L terms with repeats together; n is the length of one, df the
    documents that hold a term, tf its frequency in one.  A term weighs
    ``floor(1000 * ln((2N + 2) / (2df + 1)))`` and adds that times
    ``1000000000 tf div (1000 tf + 8 m)``, where m is ``25 + 75 n N div L``, as often as it
    stands in the item.  Higher scores come first, equal ones by id, a null id last, then
    by row; each of several rows with one id counts.  Scores above 0 only.  Null or empty
    texts and texts without terms are not found and find nothing; rows with an item id
    that is null or comes again are items of their own.  Empty tables give no rows.
    """
    asked = materialize(identified(items, id=items[item_col], text=items[item_text_col]), "items")
    wanted = materialize(_postings(asked).select("tag", "term", "tf"), "item_terms")
    vocabulary = materialize(wanted.select("term").distinct().select("term", F.monotonically_increasing_id().alias("number")), "vocabulary")
    # Spark compares the size of the stored vocabulary with its threshold and broadcasts or merges
    rows = _postings(identified(docs, id=docs[id_col], text=docs[text_col]))
    postings = materialize(rows.join(vocabulary, "term").select("number", "tag", "id", "tf", "n", (F.length("term") == 0).alias("whole")), "postings")
    n_docs, n_terms = postings.where("whole").agg(F.count(F.lit(1)), F.sum("n")).first()
    n_docs, n_terms = n_docs or 0, max(1, n_terms or 0)
    mean = F.lit(25) + F.expr(f"(75 * n * {n_docs}L) div {n_terms}L")
    valued = postings.where("not whole").select("number", "tag", "tf", mean.alias("m")).select(
        "number", "tag", F.expr("(1000000000L * tf) div (1000L * tf + 8L * m)").alias("value")
    )
    counts = valued.groupBy("number").agg(F.count(F.lit(1)).alias("df"), F.max("value").alias("most"))
    stage = sum((F.when(F.col("df") > share * n_docs, 1).otherwise(0) for share in OWNERS), F.lit(0))
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1)))
    known = materialize(
        vocabulary.join(counts, "number").select("term", "number", "most", stage.cast("long").alias("stage"), weight.cast("long").alias("weight")),
        "owners",
    )
    last = len(OWNERS)
    shards, blocks = _dealt(n_docs, shard), _dealt(asked.count(), block)
    # rows of the items, each in one block, once for each shard
    start = _bundles(wanted, known, last + 1).withColumn("block", _cell(F.col("item"), blocks))
    bundles = materialize(_each(start, "shard", shards).select(*[f.split()[0] for f in _CARRIED.split(", ")]), "bundles")
    for s in range(last + 1):
        owned = valued.join(known.where(F.col("stage") == s).select("number"), "number")
        placed = _each(owned.withColumn("shard", _cell(F.col("tag"), shards)), "block", blocks)
        right = placed.select("shard", "block", "number", "tag", "value").groupBy("shard", "block")
        step = bundles.groupBy("shard", "block").cogroup(right)
        if s < last:
            bundles = materialize(step.applyInArrow(_owner(s, k), _CARRIED), "bundles")
        else:
            found = materialize(step.applyInArrow(_selector(s, k), "item long, tag long, score long"), "found")
    ids = postings.where("whole").select("tag", "id")
    named = found.join(ids, "tag").join(asked.select(F.col("tag").alias("item"), F.col("id").alias("item_id")), "item")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"), "tag")
    ranked = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", F.col("rank").cast(T.IntegerType()), "id", "score")
