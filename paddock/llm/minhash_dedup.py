"""Near duplicates by circulant MinHash, banding and exact Jaccard verification.

Texts with equal shingle sets form a class first; only its representative goes on.  A
signature has 128 coordinates made from two permutations of the hash space: the first one
shuffles the shingles, the second one is applied with a circular shift of k for coordinate
k.  Bands of four coordinates give 32 buckets a text; two texts with similarity 0.8 share
none of them with probability 5e-8.

Links are confirmed on full shingle sets, and a bucket does not form all its pairs.

1. Every member is compared with the pivot of its bucket, the member that meets the most
   others.  The links found make components.
2. Members at a Jaccard distance of up to ``FAR`` and that of a link from a pivot are its
   family; members farther away are one by bucket.  The distance is a metric, so two linked
   members of a bucket share a family, and their distances from the pivot differ by that of
   a link at most.
3. Families of one component are done.  The others are dealt into blocks of ``BLOCK`` sets and
   ``TOKENS`` shingles by distance from the pivot.  A member asks the blocks at a possible
   distance that hold a component after its own (by size, then number), so that the largest one
   asks nothing.  A block opens only where its union holds enough of the asker's shingles,
   and gives one link for each component that it leads to.

Nothing is capped.  What grows are the askers of a block, not the pairs of its members.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.scratch import recorded, release

from .common import identified, materialize
from .components import components
from .shingles import ODD, Words, classes, digest, link_blocks, mix, outcome, packed, shingles, unpacked

WIDTH = 5
PERCENT = 80
BANDS = 32
ROWS = 4
FAR = 0.5
BLOCK = 256
TOKENS = 1 << 18

_SHINGLES = 1 << 16  # shingles whose coordinates are computed together


def signatures(sets: Sequence[np.ndarray], size: int) -> np.ndarray:
    """MinHash coordinates of non-empty sets, one row each."""
    joined = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    first = _permuted(joined * np.uint32(0x9E3779B1))
    out = np.empty((len(sets), size), dtype=np.uint32)
    for k in range(size):
        out[:, k] = np.minimum.reduceat(_permuted(first - np.uint32(k)), starts)
    return out


def _permuted(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 32-bit numbers."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signature.reshape(len(signature), bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), parts.shape[:2])
    for k in range(rows):
        key = mix(key * ODD[0] + parts[:, :, k])
    return key.view(np.int64)


def blocks_of(sets: list[np.ndarray]) -> Iterator[list[int]]:
    """Numbers of non-empty sets, in blocks of a bounded number of shingles."""
    block, size = [], 0
    for i, s in enumerate(sets):
        if len(s):
            block.append(i)
            size += len(s)
        if size >= _SHINGLES:
            yield block
            block, size = [], 0
    if block:
        yield block


def _fingerprinted(width: int, bands: int, rows: int):
    """Batches of (tag, id, text) to tag, id, n, set digest, band keys and packed text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pack = Words(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sets = [shingles(t, width, known) for t in texts]
            marks = np.zeros((len(sets), 2), dtype=np.uint64)
            keys: list = [None] * len(sets)
            for block in blocks_of(sets):
                own = [sets[i] for i in block]
                for i, found in zip(block, band_keys(signatures(own, bands * rows), bands, rows), strict=True):
                    keys[i] = found
                for i, s in zip(block, own, strict=True):
                    marks[i] = digest(s)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("tag"),
                    batch.column("id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(marks[:, 0].view(np.int64)),
                    pa.array(marks[:, 1].view(np.int64)),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array([packed(t, pack) for t in texts], pa.binary()),
                ],
                names=["tag", "id", "n", "low", "high", "bands", "packed"],
            )

    return run


_FINGERPRINT = "tag long, id {id}, n long, low long, high long, bands array<long>, packed binary"


def _compared(width: int):
    """Batches of (pivot, tag, one, two) to set sizes and overlap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        last: tuple = (None, None)
        for batch in batches:
            others = unpacked(batch.column("two"), width, known)
            found = []
            for i, pivot in enumerate(batch.column("pivot").to_pylist()):
                if last[0] != pivot:  # a pivot comes with many members in a row
                    last = (pivot, unpacked(batch.column("one").slice(i, 1), width, known)[0])
                common = len(np.intersect1d(last[1], others[i], assume_unique=True))
                found.append((len(last[1]), len(others[i]), common))
            sizes = np.array(found, dtype=np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("pivot", "tag")), *(pa.array(sizes[:, k]) for k in range(3))],
                names=["pivot", "tag", "n_pivot", "n", "common"],
            )

    return run


def _compare(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Stored: far and linked of pairs (pivot, tag), from full sets."""
    # texts have one row a tag; large partitions of a pivot are split by adaptive execution,
    # as both sides of the joins are plain shuffles of stored tables, the same at every size
    with_two = pairs.join(texts.select("tag", F.col("packed").alias("two")).hint("merge"), "tag")
    ones = texts.select(F.col("tag").alias("pivot"), F.col("packed").alias("one"))
    with_both = with_two.join(ones.hint("merge"), "pivot")
    schema = "pivot long, tag long, n_pivot long, n long, common long"
    compared = with_both.select("pivot", "tag", "one", "two").mapInArrow(_compared(width), schema)
    union = F.col("n_pivot") + F.col("n") - F.col("common")
    return materialize(
        compared.select(
            "pivot", "tag",
            (1 - F.col("common") / union).alias("far"),
            (100 * F.col("common") >= percent * union).alias("linked"),
        ),
        "compared",
    )


def _families(met: DataFrame, compared: DataFrame, percent: int) -> DataFrame:
    """(family, tag, far): who may be linked with whom, with distances from one pivot."""
    reach = FAR + (100 - percent) / 100 + 1e-9
    pair = F.xxhash64(F.lit("near"), "pivot").alias("family")
    near = compared.where(F.col("far") <= reach)
    own = near.select("pivot").distinct().select(pair, F.col("pivot").alias("tag"), F.lit(0.0).alias("far"))
    lone = met.join(compared.where(F.col("far") > FAR), ["pivot", "tag"])
    lone = lone.select(F.xxhash64(F.lit("far"), "key").alias("family"), "tag", "far")
    return near.select(pair, "tag", "far").unionAll(own).unionAll(lone)


def _links_in_families(families: DataFrame, state: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between components that have members in one family.

    ``state`` has tag, n, comp and weight (size of the component) of every set.
    """
    members = materialize(families.join(state, "tag"), "families")
    several = members.groupBy("family").agg(F.min("comp").alias("one"), F.max("comp").alias("other")).where("one <> other")
    members = materialize(members.join(several.select("family"), "family", "left_semi"), "families")
    # distances of linked members differ by less than two steps and so lie at most two apart
    ring = F.floor(F.col("far") / ((100 - percent) / 200 + 1e-9)).alias("ring")
    rings = members.select("family", ring, "tag", "n", "comp", "weight")
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / TOKENS)).cast("long").alias("parts")
    dealt = materialize(rings.groupBy("family", "ring").agg(parts), "rings")
    part = F.pmod(F.xxhash64("tag"), F.col("parts"))
    dealt = rings.join(dealt, ["family", "ring"]).withColumn("block", F.xxhash64("family", "ring", part))
    dealt = materialize(dealt.drop("parts"), "dealt")
    blocks = dealt.groupBy("family", "ring", "block").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max(F.struct("weight", "comp")).alias("last")
    )
    blocks = materialize(blocks.withColumnRenamed("ring", "other_ring"), "blocks")
    able = (
        (F.abs(F.col("ring") - F.col("other_ring")) <= 2)
        & (F.struct("weight", "comp") < F.col("last"))
        & (100 * F.col("most") >= percent * F.col("n"))
        & (100 * F.col("n") >= percent * F.col("least"))
    )
    asked = dealt.drop("block").join(blocks, "family").where(able).select("tag", "comp", "block").distinct()
    return link_blocks(materialize(asked, "asked"), dealt.select("block", "tag", "comp").distinct(), texts, width, percent)


def _linked(sets: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Components (node, to) and confirmed links (a, b) of class representatives."""
    # a smaller set cannot be similar enough to another one that differs from it
    able = sets.where(F.col("n") * (100 - percent) >= percent)
    each = able.select("tag", F.explode("bands").alias("key"))
    shared = each.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = materialize(each.join(materialize(shared, "buckets"), "key"), "members")
    # how many others a member meets; the one that meets the most is the pivot of a bucket, so
    # that buckets of the same texts have the same few pivots
    meets = materialize(members.groupBy("tag").agg(F.sum("members").alias("meets")), "meets")
    members = members.select("key", "tag").join(meets, "tag")
    pivots = members.groupBy("key").agg(F.min(F.struct((-F.col("meets")).alias("meets"), "tag")).alias("p"))
    pivots = materialize(pivots.select("key", F.col("p.tag").alias("pivot")), "pivots")
    met = materialize(members.select("key", "tag").join(pivots, "key").where("tag <> pivot"), "met")
    texts = materialize(sets.select("tag", "packed").join(meets.select("tag").hint("merge"), "tag", "left_semi"), "texts")
    compared = _compare(materialize(met.select("pivot", "tag").distinct(), "pairs"), texts, width, percent)
    links = materialize(compared.where("linked").select(F.col("pivot").alias("a"), F.col("tag").alias("b")), "links")
    stars = components(links)
    state = sets.select("tag", "n").join(meets.select("tag"), "tag", "left_semi")
    state = state.join(stars.withColumnRenamed("node", "tag"), "tag", "left").select("tag", "n", F.coalesce("to", "tag").alias("comp"))
    state = materialize(state, "state")
    weights = materialize(state.groupBy("comp").agg(F.count(F.lit(1)).alias("weight")), "weights")
    state = materialize(state.join(weights, "comp"), "state")
    more = _links_in_families(_families(met, compared, percent), state, texts, width, percent)
    if more.isEmpty():
        return stars, links
    links = materialize(links.union(more), "links")
    return components(links), links


def cluster(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """tag, id, n_shingles, class_id, n_confirmed_links, component_id and kept of every row.

    Rows are linked if their shingle sets have a Jaccard similarity of at least
    ``percent`` hundredths.  ``class_id`` is the smallest id with the same set, and
    ``n_confirmed_links`` counts the links of that class that were confirmed, enough to connect
    its component; members already connected are not compared, so it is no degree.
    ``component_id`` is the smallest id that can be reached.  Of each component one row
    stays: the smallest id, of repeated ids the first row; a null id comes last.  Texts
    without words (null, empty) have no shingles, are linked with nothing and stay.  An
    empty table gives no rows.
    """
    return cluster_rows(identified(docs, id=docs[id_col], text=docs[text_col]), width, percent)


def cluster_rows(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """``cluster`` for rows of tag, id and text, which are read once."""
    schema = _FINGERPRINT.format(id=rows.schema["id"].dataType.simpleString())
    with recorded([]) as fingerprints:
        stored = materialize(rows.mapInArrow(_fingerprinted(width, BANDS, ROWS), schema), "fingerprints")
    members, reps = classes(stored)
    sets = stored.select("tag", "n", "bands", "packed").join(reps.hint("merge"), "tag", "left_semi")
    sets = materialize(sets, "representatives")
    stored = materialize(stored.select("tag", "id", "n"), "sizes")
    release(rows.sparkSession, fingerprints)
    stars, links = _linked(sets, width, percent)
    return outcome(stored, members, stars, links)


def drop_near_copies(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    stored = materialize(identified(docs, id=docs[id_col], row=F.struct("*")), "documents")
    rows = stored.select("tag", "id", F.col("row").getField(text_col).alias("text"))
    kept = cluster_rows(rows, width, percent).where("kept").select("tag")
    return stored.select("tag", "row").join(kept, "tag", "left_semi").select("row.*")
