"""Best-fit packing of documents into training sequences, under conflicts.

A bin is a sequence of ``capacity`` words.  Two pieces of the same source, or of the same
cluster of duplicates, may not share a bin.  Documents are dealt by hash to shards of a
bounded number of rows and every shard is packed by one task, on lengths alone: texts
stay where they are.  Inside a shard the longest pieces go first.  Open bins are kept in
order of the room left and carry a bitmap of their sources and one of their clusters; a
piece goes to the bin with the least sufficient room, and while bitmaps conflict the
search goes on to the next larger one until a bin fits or a new one is opened.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, SPACES, materialize

CAPACITY = 1024
SHARD_ROWS = 16_384  # pieces a task packs together, on average

_SCHEMA = (
    "shard long, bin long, slot int, id string, piece int, first_word long, n_words long, source string"
)


def n_words(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", 0).otherwise(F.regexp_count(trimmed, F.lit(SPACES)) + 1).cast("long")


def cluster(text: Column) -> Column:
    """Texts that differ in case and spaces only are duplicates of each other."""
    return F.xxhash64(F.lower(F.translate(F.coalesce(text, F.lit("")), SPACE, "")))


class Bins:
    """Open bins of a shard, ordered by room; the bitmaps are rows of 64-bit words."""

    def __init__(self, capacity: int, n_sources: int, n_clusters: int, n_pieces: int):
        self.capacity = capacity
        self.n_sources = n_sources
        self.bits = np.zeros(((n_sources + n_clusters + 63) // 64 + 1, n_pieces), dtype=np.uint64)
        self.count = 0
        self.filled = np.zeros(n_pieces, dtype=np.int64)
        self.members = np.zeros(n_pieces, dtype=np.int64)
        # room and number of the bins in order; the first ``open`` entries count
        self.open = 0
        self.room = np.zeros(n_pieces, dtype=np.int64)
        self.bin = np.zeros(n_pieces, dtype=np.int64)

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and slot of the next piece; cluster -1 conflicts with nothing."""
        marks = [(source // 64, np.uint64(1 << source % 64))]
        if cluster >= 0:
            at = self.n_sources + cluster
            marks.append((at // 64, np.uint64(1 << at % 64)))
        found = self._tightest(size, marks)
        if found < 0:
            chosen, left = self.count, self.capacity - size
            self.count += 1
        else:
            chosen, left = int(self.bin[found]), int(self.room[found]) - size
            self._remove(found)
        for word, bit in marks:
            self.bits[word, chosen] |= bit
        if left > 0:
            self._insert(left, chosen)
        slot = int(self.members[chosen])
        self.members[chosen] += 1
        self.filled[chosen] += size
        return chosen, slot

    def _tightest(self, size: int, marks: list) -> int:
        start = int(np.searchsorted(self.room[: self.open], size))
        step = 16
        while start < self.open:
            end = min(self.open, start + step)
            bins = self.bin[start:end]
            free = np.ones(end - start, dtype=bool)
            for word, bit in marks:
                free &= self.bits[word, bins] & bit == 0
            at = int(free.argmax())
            if free[at]:
                return start + at
            start, step = end, step * 4
        return -1

    def _remove(self, at: int) -> None:
        for values in (self.room, self.bin):
            values[at : self.open - 1] = values[at + 1 : self.open]
        self.open -= 1

    def _insert(self, left: int, chosen: int) -> None:
        at = int(np.searchsorted(self.room[: self.open], left, side="right"))
        for values, new in ((self.room, left), (self.bin, chosen)):
            values[at + 1 : self.open + 1] = values[at : self.open]
            values[at] = new
        self.open += 1


def pieces(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Documents cut into pieces of at most ``capacity`` words, longest first."""
    count = -(-rows["n_words"].to_numpy() // capacity)
    cut = rows.loc[rows.index.repeat(count)].reset_index(drop=True)
    cut["piece"] = cut.groupby("tag").cumcount().astype("int32")
    cut["first_word"] = cut["piece"].astype("int64") * capacity
    cut["n_words"] = np.minimum(capacity, cut["n_words"] - cut["first_word"])
    return cut.sort_values(
        ["n_words", "id", "tag", "piece"], ascending=[False, True, True, True], kind="stable"
    ).reset_index(drop=True)


def pack_shard(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """The pieces of one shard with their bins and slots."""
    cut = pieces(rows, capacity)
    sources = pd.factorize(cut["source"], use_na_sentinel=False)[0]
    # pieces of one document never share a bin either
    kin = cut["cluster"].to_numpy()
    codes, counts = pd.factorize(kin)[0], cut["cluster"].map(cut["cluster"].value_counts()).to_numpy()
    shared = np.where(counts > 1, codes, -1)
    shared[shared >= 0] = pd.factorize(shared[shared >= 0])[0]
    bins = Bins(capacity, int(sources.max(initial=-1)) + 1, int(shared.max(initial=-1)) + 1, len(cut))
    placed = [
        bins.place(int(size), int(source), int(kind))
        for size, source, kind in zip(cut["n_words"], sources, shared, strict=True)
    ]
    cut["bin"] = np.array([b for b, _ in placed], dtype="int64")
    cut["slot"] = np.array([s for _, s in placed], dtype="int32")
    return cut


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    shard_rows: int = SHARD_ROWS,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """shard, bin, slot, id, piece, first_word, n_words and source of every piece.

    A document longer than ``capacity`` words is cut into pieces, which get bins of their
    own, as they share a source.  Texts without a word (null, empty) have no pieces.  A
    null source is a source, a null id is kept.  Repeated rows are packed each, in bins
    of their own.  A bin is named by shard and bin.  An empty table gives no rows.
    """
    slim = docs.select(
        F.monotonically_increasing_id().alias("tag"),
        docs[id_col].cast("string").alias("id"),  # text, as pandas turns whole numbers with nulls into floats
        docs[source_col].cast("string").alias("source"),
        n_words(docs[text_col]).alias("n_words"),
        cluster(docs[text_col]).alias("cluster"),
    )
    stored = materialize(slim.where("n_words > 0"), "lengths")
    # a long text counts as its pieces, so that shards of them stay bounded as well
    total = stored.agg(F.sum(F.ceil(F.col("n_words") / capacity))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_rows))
    dealt = stored.withColumn("shard", F.pmod(F.xxhash64("id", "tag"), F.lit(shards)))

    columns = [c.split()[0] for c in _SCHEMA.split(", ")]
    packed = dealt.groupBy("shard").applyInPandas(
        lambda rows: pack_shard(rows, capacity)[columns], _SCHEMA
    )
    return packed.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType))
