"""Hard negatives by a vertical scan (BOND) over blocks of columns.

Rows are dealt into blocks of about ``ROWS`` and anchors into blocks of about ``ANCHORS``;
each pair of blocks is one group.  In it a vector component is a column.  An anchor reads
the columns in descending magnitude of its own components, a few at a time, and only for
the rows that are still candidates.  What the columns not yet read can add lies between
sums of their smallest and largest products, so every candidate has a lower and an upper
bound; the candidates shrink to those that may still be among the wanted ones, until the
scores are exact.  The first scan finds positives, the second one the rows in the windows of
all positives.  A group returns a few rows for each anchor, a window function the best.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import identified, materialize

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # hundredths of a positive's score between which a negative's lies
ROWS = 4096
ANCHORS = 256
STEP = 16  # columns read between two cuts
LARGEST = 65536.0  # components from here on cannot be scored in 64 bits


def prepared(vectors: DataFrame, label: Column, anchor: Column, id_col: str, vector_col: str) -> DataFrame:
    """tag, id, label, vector of whole numbers and whether a row is an anchor, of all that take part."""
    rows = identified(vectors, id=vectors[id_col], label=label, vector=vectors[vector_col], anchor=anchor)
    x = F.col("vector")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < LARGEST))
    some = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & sound)
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * SCALE).cast("int"))
    return some.select("tag", "id", "label", whole.alias("vector"), F.coalesce("anchor", F.lit(False)).alias("anchor"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """One row for each vector; a shorter one counts as 0 where it ends."""
    whole = column.combine_chunks()
    lengths = whole.value_lengths().to_numpy(zero_copy_only=False)
    values = whole.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def _width(*tables: pa.Table) -> int:
    found = [t.column("vector").combine_chunks().value_lengths().to_numpy(zero_copy_only=False) for t in tables]
    return max([0, *(int(f.max()) for f in found if len(f))])


class Block:
    """Columns of a block of rows with their smallest and largest values."""

    def __init__(self, rows: np.ndarray):
        self.columns = np.ascontiguousarray(rows.T)
        self.low = self.columns.min(axis=1) if len(rows) else np.zeros(rows.shape[1], np.int64)
        self.high = self.columns.max(axis=1) if len(rows) else np.zeros(rows.shape[1], np.int64)
        self.doubles = self.columns.astype(np.float64)

    def scan(self, anchor: np.ndarray, alive: np.ndarray, cut) -> tuple[np.ndarray, np.ndarray]:
        """Candidates and exact scores that ``cut(lower, upper)``, a mask of bounds, lets through."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        one, two = anchor * self.low, anchor * self.high
        # what the columns from a place on can add at least and at most
        least = np.append(np.minimum(one, two)[order][::-1].cumsum()[::-1], 0)
        most = np.append(np.maximum(one, two)[order][::-1].cumsum()[::-1], 0)
        # sums of whole numbers are exact in doubles as long as they stay below 2^53
        exact = np.maximum(np.abs(one), np.abs(two)).astype(np.float64).sum() < 2.0**53
        columns, weights = (self.doubles, anchor.astype(np.float64)) if exact else (self.columns, anchor)
        part = np.zeros(len(alive), dtype=weights.dtype)
        for first in range(0, len(order), STEP):
            if not len(alive):
                break
            own = order[first : first + STEP]
            part += weights[own] @ columns[own].take(alive, axis=1)
            read = min(first + STEP, len(order))
            kept = cut(part + least[read], part + most[read])
            if not kept.all():
                alive, part = alive[kept], part[kept]
        return alive, part.astype(np.int64)


def _at_least(lower: np.ndarray, k: int):
    """The k-th largest lower bound, below which no upper bound leads to the first k."""
    return np.partition(lower, -k)[-k] if len(lower) >= k else None


def nearest(block: Block, anchor: np.ndarray, alive: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidates that may be the k with the highest scores; equal scores stay."""

    def cut(lower, upper):
        floor = _at_least(lower, k)
        return np.ones(len(lower), bool) if floor is None else upper >= floor

    return block.scan(anchor, alive, cut)


def in_windows(
    block: Block, anchor: np.ndarray, alive: np.ndarray, windows: list[tuple[int, int]], k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Candidates that may be among the k highest scores of a window [low, high]."""
    least, last_low = min(low for low, _ in windows), max(low for low, _ in windows)
    first_high, most = min(high for _, high in windows), max(high for _, high in windows)

    def cut(lower, upper):
        # k rows inside all windows leave no place for what lies below them
        floor = _at_least(lower[(lower >= last_low) & (upper <= first_high)], k)
        return (upper >= (least if floor is None else max(least, floor))) & (lower <= most)

    return block.scan(anchor, alive, cut)


def _best(scores: np.ndarray, rank: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, equal ones by rank."""
    return np.lexsort((rank, -scores))[:k]


def _scanned(tables: tuple[pa.Table, pa.Table]):
    """The block of rows, the anchors' vectors, and per row its place in the order of (id, tag)."""
    rows, anchors = tables
    width = _width(rows, anchors)
    block = Block(_matrix(rows.column("vector"), width))
    tags = rows.column("tag").to_numpy()
    by_id = rows.select(["id", "tag"]).append_column("at", pa.array(np.arange(len(tags)))).sort_by([("id", "ascending"), ("tag", "ascending")])
    place = np.empty(len(tags), dtype=np.int64)
    place[by_id.column("at").to_numpy()] = np.arange(len(tags))
    codes = pa.chunked_array([*rows.column("label").chunks, *anchors.column("label").chunks], rows.column("label").type)
    codes = codes.combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    return block, tags, place, _matrix(anchors.column("vector"), width), codes[: len(tags)], codes[len(tags) :]


def _collected(rows: pa.Table, names: list[str], found: list[list], at: list[np.ndarray]) -> pa.Table:
    """``found`` columns of longs, with tag and id of the rows at the places ``at``."""
    places = pa.array(np.concatenate(at) if at else np.empty(0, np.int64))
    columns = [pa.array(np.concatenate(c) if c else np.empty(0, np.int64), pa.int64()) for c in found]
    return pa.table([*columns, rows.column("tag").take(places), rows.column("id").take(places)], names=[*names, "tag", "id"])


def _positives(k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found: list[list] = [[], []]
        at: list[np.ndarray] = []
        if len(rows) and len(anchors):
            block, tags, place, vectors, labels, own = _scanned((rows, anchors))
            for i, tag in enumerate(anchors.column("tag").to_pylist()):
                alive = np.flatnonzero((labels == own[i]) & (tags != tag))
                alive, scores = nearest(block, vectors[i], alive, k)
                best = _best(scores, place[alive], k)
                found[0].append(np.full(len(best), tag))
                found[1].append(scores[best])
                at.append(alive[best])
        return _collected(rows, ["anchor", "score"], found, at)

    return run


def _negatives(k: int, low: int, high: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found: list[list] = [[], [], []]
        at: list[np.ndarray] = []
        if len(rows) and len(anchors):
            block, _, place, vectors, labels, own = _scanned((rows, anchors))
            tags, wanted = anchors.column("tag").to_pylist(), anchors.column("positive_scores").to_pylist()
            for i, tag in enumerate(tags):
                others = np.flatnonzero(labels != own[i])
                windows = {w: (-(-low * w // 100), high * w // 100) for w in set(wanted[i])}
                windows = {w: (first, last) for w, (first, last) in windows.items() if first <= last}
                if not windows:
                    continue
                alive, scores = in_windows(block, vectors[i], others, list(windows.values()), k)
                for w, (first, last) in windows.items():
                    inside = np.flatnonzero((scores >= first) & (scores <= last))
                    best = inside[_best(scores[inside], place[alive[inside]], k)]
                    found[0].append(np.full(len(best), tag))
                    found[1].append(np.full(len(best), w))
                    found[2].append(scores[best])
                    at.append(alive[best])
        return _collected(rows, ["anchor", "positive_score", "score"], found, at)

    return run


def _cells(rows: DataFrame, anchors: DataFrame, row_blocks: int, anchor_blocks: int):
    """Both sides of a cogroup in which every block of rows meets every block of anchors."""

    def own(parts: int) -> Column:
        return F.pmod(F.xxhash64("tag"), F.lit(parts)).cast("long")

    def each(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))

    left = rows.withColumn("rows", own(row_blocks)).withColumn("anchors", each(anchor_blocks))
    right = anchors.withColumn("rows", each(row_blocks)).withColumn("anchors", own(anchor_blocks))
    return left.groupBy("rows", "anchors").cogroup(right.groupBy("rows", "anchors"))


def mine(
    vectors: DataFrame, label: Column, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    row_block: int = ROWS, anchor_block: int = ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``label`` and ``anchor`` are expressions on ``vectors``.  A component x counts as
    ``floor(256 x)``, the score of two rows is their inner product.  The positives of an
    anchor are the ``positives`` other rows of its label with the highest scores; of the
    rows with another label whose score lies between ``low`` and ``high`` hundredths of a
    positive's, the ``negatives`` highest are returned.  Equal scores are ordered by id, then
    by row: each of several rows with one id takes part.  Rows without id, label or vector,
    with a missing or infinite component, or with one of 65,536 or more take no part; a
    shorter vector counts as 0 where it ends.  Positives with a score below 0 have an empty
    window.  Empty tables give no rows.
    """
    rows = materialize(prepared(vectors, label, anchor, id_col, vector_col), "vectors")
    n_rows, n_anchors = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("anchor"), True))).first()
    shape = max(1, -(-n_rows // row_block)), max(1, -(-n_anchors // anchor_block))
    kind = rows.schema["id"].dataType.simpleString()
    whole = rows.select("tag", "id", "label", "vector")
    anchors = rows.where("anchor").select("tag", "id", "label", "vector")
    near = _cells(whole, anchors, *shape).applyInArrow(_positives(positives), f"anchor long, score long, tag long, id {kind}")
    by_score = [F.desc("score"), F.asc("id"), F.asc("tag")]
    order = Window.partitionBy("anchor").orderBy(*by_score)
    chosen = materialize(near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives), "positives")
    scores = chosen.groupBy(F.col("anchor").alias("tag")).agg(F.collect_set("score").alias("positive_scores"))
    asking = materialize(anchors.join(scores, "tag"), "anchors")
    far = _cells(whole, asking, *shape).applyInArrow(
        _negatives(negatives, low, high), f"anchor long, positive_score long, score long, tag long, id {kind}"
    )
    order = Window.partitionBy("anchor", "positive_score").orderBy(*by_score)
    best = materialize(far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives), "negatives")
    pairs = chosen.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = pairs.join(asking.select(F.col("tag").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return named.join(best, ["anchor", "positive_score"]).select(
        "anchor_id", "positive_id", F.col("rank").cast(T.IntegerType()), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
