"""Similarity join of word n-gram sets by a token-group matrix.

Texts with equal sets form a class, its representative goes on.

* **Groups.**  Representatives are sorted by a few MinHash coordinates and cut into groups of
  at most ``GROUP`` sets and about ``TOKENS`` tokens, so that similar sets stand in one group.
  All links inside a group are found at once.  A set with the most links of its component
  goes on to the next level, where centres are grouped and linked in the same way, until
  nothing more is linked.  After that most links left lead out of small components.
* **Matrix.**  Its rows are tokens, its columns groups.  A set of n tokens needs a partner
  with ``t = ceil(0.8 n)`` of them, so of the first ``n - t + k`` in any common order both hold
  the same k at least.  The matrix is stored for these first tokens, with k a tenth of n, and
  only tokens of several groups lead anywhere.  The order puts tokens that many sets share
  last; it is fitted on the sets of one text in ``SAMPLE`` and changes no result.
* **Bounds.**  A set asks another group where that holds k of its first tokens, a set of
  possible size, and a component that comes after its own (by size, then number), so that
  each pair of components is asked from one side.  Of the group only sets go on that have
  enough first tokens in common with an asker.  They are opened if their token union holds
  80 % of the asker's tokens; then the asker meets each exactly.

Every link between different components is found, as nothing is capped.  No pairs are
formed but those of an asker and a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paddock.scratch import recorded, release

from .common import identified, materialize
from .components import components
from .minhash_dedup import blocks_of, signatures
from .shingles import Opened, Words, classes, digest, link_blocks, outcome, packed, shingles, unpacked

WIDTH = 5
PERCENT = 80
GROUP = 128
TOKENS = 1 << 17
SAMPLE = 8  # the order of tokens is fitted on one set in so many
OFTEN = 3  # sets of the sample from which a token counts as shared by many
KNOWN = 1 << 20  # most frequent tokens that the order knows
SKETCH = 4
MEETINGS = 1 << 18  # rows of other groups that a group meets in one task

_COORDINATES = [f"m{k}" for k in range(SKETCH)]


def _fingerprinted(width: int):
    """Batches of (tag, id, text) to tag, id, n, digest, MinHash coordinates and packed text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pack = Words(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sets = [shingles(t, width, known) for t in texts]
            marks = np.zeros((len(sets), 2), dtype=np.uint64)
            sketch = np.zeros((len(sets), SKETCH), dtype=np.int64)
            for block in blocks_of(sets):
                own = [sets[i] for i in block]
                sketch[block] = signatures(own, SKETCH)
                marks[block] = [digest(s) for s in own]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("tag"),
                    batch.column("id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    *(pa.array(marks[:, k].view(np.int64)) for k in range(2)),
                    *(pa.array(sketch[:, k]) for k in range(SKETCH)),
                    pa.array([packed(t, pack) for t in texts], pa.binary()),
                ],
                names=["tag", "id", "n", "low", "high", *_COORDINATES, "packed"],
            )

    return run


def _tokens(width: int):
    """Batches of (packed) to the tokens of the sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            for s in unpacked(batch.column("packed"), width, known):
                yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64))], names=["token"])

    return run


def _shared_tokens(reps: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of at least ``OFTEN`` sampled sets, ``KNOWN`` at most, sorted, and how many sets hold them."""
    sample = reps.where(F.pmod(F.xxhash64("tag"), F.lit(SAMPLE)) == 0).select("packed")
    counts = sample.mapInArrow(_tokens(width), "token long").groupBy("token").agg(F.count(F.lit(1)).alias("sets"))
    counts = materialize(counts.where(F.col("sets") >= OFTEN), "token_counts")
    least, taken = OFTEN, 0
    for sets, n in sorted(counts.groupBy("sets").count().collect(), reverse=True):
        taken += n
        if taken > KNOWN:
            least = sets + 1
            break
    found = counts.where(F.col("sets") >= least).toArrow()
    tokens, sets = found.column("token").to_numpy().view(np.uint64), found.column("sets").to_numpy()
    order = np.argsort(tokens)
    return tokens[order], sets[order].astype(np.int32)


def _overlap(n: int, percent: int) -> int:
    """How many of its first tokens a set of n has in common with every partner of as many or more."""
    return max(1, n * (100 - percent) // 200)


def needed(n: int, percent: int) -> int:
    """The same for partners of any size, the smallest of which decides."""
    return _overlap(-(-percent * n // 100), percent)


def first_tokens(one: np.ndarray, shared: tuple[np.ndarray, np.ndarray], percent: int) -> np.ndarray:
    """The first tokens of a set."""
    tokens, sets = shared
    wanted = len(one) + (-percent * len(one) // 100) + _overlap(len(one), percent)
    if not len(tokens):
        return one[:wanted]
    at = np.minimum(np.searchsorted(tokens, one), len(tokens) - 1)
    often = np.where(tokens[at] == one, sets[at], 0)
    return one[np.argsort(often, kind="stable")[:wanted]]


class _Forest(dict):
    def __missing__(self, node: int) -> int:
        self[node] = node
        return node

    def root(self, node: int) -> int:
        while self[node] != node:
            self[node] = node = self[self[node]]
        return node


def _linked_inside(sets: list[np.ndarray], percent: int) -> tuple[list[int], list[int]]:
    """For each set the first of its component, and how many sets it is linked with."""
    block, forest = Opened(sets), _Forest()
    degree = [0] * len(sets)
    # a set with too few tokens that any other one has is linked with none
    several = np.repeat(np.diff(block.starts) > 1, np.diff(block.starts))
    shared = np.bincount(block.owners[several], minlength=len(sets))
    for i in np.flatnonzero(100 * shared >= percent * block.sizes).tolist():
        for j in block.linked(sets[i], percent).tolist():
            if j != i:
                degree[i] += 1
                a, b = forest.root(i), forest.root(j)
                forest[max(a, b)] = min(a, b)
    return [forest.root(i) for i in range(len(sets))], degree


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    """Each list of a list column as an array."""
    whole = column.combine_chunks()
    values, ends = whole.flatten().to_numpy(zero_copy_only=False), whole.value_lengths().to_numpy(zero_copy_only=False).cumsum()
    return np.split(values, ends[:-1]) if len(ends) else []


def _first_met(firsts: list[np.ndarray]) -> list[np.ndarray]:
    """For each list which of its tokens no earlier list has; a list has no token twice."""
    joined = np.concatenate(firsts) if firsts else np.empty(0, np.uint64)
    fresh = np.zeros(len(joined), dtype=bool)
    fresh[np.unique(joined, return_index=True)[1]] = True
    return np.split(fresh, np.cumsum([len(f) for f in firsts])[:-1])


def _grouped(width: int, percent: int, shared: tuple[np.ndarray, np.ndarray] | None):
    """Sorted batches of (tag, n, packed) cut into groups, with links and first tokens.

    Gives the group, the tag to which a set is linked (its own if none), whether it is the
    centre of several linked sets, and its first tokens: those that no earlier set of the
    group has, and the others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        held: list[tuple] = []
        size = 0

        def group() -> pa.RecordBatch:
            tags, sets = [h[0] for h in held], [h[1] for h in held]
            roots, degree = _linked_inside(sets, percent)
            centres: dict[int, int] = {}
            for i, r in enumerate(roots):
                if degree[i] > degree[centres.setdefault(r, i)]:
                    centres[r] = i
            firsts = [first_tokens(one, shared, percent) if shared else one[:0] for one in sets]
            fresh = _first_met(firsts)
            new = [f[m].view(np.int64) for f, m in zip(firsts, fresh, strict=True)]
            again = [f[~m].view(np.int64) for f, m in zip(firsts, fresh, strict=True)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([tags[0]] * len(tags), pa.int64()),
                    pa.array(tags, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([tags[r] for r in roots], pa.int64()),
                    pa.array([bool(degree[i]) and centres[r] == i for i, r in enumerate(roots)]),
                    pa.array(new, pa.list_(pa.int64())),
                    pa.array(again, pa.list_(pa.int64())),
                ],
                names=["group", "tag", "n", "root", "centre", "fresh", "again"],
            )

        for batch in batches:
            for tag, one in zip(batch.column("tag").to_pylist(), unpacked(batch.column("packed"), width, known), strict=True):
                if held and (len(held) >= GROUP or size + len(one) > TOKENS):
                    yield group()
                    held, size = [], 0
                held.append((tag, one))
                size += len(one)
        if held:
            yield group()

    return run


_GROUPED = "group long, tag long, n long, root long, centre boolean, fresh array<long>, again array<long>"


def _level(sets: DataFrame, level: int, name: str, width: int, percent: int, shared=None) -> DataFrame:
    """Stored groups of ``sets`` in the order of their coordinates, another one first at each level."""
    order = [*_COORDINATES[level % SKETCH :], *_COORDINATES[: level % SKETCH], "tag"]
    ordered = sets.repartitionByRange(*order).sortWithinPartitions(*order).select("tag", "packed")
    return materialize(ordered.mapInArrow(_grouped(width, percent, shared), _GROUPED), name)


def _tree(level: DataFrame) -> DataFrame:
    return level.where("tag <> root").select(F.col("root").alias("a"), F.col("tag").alias("b"))


def _asked(groups: DataFrame, state: DataFrame, percent: int) -> DataFrame:
    """Stored (tag, block): the groups that a set may have a partner in.

    ``state`` has group, tag, n, comp and weight (size of the component) of every set.
    """
    order = F.struct("weight", "comp")
    bounds = materialize(
        state.groupBy("group").agg(
            F.min("n").alias("least"), F.max("n").alias("most"), F.min(order).alias("first_comp"), F.max(order).alias("last_comp")
        ),
        "bounds",
    )
    token = Window.partitionBy("token")
    matrix = groups.select("group", F.explode("fresh").alias("token"))
    several = matrix.withColumn("low", F.min("group").over(token)).withColumn("high", F.max("group").over(token))
    several = materialize(several.where("low <> high").select("token", "group"), "matrix").join(bounds, "group")
    other = several.select("token", *[F.col(c).alias(f"other_{c}") for c in ("group", "least", "most", "last_comp")])
    able = (
        (F.col("group") != F.col("other_group"))
        & (F.col("first_comp") < F.col("other_last_comp"))
        & (100 * F.col("other_most") >= percent * F.col("least"))
        & (100 * F.col("most") >= percent * F.col("other_least"))
    )
    met = several.join(other, "token").where(able).select(
        "group", "token", F.col("other_group").alias("block"), F.col("other_least").alias("least"), F.col("other_most").alias("most"),
        F.col("other_last_comp.weight").alias("weight"), F.col("other_last_comp.comp").alias("comp"),
    )
    met = materialize(met, "met")
    # a group that meets very many others is asked in several tasks
    shares = met.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / MEETINGS).cast("long").alias("parts"))
    shares = materialize(shares, "shares")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    asking = state.join(shares, "group").select("group", each, "tag", "n", "comp", "weight")
    asking = asking.join(groups.select("tag", F.concat("fresh", "again").alias("first")), "tag")
    part = F.pmod(F.xxhash64("block"), F.col("parts"))
    met = met.join(shares, "group").select(F.col("group").alias("by_group"), part.alias("by_part"), "token", "block", "least", "most", "weight", "comp")

    def run(sets: pa.Table, met: pa.Table) -> pa.Table:
        tags, blocks = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        if len(sets) and len(met):
            met = met.sort_by("token")
            token = met.column("token").to_numpy()
            block, least, most = (met.column(c).to_numpy() for c in ("block", "least", "most"))
            weight, comp = met.column("weight").to_numpy(), met.column("comp").to_numpy()
            firsts, own = _lists(sets.column("first")), [sets.column(c).to_pylist() for c in ("tag", "n", "comp", "weight")]
            for first, tag, n, own_comp, own_weight in zip(firsts, *own, strict=True):
                lows = np.searchsorted(token, first, "left")
                lengths = np.searchsorted(token, first, "right") - lows
                if lengths.sum() < needed(n, percent):
                    continue
                at = np.arange(lengths.sum()) + np.repeat(lows - lengths.cumsum() + lengths, lengths)
                able = (100 * most[at] >= percent * n) & (100 * n >= percent * least[at])
                able &= (weight[at] > own_weight) | ((weight[at] == own_weight) & (comp[at] > own_comp))
                found, common = np.unique(block[at[able]], return_counts=True)
                found = found[common >= needed(n, percent)]
                tags.append(np.full(len(found), tag))
                blocks.append(found)
        return pa.table([pa.array(np.concatenate(c), pa.int64()) for c in (tags, blocks)], names=["tag", "block"])

    both = asking.groupBy("group", "part").cogroup(met.groupBy("by_group", "by_part"))
    return materialize(both.applyInArrow(run, "tag long, block long"), "asked")


def _narrowed(asked: DataFrame, groups: DataFrame, state: DataFrame, percent: int, most: int = 512) -> DataFrame:
    """Stored (block, tag, comp, member): what is left of askers and of the groups they ask.

    An asker and a set of the group stay only if they have enough first tokens in common,
    which needs no text.
    """
    shares = materialize(asked.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / most).cast("long").alias("parts")), "shares")
    first = groups.select("tag", F.concat("fresh", "again").alias("first"))
    slim = state.select("tag", "n", "comp")
    part = F.pmod(F.xxhash64("tag"), F.col("parts")).alias("part")
    asking = asked.join(shares, "block").select("block", part, "tag").join(slim, "tag").join(first, "tag")
    asking = asking.select(*[F.col(c).alias(f"by_{c}") for c in ("block", "part", "tag", "n", "comp", "first")])
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    opened = state.withColumnRenamed("group", "block").join(shares, "block").select("block", each, "tag", "n", "comp").join(first, "tag")

    def run(sets: pa.Table, asking: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if len(sets) and len(asking):
            firsts = [f.view(np.uint64) for f in _lists(sets.column("first"))]
            block = Opened(firsts)
            sizes, comps = sets.column("n").to_numpy(), sets.column("comp").to_numpy()
            overlaps = np.array([_overlap(n, percent) for n in sizes.tolist()])
            met = np.zeros(len(sets), dtype=bool)
            kept, number = [], sets.column("block")[0].as_py()
            for tag, n, comp, one in zip(
                *(asking.column(c).to_pylist() for c in ("by_tag", "by_n", "by_comp")), _lists(asking.column("by_first")), strict=True
            ):
                common = block.common(block.found(one.view(np.uint64)))
                able = (common >= np.minimum(overlaps, _overlap(n, percent))) & (comps != comp)
                able &= 100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n)
                if able.any():
                    met |= able
                    kept.append((number, tag, comp, False))
            tags = sets.column("tag").to_numpy()
            kept += [(number, t, c, True) for t, c in zip(tags[met].tolist(), comps[met].tolist(), strict=True)]
            out = [list(c) for c in zip(*kept, strict=True)] or out
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        return pa.table([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["block", "tag", "comp", "member"])

    met = opened.groupBy("block", "part").cogroup(asking.groupBy("by_block", "by_part"))
    return materialize(met.applyInArrow(run, "block long, tag long, comp long, member boolean"), "narrowed")


def join(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """tag, id, n_shingles, class_id, n_confirmed_links, component_id and kept of every row.

    Rows are linked if their sets of ``width``-word shingles have a Jaccard similarity of at
    least ``percent`` hundredths.  ``class_id`` is the smallest id with the same set,
    ``component_id`` the smallest id that can be reached over links; ``n_confirmed_links``
    counts links that were needed, it is no degree.  A text of fewer words is one shingle.
    Texts without words (null, empty) are linked with nothing.  A null id comes last; rows
    that come again are rows of their own with the same class.  An empty table gives no rows.
    """
    rows = identified(docs, id=docs[id_col], text=docs[text_col])
    schema = f"tag long, id {rows.schema['id'].dataType.simpleString()}, n long, low long, high long, "
    schema += ", ".join(f"{c} long" for c in _COORDINATES) + ", packed binary"
    with recorded([]) as fingerprints:
        stored = materialize(rows.mapInArrow(_fingerprinted(width), schema), "fingerprints")
    members, reps = classes(stored)
    sets = stored.select("tag", "n", *_COORDINATES, "packed").join(reps.hint("merge"), "tag", "left_semi")
    sets = materialize(sets, "representatives")
    stored = materialize(stored.select("tag", "id", "n"), "sizes")
    release(docs.sparkSession, fingerprints)
    texts = sets.select("tag", "packed")
    groups = _level(sets, 0, "groups", width, percent, _shared_tokens(sets, width))
    trees, level, depth = [_tree(groups)], groups, 0
    while True:
        centres = level.where("centre").select("tag")
        depth += 1
        level = _level(sets.join(centres, "tag", "left_semi"), depth, f"level{depth}", width, percent)
        if level.where("centre").isEmpty():
            break
        trees.append(_tree(level))
    known = materialize(reduce(DataFrame.union, trees), "links")
    stars = components(known)
    state = groups.select("group", "tag", "n").join(stars.withColumnRenamed("node", "tag"), "tag", "left")
    state = materialize(state.select("group", "tag", "n", F.coalesce("to", "tag").alias("comp")), "state")
    weights = materialize(state.groupBy("comp").agg(F.count(F.lit(1)).alias("weight")), "weights")
    state = materialize(state.join(weights, "comp"), "state")
    left = _narrowed(_asked(groups, state, percent), groups, state, percent)
    askers, opened = left.where(~F.col("member")).drop("member"), left.where("member").drop("member").distinct()
    more = link_blocks(askers, opened, texts, width, percent)
    links = materialize(known.union(more), "links")
    if not more.isEmpty():
        stars = components(links)
    return outcome(stored, members, stars, links)
