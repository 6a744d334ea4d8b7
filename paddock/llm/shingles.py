"""Sets of word shingles: hashes, classes of equal sets, links inside blocks of sets.

The operators that look for similar sets share this: texts with equal sets form a class of
which one representative goes on, links between representatives make components, and every
row gets the outcome of its class.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, materialize

_KEEP_WORDS = 1 << 20  # words a task remembers the hashes of

ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)


class Words(dict):
    """64-bit hashes of words, remembered within a task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KEEP_WORDS:
            self.clear()
        value = xxhash.xxh64_intdigest(word) - (1 << 63)
        self[word] = value
        return value


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int, known: Words) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text.

    Letters A-Z count as lower case.  A text of fewer words than ``width`` is one
    shingle, a text without words has none.
    """
    return shingles_of(text.encode("utf-8", "surrogatepass"), width, known) if text else np.empty(0, dtype=np.uint64)


def shingles_of(text: bytes, width: int, known: Words) -> np.ndarray:
    """``shingles`` of a text in UTF-8."""
    # bytes.lower and bytes.split know exactly A-Z and the six ASCII spaces
    split = text.lower().split()
    if not split:
        return np.empty(0, dtype=np.uint64)
    codes = np.fromiter(map(known.__getitem__, split), dtype=np.int64, count=len(split)).view(np.uint64)
    taken = min(width, len(codes))
    total = np.full(len(codes) - taken + 1, taken, dtype=np.uint64)
    for k in range(taken):
        part = codes[k : len(codes) - taken + 1 + k] * ODD[k % len(ODD)]
        total = mix(total + part)
    return np.unique(total)


def digest(shingle_set: np.ndarray) -> tuple[int, int]:
    """128 bits that do not depend on the order of a set."""
    return shingle_set.sum(dtype=np.uint64), mix(shingle_set + ODD[1]).sum(dtype=np.uint64)


def packed(text: str | None, pack: zstandard.ZstdCompressor) -> bytes:
    return pack.compress((text or "").encode("utf-8", "surrogatepass"))


def unpacked(column: pa.Array, width: int, known: Words) -> list[np.ndarray]:
    """The sets of a column of packed texts."""
    unpack = zstandard.ZstdDecompressor()
    return [shingles_of(unpack.decompress(p), width, known) for p in column.to_pylist()]


class Opened:
    """Sets of a block that others are compared with, by their union and its postings."""

    def __init__(self, sets: Sequence[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        owners = np.repeat(np.arange(len(sets)), self.sizes)
        tokens = np.concatenate(sets) if len(sets) else np.empty(0, dtype=np.uint64)
        order = np.argsort(tokens, kind="stable")
        self.owners = owners[order]
        self.union, starts = np.unique(tokens[order], return_index=True)
        self.starts = np.append(starts, len(tokens))

    def found(self, one: np.ndarray) -> np.ndarray:
        """Places in the union of the tokens of ``one`` that it holds."""
        at = np.searchsorted(self.union, one)
        at[at == len(self.union)] = 0
        return at[self.union[at] == one] if len(self.union) else at[:0]

    def common(self, found: np.ndarray) -> np.ndarray:
        """Size of the intersection with every set of the block."""
        lows, lengths = self.starts[found], self.starts[found + 1] - self.starts[found]
        ends = lengths.cumsum()
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(lows - ends + lengths, lengths)
        return np.bincount(self.owners[places], minlength=len(self.sizes))

    def linked(self, one: np.ndarray, percent: int) -> np.ndarray:
        """Numbers of the sets similar enough to ``one``; opened only if the union allows one."""
        found = self.found(one)
        if not len(one) or 100 * len(found) < percent * len(one):
            return np.empty(0, dtype=np.int64)
        common = self.common(found)
        return np.flatnonzero(100 * common >= percent * (len(one) + self.sizes - common))


def classes(stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (tag, id, n, rep, class_id) of each class of equal sets, and representatives (tag).

    ``stored`` has tag, id, n and the digest (low, high) of every text.
    """
    order = F.min(F.struct(F.col("id").isNull(), "id", "tag"))
    some = stored.where("n > 0")
    by_set = materialize(some.groupBy("low", "high", "n").agg(order.alias("least")), "classes")
    slim = attach(some.select("tag", "id", "low", "high", "n"), by_set, ["low", "high", "n"])
    members = materialize(
        slim.select("tag", "id", "n", F.col("least.tag").alias("rep"), F.col("least.id").alias("class_id")), "members"
    )
    return members, members.where("tag = rep").select("tag")


def outcome(stored: DataFrame, members: DataFrame, stars: DataFrame, links: DataFrame) -> DataFrame:
    """tag, id, n_shingles, class_id, n_confirmed_links, component_id and kept of every row.

    ``stars`` are the components (node, to) of representatives, ``links`` (a, b) what made them.
    """
    order = F.min(F.struct(F.col("id").isNull(), "id", "tag"))
    none = F.lit(0).cast("long")
    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("n_confirmed_links"))
    of_rep = materialize(
        members.where("tag = rep").select("rep")
        .join(stars.select(F.col("node").alias("rep"), "to"), "rep", "left")
        .join(degree, "rep", "left")
        .select("rep", F.coalesce("to", "rep").alias("comp"), F.coalesce("n_confirmed_links", none).alias("n_confirmed_links")),
        "components",
    )
    placed = materialize(attach(members, of_rep, ["rep"]), "members")
    least = materialize(placed.groupBy("comp").agg(order.alias("least")), "components")
    full = attach(placed, least, ["comp"]).select(
        "tag",
        "id",
        F.col("n").alias("n_shingles"),
        "class_id",
        "n_confirmed_links",
        F.col("least.id").alias("component_id"),
        (F.col("tag") == F.col("least.tag")).alias("kept"),
    )
    alone = stored.where("n = 0").select(
        "tag", "id", F.col("n").alias("n_shingles"), F.col("id").alias("class_id"), none.alias("n_confirmed_links"),
        F.col("id").alias("component_id"), F.lit(True).alias("kept"),
    )
    return full.unionAll(alone)


def link_blocks(pairs: DataFrame, members: DataFrame, texts: DataFrame, width: int, percent: int, most: int = 512) -> DataFrame:
    """Stored links (a, b) between each asking set and the sets of the blocks it opens.

    ``pairs`` has tag, comp and block of the askers, ``members`` block, tag and comp of every
    block's sets, ``texts`` tag and packed.  Sets of the asker's own component are passed
    over, of each other component one link is enough.  A block that more than ``most`` sets ask
    is opened in several tasks.
    """
    asked = materialize(pairs.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / most).cast("long").alias("parts")), "asked")
    part = F.pmod(F.xxhash64("tag"), F.col("parts")).alias("part")
    asking = pairs.join(asked, "block").select("block", part, "tag", "comp").join(texts.hint("merge"), "tag")
    asking = asking.select(*[F.col(c).alias(f"by_{c}") for c in ("block", "part", "tag", "comp", "packed")])
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    opened = members.join(asked, "block").join(texts.hint("merge"), "tag").select("block", each, "tag", "comp", "packed")
    keys = "block", "part"

    def run(block: pa.Table, queries: pa.Table) -> pa.Table:
        known, a, b = Words(), [], []
        if len(block) and len(queries):
            sets = Opened(unpacked(block.column("packed"), width, known))
            tags, comps = block.column("tag").to_numpy(), block.column("comp").to_numpy()
            for tag, comp, one in zip(
                queries.column("by_tag").to_pylist(), queries.column("by_comp").to_pylist(),
                unpacked(queries.column("by_packed"), width, known), strict=True,
            ):
                to = sets.linked(one, percent)
                to = to[comps[to] != comp]
                if len(to):
                    _, first = np.unique(comps[to], return_index=True)
                    a += [tag] * len(first)
                    b += tags[to[first]].tolist()
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    met = opened.groupBy(*keys).cogroup(asking.groupBy(*[f"by_{k}" for k in keys]))
    return materialize(met.applyInArrow(run, "a long, b long"), "links")
