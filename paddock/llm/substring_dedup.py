"""Passages that repeat inside or across documents, by content-defined chunks.

A gear rolling hash over the bytes of a text sees the last 16 of them; where it falls
below a limit a chunk ends.  Cuts therefore depend on content alone: an insertion moves
chunks but changes only those around it.  A chunk is known by a 64-bit digest while equal
ones are counted, and by a second one before it counts as repeated.

The first occurrence of a chunk, by document id and place, stays.  Adjacent later
occurrences form a passage, which is reported (and can be cut) if it has enough words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import attach, identified, materialize

MEAN = 40  # bytes of a chunk, on average
MIN_WORDS = 15

_SPAN = 16  # bytes the rolling hash sees
_GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), seed=7) for b in range(256)], dtype=np.uint32)
_BATCH = 1 << 22  # bytes hashed together


def rolling(data: np.ndarray) -> np.ndarray:
    """The gear hash at every byte: the sum of the last 16 gears, doubled once a step."""
    total = _GEAR[data]
    width = 1
    while width < _SPAN:
        earlier = np.zeros_like(total)
        earlier[width:] = total[:-width]
        total = total + (earlier << np.uint32(width))
        width *= 2
    return total


def cuts(data: bytes, mean: int = MEAN) -> np.ndarray:
    """Ends of the chunks of a text in UTF-8; they never part a character."""
    if not data:
        return np.empty(0, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)
    found = []
    for start in range(0, len(raw), _BATCH):  # very long texts in pieces, with what the hash sees before
        before = min(start, _SPAN)
        piece = raw[start - before : start + _BATCH]
        below = rolling(piece)[before:] >> np.uint32(8) < (1 << 24) // mean
        found.append(np.flatnonzero(below) + start + 1)
    ends = np.concatenate(found)
    ends = ends[ends < len(raw)]
    ends = ends[(raw[ends] & 0xC0) != 0x80]
    return np.append(ends, len(raw))


def _word_starts(raw: np.ndarray) -> np.ndarray:
    """Numbers of the words begun before each byte, and in all."""
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    begins = ~space
    begins[1:] &= space[:-1]
    return np.concatenate([[0], np.cumsum(begins)])


def _chunked(mean: int):
    """Batches of (tag, text) to one row for each chunk."""

    def rows(parts: list, kind: pa.DataType) -> pa.RecordBatch:
        ids = pa.concat_arrays([pa.repeat(pa.scalar(p[6], kind), len(p[0])) for p in parts])
        tag, seq, start, size, words = (np.concatenate([p[k] for p in parts]) for k in range(5))
        digests = np.frombuffer(b"".join(p[5] for p in parts), dtype=np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays(
            [ids, *[pa.array(x) for x in (tag, seq, start, size, words, digests[:, 0], digests[:, 1])]],
            names=["id", "tag", "seq", "start", "size", "n_words", "digest", "check"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, kind = [], 0, None
        for batch in batches:
            kind = batch.schema.field("id").type
            for i, tag, text in zip(*(batch.column(c).to_pylist() for c in ("id", "tag", "text")), strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                ends = cuts(data, mean)
                if not len(ends):
                    continue
                starts = np.concatenate([[0], ends[:-1]])
                begun = _word_starts(np.frombuffer(data, dtype=np.uint8))
                digests = b"".join(
                    [xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                )
                words = begun[ends] - begun[starts]
                parts.append((np.full(len(ends), tag), np.arange(len(ends)), starts, ends - starts, words, digests, i))
                held += len(ends)
                if held >= _ROWS:
                    yield rows(parts, kind)
                    parts, held = [], 0
        if parts:
            yield rows(parts, kind)

    return run


_CHUNK = "tag long, seq long, start long, size long, n_words long, digest long, check long"
_ROWS = 1 << 17  # chunks sent on together


def chunks(rows: DataFrame, mean: int = MEAN) -> DataFrame:
    """id, tag, seq, start and size in bytes, n_words and two digests of every chunk."""
    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("tag", "id", "text").mapInArrow(_chunked(mean), f"id {kind}, {_CHUNK}")


def passages(
    docs: DataFrame,
    mean: int = MEAN,
    min_words: int = MIN_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """tag, id, start, end, n_words, n_chunks and first_ids of every repeated passage.

    ``start`` and ``end`` count bytes of the text in UTF-8, ``first_ids`` lists the
    documents where the chunks of the passage come first, which may be the document
    itself.  Null and empty texts have no chunks.  Repeated rows repeat each other.  Null
    ids come last, and only rows of equal ids are told apart by their order.  An empty
    table gives no rows.
    """
    return passages_of(identified(docs, id=docs[id_col], text=docs[text_col]), mean, min_words)


def passages_of(rows: DataFrame, mean: int = MEAN, min_words: int = MIN_WORDS) -> DataFrame:
    """``passages`` for rows of tag, id and text."""
    stored = materialize(chunks(rows, mean), "chunks")
    slim = stored.select("tag", "id", "digest", "check", "seq", F.struct("start", "size", "n_words").alias("at"))
    often = stored.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    # both sides are plain shuffles of stored tables, so that adaptive execution can split a
    # chunk that is in very many documents
    named = materialize(slim.join(materialize(often, "digests"), "digest"), "occurrences")
    place = F.min(F.struct(F.col("id").isNull(), "id", "tag", "seq"))
    first = named.groupBy("digest", "check").agg(place.alias("first"), F.count(F.lit(1)).alias("n"))
    first = materialize(first.where("n > 1"), "firsts")
    later = attach(named, first, ["digest", "check"]).where(
        (F.col("tag") != F.col("first.tag")) | (F.col("seq") != F.col("first.seq"))
    )
    # a window holds the chunks of one document
    in_order = Window.partitionBy("tag").orderBy("seq")
    island = later.withColumn("island", F.col("seq") - F.row_number().over(in_order))
    found = island.groupBy("tag", "id", "island").agg(
        F.min("at.start").alias("start"),
        F.max(F.col("at.start") + F.col("at.size")).alias("end"),
        F.sum("at.n_words").alias("n_words"),
        F.count(F.lit(1)).alias("n_chunks"),
        F.sort_array(F.collect_set("first.id")).alias("first_ids"),
    )
    return found.where(F.col("n_words") >= min_words).drop("island")


def drop_passages(
    docs: DataFrame,
    mean: int = MEAN,
    min_words: int = MIN_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with repeated passages cut from their texts; no row goes."""
    stored = materialize(identified(docs, id=docs[id_col], row=F.struct("*")), "documents")
    text = F.col("row").getField(text_col)
    found = passages_of(stored.select("tag", "id", text.alias("text")), mean, min_words)
    return _without(stored, found, text_col)


def _without(stored: DataFrame, found: DataFrame, text_col: str) -> DataFrame:
    """The rows in ``stored`` with the spans in ``found`` cut from their texts."""
    text = F.col("row").getField(text_col)
    spans = found.groupBy("tag").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    # bytes are cut as Latin-1 characters, one for each byte of the UTF-8 form
    raw = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    pieces = F.transform(
        F.sequence(F.lit(0), F.size("spans")),
        lambda k: F.substring(
            raw,
            (F.coalesce(F.get("spans", k - 1)["end"], F.lit(0)) + 1).cast("int"),
            (F.coalesce(F.get("spans", k)["start"], F.length(raw)) - F.coalesce(F.get("spans", k - 1)["end"], F.lit(0))).cast("int"),
        ),
    )
    left = F.decode(F.encode(F.array_join(pieces, ""), "ISO-8859-1"), "UTF-8")
    joined = stored.join(spans, "tag", "left")
    cut = F.col("row").withField(text_col, F.when(F.col("spans").isNull(), text).otherwise(left))
    return joined.select(cut.alias("row")).select("row.*")


# --- exact repeats: anchors chosen in windows, extended by comparing texts ---------------------

ANCHOR = 56  # bytes of an anchor; up to 3 less where it would part a character
WINDOW = 46  # of so many places in a row one at least is an anchor
REACH = ANCHOR + WINDOW  # bytes that an end is extended by; whatever lies further has anchors of its own
_LAST = np.uint64(0xFFFFFFFF)
_SLICE = 1 << 16  # places hashed together, which suit a processor's cache
_TOGETHER = 1 << 18  # bytes of texts joined


def anchors(data: bytes) -> list[tuple[int, int]]:
    """Places and sizes of the anchors of a text in UTF-8.

    In each window of places the one with the least hash is taken, the leftmost of equal
    ones, so that equal stretches of ``ANCHOR + WINDOW - 1`` bytes have an equal anchor
    whatever they consist of.  In periodic text equal anchors follow each other by
    ``WINDOW`` at most, not more densely.  A text shorter than an anchor is one itself.
    """
    _, at, sizes, _, _ = anchors_of([data])
    return list(zip(at.tolist(), sizes.tolist(), strict=True))


def anchors_of(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Text number, place, size and two digests of the anchors of many texts, which are joined and hashed together."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    stops = np.cumsum(lengths)
    begins = stops - lengths
    # zeros stand behind the last text, so that 56 bytes can be read at every place
    raw = np.frombuffer(b"".join([*texts, bytes(ANCHOR)]), dtype=np.uint8)
    least = _least(raw, begins, lengths)
    least = least[(raw[least] & 0xC0) != 0x80]  # else the window is no text
    at = _distinct([least, begins[(lengths > 0) & (lengths <= ANCHOR)]])
    text = np.searchsorted(stops, at, side="right")
    end = np.minimum(at + ANCHOR, stops[text])
    for _ in range(3):
        end -= (end < stops[text]) & (end > at + ANCHOR - 3) & ((raw[end] & 0xC0) == 0x80)
    digest, check = _digests(raw, at, end - at)
    kept = _apart(text, at, stops, digest, check)
    return text[kept], (at - begins[text])[kept], (end - at)[kept], digest[kept], check[kept]


def _least(raw: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places, in order, that have the least hash in a window of their text."""
    places = lengths - ANCHOR + 1
    chosen = [np.empty(0, dtype=np.int64)]
    # starts of windows, in all texts that hold a whole one
    edges = np.zeros(len(raw) + 1, dtype=np.int8)
    full = places >= WINDOW
    edges[begins[full]] += 1
    edges[(begins + places - WINDOW + 1)[full]] -= 1
    window = np.cumsum(edges, dtype=np.int8).view(bool)
    total = len(raw) - ANCHOR
    for start in range(0, total, _SLICE):  # in pieces, with the windows that reach over
        inside = np.flatnonzero(window[start : start + _SLICE])
        if not len(inside):
            continue
        keys = _keys(raw, start, min(start + _SLICE + WINDOW - 1, total))
        width = 1
        while width < WINDOW:
            step = min(width, WINDOW - width)
            keys = np.minimum(keys[:-step], keys[step:])
            width += step
        at = (keys[inside] & _LAST).astype(np.int64) + start
        chosen.append(at[np.concatenate([[True], at[1:] != at[:-1]])])
    for k in np.flatnonzero((places > 1) & ~full):  # all places are one window
        at = int(begins[k])
        chosen.append(np.array([int(_keys(raw, at, at + int(places[k])).min() & _LAST) + at]))
    return _distinct(chosen)


def _distinct(places: list[np.ndarray]) -> np.ndarray:
    """Places in order, each once; they are mostly in order, which a stable sort makes use of."""
    found = np.sort(np.concatenate(places), kind="stable")
    return found[np.concatenate([[True], found[1:] != found[:-1]])[: len(found)]]


def _keys(raw: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Hash and number of each place; the hash is that of its first 16 bytes."""
    hashed = rolling(raw[start : stop + _SPAN - 1])[_SPAN - 1 :] * np.uint32(0x9E3779B1)
    keys = (hashed.astype(np.uint64) << np.uint64(32)) | np.arange(stop - start, dtype=np.uint64)
    keys[(raw[start:stop] & 0xC0) == 0x80] |= _LAST << np.uint64(32)  # no place inside a character
    return keys


def _digests(raw: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits of the bytes at each place and their number."""
    held = np.lib.stride_tricks.sliding_window_view(raw, ANCHOR)
    digests, checks = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int32)]
    for start in range(0, len(at), _SLICE):
        size = sizes[start : start + _SLICE]
        piece = held[at[start : start + _SLICE]]
        short = np.flatnonzero(size < ANCHOR)
        piece[short] *= np.arange(ANCHOR) < size[short, None]
        one = _mixed(size.astype(np.uint64))
        two = one ^ np.uint64(0x5851F42D4C957F2D)
        for word in piece.view("<u8").T:
            one = _mixed(one ^ word)
            two = (two ^ (one >> np.uint64(29))) * np.uint64(0xD1342543DE82EF95) + word
        digests.append(one.view(np.int64))
        checks.append((_mixed(two) >> np.uint64(32)).astype(np.uint32).view(np.int32))
    return np.concatenate(digests), np.concatenate(checks)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a number spread over all bits, one to one."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _apart(text: np.ndarray, at: np.ndarray, stops: np.ndarray, digest: np.ndarray, check: np.ndarray) -> np.ndarray:
    """Whether an anchor stays: of equal ones that follow each other one in each window is enough."""
    kept = np.ones(len(at), dtype=bool)
    same = (text[1:] == text[:-1]) & (digest[1:] == digest[:-1]) & (check[1:] == check[:-1])
    last, before = 0, -1
    for k in (np.flatnonzero(same) + 1).tolist():
        if before != k - 1:
            last = int(at[k - 1])
        before = k
        further = k + 1 < len(at) and text[k + 1] == text[k]
        if (at[k + 1] if further else stops[text[k]]) - last <= WINDOW:
            kept[k] = False
        else:
            last = int(at[k])
    return kept


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed UTF-8, which the joins below move."""
    codec = pa.Codec("zstd")
    for batch in batches:
        texts = [t.encode("utf-8", "surrogatepass") if t else None for t in batch.column("text").to_pylist()]
        packed = [None if t is None else codec.compress(t, asbytes=True) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("tag"), batch.column("id"), pa.array(packed, pa.binary()),
             pa.array([len(t or b"") for t in texts], pa.int64())],
            names=["tag", "id", "packed", "size"],
        )


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each anchor: where it is, its size, a digest of 64 bits and one of 32 more."""
    codec = pa.Codec("zstd")
    for batch in batches:
        packed, sizes = batch.column("packed").to_pylist(), batch.column("size").to_pylist()
        start = held = 0
        for k, size in enumerate(sizes):
            held += size
            if held < _TOGETHER and k + 1 < len(sizes):
                continue
            some = slice(start, k + 1)
            texts = [codec.decompress(t, n, asbytes=True) for t, n in zip(packed[some], sizes[some], strict=True)]
            text, at, length, digest, check = anchors_of(texts)
            rows = batch.slice(start, k + 1 - start).select(["id", "tag"]).take(pa.array(text))
            arrays = (pa.array(at), pa.array(length, pa.int32()), pa.array(digest), pa.array(check))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, *arrays], names=["id", "tag", "at", "size", "digest", "check"]
            )
            start, held = k + 1, 0


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digests of 64 bits alone."""
    for batch in _anchored(batches):
        yield batch.select(["digest"])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts beside the edges of runs, read away from the run, and the words begun before.

    An edge is a place, doubled, with 1 added at the end of a run.  One byte of the run
    comes first there.  One byte over the reach tells whether a character or a word goes on.
    """
    codec = pa.Codec("zstd")

    def made(held: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64())
        arrays = [pa.array(x, k) for x, k in zip(zip(*held, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["tag", "edge", "near", "begun"])

    held = []
    for batch in batches:
        columns = (batch.column(n).to_pylist() for n in ("tag", "packed", "size", "edges"))
        for tag, packed, size, wanted in zip(*columns, strict=True):
            data = codec.decompress(packed, size, asbytes=True)
            starts = _word_starts(np.frombuffer(data, dtype=np.uint8))
            for edge in wanted:
                at, ends = edge >> 1, edge & 1
                near = data[at - 1 : at + REACH + 1] if ends else data[max(at - REACH - 1, 0) : at][::-1]
                held.append((tag, edge, near, int(starts[at])))
            if len(held) >= _ROWS:
                yield made(held)
                held = []
    if held:
        yield made(held)


_BLANK = frozenset(b" \t\n\x0b\x0c\r")


def extended(near: bytes, first: bytes, ends: bool) -> tuple[int, int]:
    """Bytes that an edge moves outwards while both texts agree, and the words begun there."""
    skip = 1 if ends else 0
    limit = min(len(near), len(first), REACH + skip)
    n = next((k for k in range(skip, limit) if near[k] != first[k]), limit)
    if ends:
        while n > 1 and n < len(near) and (near[n] & 0xC0) == 0x80:
            n -= 1
        words = sum(near[k] not in _BLANK and near[k - 1] in _BLANK for k in range(1, n))
        return n - 1, words
    while n and (near[n - 1] & 0xC0) == 0x80:
        n -= 1
    words = sum(near[k] not in _BLANK and (k + 1 == len(near) or near[k + 1] in _BLANK) for k in range(n))
    return n, words


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("edge", "near", "first_near", "begun")]
        places, words = [], []
        for edge, near, first, begun in zip(*columns, strict=True):
            n, w = extended(near, first, bool(edge & 1))
            sign = 1 if edge & 1 else -1
            places.append((edge >> 1) + sign * n)
            words.append(begun + sign * w)
        yield pa.RecordBatch.from_arrays(
            [batch.column("tag"), batch.column("run"), pa.array([e & 1 for e in columns[0]], pa.int64()),
             pa.array(places, pa.int64()), pa.array(words, pa.int64())],
            names=["tag", "run", "ends", "place", "begun"],
        )


def repeats(
    docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Repeated passages to the byte, with the columns of ``passages``.

    A text that comes again has an anchor in common with its first occurrence if it has
    ``ANCHOR + WINDOW - 1`` bytes, which 51 words always have.  A single anchor is enough:
    the passage is extended to both sides while the text equals that of the first
    occurrence, and only then must have ``min_words``.  ``n_chunks`` counts anchors.
    """
    return repeats_of(identified(docs, id=docs[id_col], text=docs[text_col]), min_words)


def drop_repeats(
    docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with what ``repeats`` finds cut from their texts, both ends included; no row goes."""
    stored = materialize(identified(docs, id=docs[id_col], row=F.struct("*")), "documents")
    text = F.col("row").getField(text_col)
    found = repeats_of(stored.select("tag", "id", text.alias("text")), min_words)
    return _without(stored, found, text_col)


def repeats_of(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``repeats`` for rows of tag, id and text."""
    kind = rows.schema["id"].dataType.simpleString()
    packed = rows.select("tag", "id", "text").mapInArrow(_packed, f"tag long, id {kind}, packed binary, size long")
    texts = materialize(packed.where("packed is not null"), "texts")
    # anchors are found twice, which needs less room than storing them
    anchored = texts.mapInArrow(_anchored, f"id {kind}, tag long, at long, size int, digest long, check int")
    counted = texts.mapInArrow(_digested, "digest long")
    often = counted.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    named = materialize(anchored.join(materialize(often, "digests"), "digest"), "occurrences")
    place = F.min(F.struct(F.col("id").isNull(), "id", "tag", "at"))
    first = named.groupBy("digest", "check").agg(place.alias("first"), F.count(F.lit(1)).alias("n"))
    first = materialize(first.where("n > 1").drop("n"), "firsts")
    # plain shuffles of stored tables, as above, so that an anchor in very many documents can be split
    later = named.join(first, ["digest", "check"]).drop("digest", "check").where(
        (F.col("tag") != F.col("first.tag")) | (F.col("at") != F.col("first.at"))
    )
    # anchors that touch, at the same distance from their first occurrences, are one run; a
    # window holds the anchors of one document
    in_order = Window.partitionBy("tag").orderBy("at")
    shift, end = F.col("at") - F.col("first.at"), F.col("at") + F.col("size")
    goes_on = (
        (F.lag("first.tag").over(in_order) == F.col("first.tag"))
        & (F.lag(shift).over(in_order) == shift)
        & (F.lag(end).over(in_order) >= F.col("at"))
    )
    begins = later.withColumn("begins", F.when(goes_on, 0).otherwise(1))
    runs = begins.withColumn("run", F.sum("begins").over(in_order)).groupBy("tag", "run").agg(
        F.first("id").alias("id"),
        F.min("at").alias("start"),
        F.max(end).alias("end"),
        F.first("first.tag").alias("first_tag"),
        F.first("first.id").alias("first_id"),
        F.first(shift).alias("shift"),
        F.count(F.lit(1)).alias("n_chunks"),
    )
    runs = materialize(runs, "runs")

    def edges(start, end):
        return F.explode(F.array(start * 2, end * 2 + 1))

    there = F.col("start") - F.col("shift"), F.col("end") - F.col("shift")
    wanted = runs.select("tag", edges(F.col("start"), F.col("end")).alias("edge")).union(
        runs.select(F.col("first_tag").alias("tag"), edges(*there).alias("edge"))
    )
    wanted = materialize(wanted.groupBy("tag").agg(F.collect_set("edge").alias("edges")), "edges")
    near = texts.select("tag", "packed", "size").join(wanted, "tag")
    near = near.mapInArrow(_near, "tag long, edge long, near binary, begun long")
    near = materialize(near, "near")
    sides = runs.select("tag", "run", "first_tag", "shift", edges(F.col("start"), F.col("end")).alias("edge"))
    sides = sides.withColumn("first_edge", F.col("edge") - F.col("shift") * 2).drop("shift").join(near, ["tag", "edge"])
    at_first = near.select(
        F.col("tag").alias("first_tag"), F.col("edge").alias("first_edge"), F.col("near").alias("first_near")
    )
    sides = attach(sides, at_first, ["first_tag", "first_edge"])
    moved = sides.select("tag", "run", "edge", "near", "first_near", "begun").mapInArrow(
        _extended, "tag long, run long, ends long, place long, begun long"
    )
    bounds = moved.groupBy("tag", "run").agg(
        F.min("place").alias("start"), F.max("place").alias("end"),
        F.min("begun").alias("before"), F.max("begun").alias("until"),
    )
    whole = runs.drop("start", "end", "first_tag", "shift").join(bounds, ["tag", "run"])
    # runs that overlap or touch are one passage
    so_far = Window.partitionBy("tag").orderBy("start", "run")
    reached = F.max("end").over(so_far.rowsBetween(Window.unboundedPreceding, -1))
    apart = whole.withColumn("apart", F.when(reached >= F.col("start"), 0).otherwise(1))
    found = apart.withColumn("island", F.sum("apart").over(so_far)).groupBy("tag", "id", "island").agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        (F.max("until") - F.min("before")).alias("n_words"),
        F.sum("n_chunks").alias("n_chunks"),
        F.sort_array(F.collect_set("first_id")).alias("first_ids"),
    )
    return found.where(F.col("n_words") >= min_words).drop("island")
