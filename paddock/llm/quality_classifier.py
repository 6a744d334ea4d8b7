"""Quality classifier: naive Bayes support vectors on n-gram indicators.

Indicators of words, word pairs, byte triples and repetitions of a word in a row, hashed into
2^17 places, are scaled by
the log ratio of their smoothed counts in the two classes.  A linear model with hinge loss
is fitted to the scaled indicators by dual coordinate descent, and its margin becomes a
probability by a logistic curve.

The counts cover all labelled rows of the training part.  The linear model is fitted to at
most about ``SAMPLE`` of them, chosen by a hash of the id, so that the fit is one task of
bounded size.  Scoring is a pass over the whole texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

PLACES = 1 << 17
SAMPLE = 8_000
FOLDS = 5
THRESHOLD = 0.3
EPOCHS = 15
COST = 1.0
SMOOTHING = 1.0

_KEEP_WORDS = 1 << 20
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_SHIFT = np.uint64(64 - 17)
_TWICE, _THRICE = PLACES - 1, PLACES - 2


class Indicators:
    """Sorted places of the n-grams of a text; one object for each task."""

    def __init__(self):
        self.seen = np.zeros(PLACES, dtype=bool)
        self.words: dict[bytes, int] = {}

    def _code(self, word: bytes) -> int:
        code = self.words.get(word)
        if code is None:
            if len(self.words) >= _KEEP_WORDS:
                self.words.clear()
            code = self.words[word] = xxhash.xxh64_intdigest(word) - (1 << 63)
        return code

    def of(self, text: str | None) -> np.ndarray:
        data = (text or "").encode("utf-8", "surrogatepass")
        split = data.split()
        if not split:
            return np.empty(0, dtype=np.int32)
        codes = np.fromiter(map(self._code, split), dtype=np.int64, count=len(split)).view(np.uint64)
        self._mark((codes * _A) >> _SHIFT)
        self._mark(((codes[:-1] * _B + codes[1:]) * _A) >> _SHIFT)
        # pairs and triples of one word, whichever it is
        twice = codes[1:] == codes[:-1]
        if twice.any():
            self.seen[_TWICE] = True
            self.seen[_THRICE] |= bool((twice[1:] & twice[:-1]).any())
        raw = np.frombuffer(data, dtype=np.uint8).astype(np.uint64)
        triples = raw[:-2] | (raw[1:-1] << np.uint64(8)) | (raw[2:] << np.uint64(16))
        self._mark((triples * _C) >> _SHIFT)
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        return found.astype(np.int32)

    def _mark(self, places: np.ndarray) -> None:
        self.seen[places.astype(np.int64)] = True


def fold(id_value: Column) -> Column:
    """CRC-32 of the id as text, modulo the folds; 1 for a null id."""
    return F.coalesce(F.crc32(id_value.cast("string")) % FOLDS, F.lit(1))


@dataclass(frozen=True)
class Model:
    """weights of the places, bias, and the logistic curve over the margin."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, places: np.ndarray) -> float:
        size = np.sqrt(max(1, len(places)))
        margin = self.weights[places].sum() / size + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500))))


def _counted(share: float):
    """Batches of (text, label, draw) to class counts by place, and the drawn rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indicators = Indicators()
        counts = np.zeros((2, PLACES), dtype=np.int64)
        rows = np.zeros(2, dtype=np.int64)
        for batch in batches:
            texts, labels, draws = (batch.column(c).to_pylist() for c in ("text", "label", "draw"))
            taken = []
            for text, label, draw in zip(texts, labels, draws, strict=True):
                places = indicators.of(text)
                counts[label, places] += 1
                rows[label] += 1
                if draw < share:
                    taken.append((label, draw, places))
            if taken:
                yield _sampled(taken)
        some = np.flatnonzero(counts.any(axis=0))
        # the rows themselves are counted at one place beyond the last
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(some, PLACES).astype(np.int32)),
                pa.array(np.append(counts[0, some], rows[0])),
                pa.array(np.append(counts[1, some], rows[1])),
                pa.nulls(len(some) + 1, pa.float64()),
                pa.nulls(len(some) + 1, pa.list_(pa.int32())),
            ],
            names=_COLUMNS,
        )

    return run


_COLUMNS = ["place", "bad", "good", "draw", "places"]
_COUNTED = "place int, bad long, good long, draw double, places array<int>"


def _sampled(taken: list[tuple]) -> pa.RecordBatch:
    labels = np.array([t[0] for t in taken], dtype=np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.nulls(len(taken), pa.int32()),
            pa.array(1 - labels),
            pa.array(labels),
            pa.array([t[1] for t in taken], pa.float64()),
            pa.array([t[2] for t in taken], pa.list_(pa.int32())),
        ],
        names=_COLUMNS,
    )


def log_ratios(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Log ratio of the smoothed shares of every place in the two classes."""
    p, q = good + SMOOTHING, bad + SMOOTHING
    return np.log(p / p.sum()) - np.log(q / q.sum())


def descend(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model by dual coordinate descent.

    A row is the scaled indicators over the root of their number, and a constant 1.  The
    classes weigh the same in total.  Rows come in a seeded random order in each epoch.
    """
    signs = np.where(labels > 0, 1.0, -1.0)
    share = np.array([max(1, (labels == k).sum()) for k in (0, 1)])
    most = COST * len(labels) / (2 * share[labels])
    scaled = [ratios[r] / np.sqrt(max(1, len(r))) for r in rows]
    norms = np.array([float(s @ s) + 1 for s in scaled])
    weights, bias, duals = np.zeros(PLACES), 0.0, np.zeros(len(rows))
    order = np.random.default_rng(11)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in order.permutation(len(rows)):
            gradient = signs[i] * (weights[rows[i]] @ scaled[i] + bias) - 1
            new = min(max(duals[i] - gradient / norms[i], 0.0), most[i])
            step = (new - duals[i]) * signs[i]
            if step:
                weights[rows[i]] += step * scaled[i]
                bias += step
                duals[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights * ratios, bias


def logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope >= 0 and shift of the logistic curve, by Newton steps on smoothed targets."""
    good, bad = (labels > 0).sum(), (labels == 0).sum()
    target = np.where(labels > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    at = np.array([1.0, 0.0])
    design = np.column_stack([margins, np.ones(len(margins))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (p - target))
        at = at - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(at[0]), 0.0), float(at[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Model from the rows whose id is in ``labels`` (doc_id, quality) and not held out.

    Without labels of both classes the model is the share of good ones.  Null labels and
    ids are left out; several labels of an id all count.
    """
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("label")).where(
        "label in (0, 1) and doc_id is not null"
    )
    usable = usable.where(fold(F.col("doc_id")) != 0)
    total = usable.count()
    share = min(1.0, sample / max(1, total))
    # 52 bits of a digest as a number in [0, 1)
    draw = F.conv(F.substring(F.md5(F.concat(F.lit("fit:"), F.col("doc_id").cast("string"))), 1, 13), 16, 10)
    # one plan for every number of labels: a broadcast would hold for few of them only
    joined = docs.select("doc_id", "text").join(usable.hint("merge"), "doc_id")
    rows = joined.select("text", "label", (draw.cast("double") / float(1 << 52)).alias("draw"))
    counted = materialize(rows.mapInArrow(_counted(share), _COUNTED), "indicator_counts")
    # at most PLACES + 1 rows, and about ``sample`` rows: bounded whatever the input
    sums = counted.where("place is not null").groupBy("place").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    table = sums.toArrow()
    counts = np.zeros((2, PLACES + 1))
    for k, name in enumerate(("bad", "good")):
        counts[k, table.column("place").to_numpy()] = table.column(name).to_numpy()
    bad, good = counts[:, PLACES]
    prior = float(np.log((good + 1) / (bad + 1)))
    if not (bad and good):
        return Model(np.zeros(PLACES), 0.0, 0.0, prior)
    ratios = log_ratios(counts[0, :PLACES], counts[1, :PLACES])
    drawn = counted.where("place is null").select("good", "draw", "places")
    return _fitted(drawn, ratios, prior)


def _fitted(drawn: DataFrame, ratios: np.ndarray, prior: float) -> Model:
    """Fits in one task, which gets the bounded sample only; a fifth of it sets the curve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(
            (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("draw", "good", "places")), strict=True)),
            key=lambda r: r[0],
        )
        places = [np.array(r[2], dtype=np.int64) for r in rows]
        labels = np.array([r[1] for r in rows], dtype=np.int64)
        curve = np.arange(len(rows)) % 5 == 4
        own = [p for p, c in zip(places, curve, strict=True) if not c]
        if len(set(labels[~curve])) < 2 or len(set(labels[curve])) < 2:
            weights, bias, slope, shift = np.zeros(PLACES), 0.0, 0.0, prior
        else:
            weights, bias = descend(own, labels[~curve], ratios)
            margins = np.array(
                [weights[p].sum() / np.sqrt(max(1, len(p))) + bias for p, c in zip(places, curve, strict=True) if c]
            )
            slope, shift = logistic(margins, labels[curve])
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights], pa.list_(pa.float64())), *[pa.array([x]) for x in (bias, slope, shift)]],
            names=["weights", "bias", "slope", "shift"],
        )

    fitted = drawn.coalesce(1).mapInArrow(run, "weights array<double>, bias double, slope double, shift double")
    rows = fitted.toArrow().to_pylist()
    if not rows:
        return Model(np.zeros(PLACES), 0.0, 0.0, prior)
    return Model(np.array(rows[0]["weights"]), *(rows[0][k] for k in ("bias", "slope", "shift")))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, from its text alone.

    Null and empty texts get the score of no indicators.  Null ids are not held out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2^17 weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indicators = Indicators()
        for batch in batches:
            scores = [sent.value.score(indicators.of(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"),
    )
