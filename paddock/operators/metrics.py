"""Classifier metrics as aggregations.

Whatever needs the rows in score order works on counts per distinct score, and
accumulates them with the chunked windows of ``ordered``: no metric sorts all rows
in one task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.operators.ordered import CHUNK_ROWS, Past, lay_out, prior
from paddock.scratch import materialize

# Fixed value: probabilities are kept this far from 0 and 1 (double precision epsilon).
EPSILON = 2.220446049250313e-16


def hit(prediction: str, actual: str) -> Column:
    """1.0 where the prediction is right; a missing value is wrong."""
    right = F.coalesce(F.col(prediction) == F.col(actual), F.lit(False))
    return right.cast("double")


def accuracy(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row with the accuracy of each named (prediction, actual) pair."""
    return df.agg(*[F.avg(hit(*pair)).alias(name) for name, pair in pairs.items()])


def accuracy_by_year(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    return df.groupBy("year").agg(
        *[F.avg(hit(*pair)).alias(name) for name, pair in pairs.items()],
        F.count(F.lit(1)).alias("samples"),
    )


def _cells(prediction: str, actual: str) -> list[Column]:
    """Counts by class and prediction; ``missed0`` and ``missed1`` have none."""
    p, a = F.col(prediction).cast("boolean"), F.col(actual).cast("boolean")
    cases = {"tn": ~a & ~p, "fp": ~a & p, "fn": a & ~p, "tp": a & p}
    cases |= {"missed0": ~a & p.isNull(), "missed1": a & p.isNull()}
    return [F.count_if(case).alias(name) for name, case in cases.items()]


def confusion_matrix(df: DataFrame, prediction: str, actual: str) -> DataFrame:
    """Six rows: actual, predicted (NULL where it is missing), rows; 0 if none occur.

    Rows without a label are left out.
    """
    return df.agg(*_cells(prediction, actual)).selectExpr(
        "stack(6, false, false, tn, false, true, fp, false, NULL, missed0, "
        "true, false, fn, true, true, tp, true, NULL, missed1) AS (actual, predicted, n_rows)"
    )


def classification_report(df: DataFrame, prediction: str, actual: str) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and averages.

    A missing prediction is wrong for the class of its row; rows without a label are
    left out.
    """

    def share(part: str, whole: str) -> str:
        return f"CASE WHEN {whole} > 0 THEN CAST({part} AS DOUBLE) / ({whole}) ELSE 0D END"

    def f1(label: str) -> str:
        return (
            f"CASE WHEN p{label} + r{label} > 0 "
            f"THEN 2 * p{label} * r{label} / (p{label} + r{label}) ELSE 0D END AS f{label}"
        )

    sizes = df.agg(*_cells(prediction, actual)).selectExpr(
        "*", "tn + fp + missed0 AS n0", "tp + fn + missed1 AS n1"
    )
    counts = sizes.selectExpr(
        "*",
        share("tn", "tn + fn") + " AS p0",
        share("tn", "n0") + " AS r0",
        share("tp", "tp + fp") + " AS p1",
        share("tp", "n1") + " AS r1",
        "n0 + n1 AS n",
        share("tn + tp", "n0 + n1") + " AS correct",
    ).selectExpr("*", f1("0"), f1("1"))
    weighted = {
        m: share(f"({m}0 * n0 + {m}1 * n1)", "n") for m in ("p", "r", "f")
    }
    return counts.selectExpr(
        "stack(5, "
        "'false', p0, r0, f0, n0, "
        "'true', p1, r1, f1, n1, "
        "'accuracy', correct, correct, correct, n, "
        "'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n, "
        f"'weighted avg', {weighted['p']}, {weighted['r']}, {weighted['f']}, n"
        ") AS (label, precision, recall, f1, support)"
    )


def _scored_and_labelled(score: str, actual: str) -> Column:
    return F.col(score).isNotNull() & F.col(actual).isNotNull()


def log_loss(probability: str, actual: str) -> Column:
    """Aggregate: mean negative log likelihood of boolean labels.

    Rows without a probability or a label are left out, as for the area.
    """
    p = F.least(F.greatest(F.col(probability), F.lit(EPSILON)), F.lit(1 - EPSILON))
    y = F.col(actual).cast("int")
    loss = F.when(y == 1, -F.log(p)).otherwise(-F.log(1 - p))
    return F.avg(F.when(_scored_and_labelled(probability, actual), loss))


def score_counts(df: DataFrame, score: str, actual: str) -> DataFrame:
    """Positives and negatives per distinct score, stored for the ordered steps."""
    y = F.col(actual).cast("int")
    counts = (
        df.where(_scored_and_labelled(score, actual))
        .groupBy(F.col(score).alias("score"))
        .agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
        .select(F.lit(0).alias("series"), "score", "pos", "neg")
    )
    return materialize(counts, "score_counts")


def _below(counts: DataFrame, chunk_rows: int) -> DataFrame:
    """Add the positives, negatives and distinct scores below each score."""
    wanted = {
        "pos_below": Past("sum", "pos"),
        "neg_below": Past("sum", "neg"),
        "rank": Past("count"),
    }
    laid = lay_out(counts, ["series"], ["score"], chunk_rows)
    return prior(laid, wanted).fillna(0, subset=["pos_below", "neg_below"])


def roc_auc_of_counts(counts: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Exact area under the ROC curve: the rank-sum form, ties counting one half.

    One row; the area is 1.0 by convention where only one class occurs.
    """
    pairs = F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0)
    sums = _below(counts, chunk_rows).agg(
        F.sum(pairs).alias("pairs"),
        F.sum(F.col("pos").cast("double")).alias("pos"),
        F.sum(F.col("neg").cast("double")).alias("neg"),
    )
    both = (F.col("pos") > 0) & (F.col("neg") > 0)
    area = F.when(both, F.col("pairs") / (F.col("pos") * F.col("neg")))
    return sums.select(F.coalesce(area, F.lit(1.0)).alias("roc_auc"))


def roc_auc(df: DataFrame, score: str, actual: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    return roc_auc_of_counts(score_counts(df, score, actual), chunk_rows)


def pr_curve(df: DataFrame, score: str, actual: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Precision and recall of ``score >= threshold`` at every distinct score."""
    return _curve(score_counts(df, score, actual), chunk_rows).select(
        "threshold", "precision", "recall"
    )


def _curve(counts: DataFrame, chunk_rows: int) -> DataFrame:
    total = counts.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).first()
    positives, negatives = total["pos"] or 0, total["neg"] or 0
    tp = F.lit(positives) - F.col("pos_below")
    fp = F.lit(negatives) - F.col("neg_below")
    recall = tp.cast("double") / positives if positives else F.lit(1.0)
    return _below(counts, chunk_rows).select(
        "rank",
        F.col("score").alias("threshold"),
        (tp.cast("double") / (tp + fp)).alias("precision"),
        recall.alias("recall"),
    )


def pr_at_threshold(
    df: DataFrame, score: str, actual: str, threshold: float = 0.5, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Precision and recall at a threshold, and at the middle of the curve.

    The middle element of the curve is a published statistic of its own; it is not
    the point of any fixed probability.  The curve ends with precision 1, recall 0.
    """
    counts = score_counts(df, score, actual)
    chosen = F.col("score") >= threshold
    at = counts.agg(
        F.sum(F.when(chosen, F.col("pos")).otherwise(0)).cast("double").alias("tp"),
        F.sum(F.when(chosen, F.col("neg")).otherwise(0)).cast("double").alias("fp"),
        F.sum("pos").cast("double").alias("pos"),
        F.count(F.lit(1)).alias("points"),
    ).select(
        F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp")))
        .otherwise(0.0)
        .alias("precision"),
        F.when(F.col("pos") > 0, F.col("tp") / F.col("pos")).otherwise(0.0).alias("recall"),
        F.floor((F.col("points") + 1) / 2).alias("middle"),
    )
    curve = _curve(counts, chunk_rows).select(
        F.col("rank").alias("middle"),
        F.col("precision").alias("middle_precision"),
        F.col("recall").alias("middle_recall"),
    )
    return at.join(curve, "middle", "left").select(
        "precision",
        "recall",
        F.coalesce("middle_precision", F.lit(1.0)).alias("middle_precision"),
        F.coalesce("middle_recall", F.lit(0.0)).alias("middle_recall"),
    )


def binary_metrics(
    df: DataFrame, prediction: str, probability: str, actual: str, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """One row: accuracy, ROC-AUC, log-loss, positive rate, rows.

    With one class only, ROC-AUC is 1.0 and log-loss 0.0 by convention.  Both look at the
    rows that have a probability and a label.
    """
    positive = F.avg(F.col(actual).cast("double"))
    flat = df.agg(
        F.avg(hit(prediction, actual)).alias("accuracy"),
        log_loss(probability, actual).alias("log_loss"),
        positive.alias("positive_rate"),
        F.avg(F.when(_scored_and_labelled(probability, actual), F.col(actual).cast("double"))).alias("scored_rate"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    area = roc_auc(df, probability, actual, chunk_rows)
    # two rows, each with its own columns, become one
    both = flat.unionByName(area, allowMissingColumns=True)
    row = both.agg(*[F.max(c).alias(c) for c in both.columns])
    one_class = F.coalesce(F.col("scored_rate").isin(0.0, 1.0), F.lit(True))
    return row.select(
        "accuracy",
        "roc_auc",
        F.when(one_class, F.lit(0.0)).otherwise(F.col("log_loss")).alias("log_loss"),
        "positive_rate",
        "n_rows",
    )


def score_histogram(df: DataFrame, score: str, bins: int = 10) -> DataFrame:
    """Rows per equal-width bin of a probability, for bins that occur."""
    number = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n_rows"))
