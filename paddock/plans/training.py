"""Training, storing and applying the two classifiers with Spark ML."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.operators import forest as large
from paddock.operators.metrics import (
    binary_metrics,
    classification_report,
    confusion_matrix,
    pr_at_threshold,
)
from paddock.operators.preprocess import class_weights, impute, median_values, scales
from paddock.plans.features import FEATURES
from paddock.scratch import collect_garbage, materialize, new_path, recorded, release
from paddock.sources import files

log = logging.getLogger(__name__)

# Model name -> (target column, stored name).
MODELS = {
    "top10": ("target_top_10", "top10_classifier"),
    "dnf": ("target_dnf", "dnf_classifier"),
}
TREES, DEPTH, SEED = 100, 10, 42

_INPUT = "model_input"
# rows a task holds of the training table, 24 numbers each, until there are so many tasks: for
# every level each of them sends the histograms of all nodes, however few rows it holds
PARTITION_ROWS, MOST_PARTITIONS = 25_000, 36
# rows times trees up to which Spark ML grows a forest: for each of them it holds a count and a
# node, and writes the nodes again for every level
TREE_ROWS = 300_000_000
# forests that the trees of larger tables are kept in
MOST_FORESTS = 4


def _preparation(train: DataFrame, columns: Sequence[str]) -> SQLTransformer:
    """Median imputation and scaling with the numbers of the training rows."""
    fill = median_values(train, columns)
    scale = scales(impute(train, fill), columns)

    def prepared(c: str) -> str:
        # to 12 digits, as the last ones depend on the order of addition
        mean, std = (float(f"{x:.12g}") for x in scale[c])
        std = std if std > 0 else 1.0
        return (
            f"(coalesce(CAST(`{c}` AS DOUBLE), CAST({fill[c]!r} AS DOUBLE)) "
            f"- CAST({mean!r} AS DOUBLE)) / CAST({std!r} AS DOUBLE) AS `_in_{c}`"
        )

    return SQLTransformer(
        statement=f"SELECT *, {', '.join(prepared(c) for c in columns)} FROM __THIS__"
    )


def train(
    rows: DataFrame,
    target: str,
    columns: Sequence[str] = FEATURES,
    trees: int = TREES,
    depth: int = DEPTH,
    seed: int = SEED,
    partition_rows: int = PARTITION_ROWS,
    key: str = "result_id",
    tree_rows: int = TREE_ROWS,
) -> PipelineModel:
    """Impute, scale, assemble and fit a class-balanced random forest.

    ``rows`` is read several times; hand in a stored table.  The draws of a forest follow the
    partitions and their order.  Both follow from the key (the features, where there is no
    such column) and the number of rows alone, so that a cluster of any size and input split
    in any way give the same forest.  Over ``tree_rows`` rows times trees, the trees are grown
    by ``operators.forest``, each on all rows, and kept in several forests, which ``score`` and
    ``importances`` take as one.
    """
    known = rows.where(F.col(target).isNotNull())
    preparation = _preparation(known, columns)
    assembler = VectorAssembler(
        inputCols=[f"_in_{c}" for c in columns], outputCol=_INPUT, handleInvalid="keep"
    )
    weights = class_weights(known, target).collect()
    # in steps of 2^-20: sums of such weights are exact, in whatever order they are added
    by_label = {row["label"]: max(1, round(row["weight"] * 2**20)) / 2**20 for row in weights}
    weight = F.lit(1.0)
    for value, exact in by_label.items():
        weight = F.when(F.col(target) == F.lit(value), F.lit(exact)).otherwise(weight)
    place = [key] if key in rows.columns else list(columns)
    total = sum(row["n_rows"] for row in weights)
    parts = min(MOST_PARTITIONS, max(1, -(-total // partition_rows)))
    kept = known.select(*dict.fromkeys([*place, *columns, target]))
    # an explicit number of partitions is not changed by adaptive execution; the rows travel
    # as they are, once for all passes of the forest, and are prepared where they lie
    placed = kept.repartition(parts, *place).sortWithinPartitions(*kept.columns).persist()
    prepared = preparation.transform(placed)
    label = F.col(target).cast("double").alias("_label")
    together = min(trees, max(1, tree_rows // max(1, total)))
    groups = min(MOST_FORESTS, -(-trees // together))
    sizes = [trees // groups + (k < trees % groups) for k in range(groups)]

    def forest(number: int, size: int) -> RandomForestClassifier:
        alone = groups == 1
        return RandomForestClassifier(
            featuresCol=_INPUT,
            labelCol="_label",
            weightCol="_weight",
            rawPredictionCol="rawPrediction" if alone else "",
            probabilityCol="probability" if alone else f"_probability_{number}",
            predictionCol="prediction" if alone else "",
            numTrees=size,
            maxDepth=depth,
            maxBins=large.BINS,
            featureSubsetStrategy="sqrt",
            # a partition draws by the seed and its number
            seed=seed,
            # keep each row's node instead of walking all trees again for every level; few levels
            # need no copy of it in the checkpoint folder
            cacheNodeIds=True,
            checkpointInterval=-1,
            maxMemoryInMB=512,
        )

    try:
        if groups == 1:
            # the copy has no summary, which would hold the placed rows and their files
            inputs = assembler.transform(prepared).select(_INPUT, label, weight.alias("_weight"))
            fitted = [forest(0, trees).fit(inputs).copy()]
            del inputs
        else:
            inputs = prepared.select(*[f"_in_{c}" for c in columns], label)
            by_class = [by_label.get(bool(c), 1.0) for c in range(max(by_label) + 1)]
            estimators = [forest(k, size) for k, size in enumerate(sizes)]
            fitted = _grown(inputs, placed, estimators, by_class)
            del inputs
    finally:
        placed.unpersist()
    del placed, prepared
    # a forest leaves the histograms of all its levels on disk
    collect_garbage(rows.sparkSession)
    return PipelineModel([preparation, assembler, *fitted])


def _grown(
    inputs: DataFrame, placed: DataFrame, estimators: Sequence[RandomForestClassifier], weights: Sequence[float]
) -> list[RandomForestClassificationModel]:
    """Forests of the prepared rows for each estimator, whose trees are grown together."""
    spark, first = inputs.sparkSession, estimators[0]
    *features, label = inputs.columns
    cuts = large.cut_points(inputs, features)
    packed = large.pack(inputs, features, label, cuts).persist()
    try:
        # the rows as they came are not read again
        packed.count()
        placed.unpersist()
        trees = large.grow(
            packed, len(features), weights, sum(e.getNumTrees() for e in estimators), first.getMaxDepth(), first.getSeed()
        )
    finally:
        packed.unpersist()
    del packed
    collect_garbage(spark)
    fitted, begin = [], 0
    for estimator in estimators:
        some = trees[begin : begin + estimator.getNumTrees()]
        begin += len(some)
        with recorded([]) as stored:
            fitted.append(large.model(spark, estimator, some, cuts, weights, new_path(spark, "forest")))
        release(spark, stored)
    return fitted


def _forests(model: PipelineModel) -> list[RandomForestClassificationModel]:
    return [s for s in model.stages if isinstance(s, RandomForestClassificationModel)]


def importances(
    model: PipelineModel, columns: Sequence[str] = FEATURES, k: int | None = None
) -> DataFrame:
    """(feature, importance), most important first; the first ``k`` if given."""
    spark = SparkSession.active()
    forests = _forests(model)
    if len(forests) == 1:
        values = forests[0].featureImportances.toArray().tolist()
    else:
        # as for one forest: those of each tree sum up to 1, or to 0 if it has no split
        trees = sum(t.featureImportances.toArray() for forest in forests for t in forest.trees)
        values = (trees / (trees.sum() or 1.0)).tolist()
    pairs = sorted(zip(columns, values), key=lambda pair: (-pair[1], pair[0]))
    return spark.createDataFrame(pairs[:k], "feature string, importance double")


def save(model: PipelineModel, folder: str, name: str) -> str:
    path = f"{folder}/{MODELS[name][1]}"
    model.write().overwrite().save(path)
    return path


def load_all(spark: SparkSession, folder: str) -> dict[str, PipelineModel]:
    """The stored models; one may be missing, but not both."""
    found = {}
    for name, (_, stored) in MODELS.items():
        path = f"{folder}/{stored}"
        if files.exists(spark, path):
            found[name] = PipelineModel.load(path)
        else:
            log.warning("no model at %s", path)
    if not found:
        raise FileNotFoundError(f"no trained models in {folder}")
    return found


def score(rows: DataFrame, models: Mapping[str, PipelineModel]) -> DataFrame:
    """Add probability and prediction of every available model.

    The probability is that of the last class the model knows: the positive class,
    or the only one if training saw one class.
    """
    out = rows
    for name in MODELS:
        if name not in models:
            log.warning("no %s model, its predictions are left out", name)
            continue
        kept = out.columns
        probability, prediction = _answers(models[name])
        out = models[name].transform(out).select(
            *kept,
            F.element_at(probability, -1).alias(f"{name}_probability"),
            prediction.cast("boolean").alias(f"{name}_prediction"),
        )
    return out


def _answers(model: PipelineModel) -> tuple[Column, Column]:
    """Probabilities of the classes, and the likeliest class."""
    forests = _forests(model)
    if len(forests) == 1:
        return vector_to_array("probability"), F.col("prediction")
    total = sum(forest.getNumTrees for forest in forests)

    def share(forest: RandomForestClassificationModel) -> Column:
        return F.transform(vector_to_array(forest.getProbabilityCol()), lambda p: p * forest.getNumTrees)

    votes = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), map(share, forests))
    # the first of equal ones, as in one forest
    return F.transform(votes, lambda v: v / total), F.array_position(votes, F.array_max(votes)) - 1


def saw_one_class(model: PipelineModel) -> bool:
    """Whether training knew a single class: every tree is one pure leaf."""
    forests = _forests(model)
    if forests[0].numClasses == 1:
        return True
    if any(forest.totalNumNodes > forest.getNumTrees for forest in forests):
        return False
    return all(t._java_obj.rootNode().impurity() == 0.0 for forest in forests for t in forest.trees)


def metrics(scored: DataFrame, name: str, one_class: bool = False) -> DataFrame:
    """Metrics of a model; if it knows one class only, its scores cannot be ranked."""
    table = binary_metrics(scored, f"{name}_prediction", f"{name}_probability", MODELS[name][0])
    if one_class:
        table = table.withColumns({"roc_auc": F.lit(1.0), "log_loss": F.lit(0.0)})
    return table


def train_metrics(model: PipelineModel, name: str, frames: Mapping[str, DataFrame]) -> DataFrame:
    """Metrics of one model on each of the given splits, one row per split."""
    parts = [
        metrics(materialize(score(frame, {name: model}), "scored"), name).select(
            F.lit(split).alias("split"), "*"
        )
        for split, frame in frames.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def evaluate_all(
    rows: DataFrame, models: Mapping[str, PipelineModel], scored: DataFrame | None = None
) -> DataFrame:
    """One row of metrics per available model on the same rows; they may be scored already."""
    if scored is None:
        scored = materialize(score(rows, models), "scored")
    parts = [
        metrics(scored, n, saw_one_class(models[n])).select(F.lit(n).alias("model"), "*")
        for n in MODELS
        if n in models
    ]
    return reduce(DataFrame.unionByName, parts)


def evaluation_report(scored: DataFrame, names: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """(model, section, name, value) of stored scored rows, for each named model.

    Sections are the classification report, the confusion matrix, and precision and
    recall at the threshold and in the middle of the curve.
    """
    parts = []
    for model in names:
        prediction, probability, target = (
            f"{model}_prediction", f"{model}_probability", MODELS[model][0],
        )
        report = classification_report(scored, prediction, target).selectExpr(
            "'report' AS section",
            "stack(4, concat(label, ' precision'), precision, concat(label, ' recall'), recall, "
            "concat(label, ' f1'), f1, concat(label, ' support'), CAST(support AS DOUBLE)) "
            "AS (name, value)",
        )
        cells = confusion_matrix(scored, prediction, target).selectExpr(
            "'confusion' AS section",
            "concat('actual ', actual, ' predicted ', coalesce(CAST(predicted AS STRING), 'missing')) AS name",
            "CAST(n_rows AS DOUBLE) AS value",
        )
        curve = pr_at_threshold(scored, probability, target, threshold).selectExpr(
            "'curve' AS section",
            "stack(4, 'precision', precision, 'recall', recall, "
            "'middle precision', middle_precision, 'middle recall', middle_recall) AS (name, value)",
        )
        parts += [part.select(F.lit(model).alias("model"), "*") for part in (report, cells, curve)]
    return reduce(DataFrame.unionByName, parts)
