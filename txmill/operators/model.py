"""Fitting, tuning, scoring and saving Spark ML classifiers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txmill.functions.hashing import fold_of
from txmill.operators.features import LABEL, RAW_VECTOR, VECTOR
from txmill.operators.metrics import area_under_roc, classification_metrics
from txmill.operators.split import SEED
from txmill.sources.scratch import scratch_path

# The forest, the grid searched, and the number of folds.
NUM_TREES = 10
MAX_DEPTH = 5
NUM_TREES_OPTIONS = (10, 20)
MAX_DEPTH_OPTIONS = (5, 10)
FOLDS = 3
AUC_BINS = 1000


@dataclass(frozen=True)
class Grid:
    """Values of the forest's parameters to try."""

    num_trees: Sequence[int] = NUM_TREES_OPTIONS
    max_depth: Sequence[int] = MAX_DEPTH_OPTIONS


def build_classifier(model_type: str = "rf", *, label: str = LABEL, seed: int = SEED):
    """``rf``: random forest; ``lr``: logistic regression."""
    if model_type == "rf":
        return RandomForestClassifier(
            labelCol=label, featuresCol=VECTOR, numTrees=NUM_TREES, maxDepth=MAX_DEPTH, seed=seed
        )
    if model_type == "lr":
        return LogisticRegression(labelCol=label, featuresCol=VECTOR)
    raise ValueError(f"model type must be 'rf' or 'lr', not {model_type!r}")


def build_scaler() -> StandardScaler:
    return StandardScaler(inputCol=RAW_VECTOR, outputCol=VECTOR, withMean=True, withStd=True)


def build_stages(columns: Sequence[str], classifier) -> Pipeline:
    """Assemble, standardise, classify."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(columns), outputCol=RAW_VECTOR),
            build_scaler(),
            classifier,
        ]
    )


def param_grid(classifier, grid: Grid | None = None) -> list:
    """All combinations for a forest; one empty combination for other classifiers."""
    options = grid or Grid()
    builder = ParamGridBuilder()
    if isinstance(classifier, RandomForestClassifier):
        builder.addGrid(classifier.numTrees, list(options.num_trees))
        builder.addGrid(classifier.maxDepth, list(options.max_depth))
    return builder.build()


def auc_evaluator(
    label: str = LABEL, score: str = "rawPrediction", bins: int = AUC_BINS
) -> BinaryClassificationEvaluator:
    """Area under ROC; the default number of bins approximates it, 0 is exact."""
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=score, numBins=bins)


def with_fold(df: DataFrame, key: str, folds: int = FOLDS, seed: int = SEED) -> DataFrame:
    """Add ``fold``, 0..folds-1, by a hash of the key."""
    return df.withColumn("fold", fold_of(key, folds, seed))


def laid_out(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """With ``partitions``, always dealt out and sorted by the key; without, never touched.

    A forest samples rows per partition. Dealt out like this, the same rows give the same model
    whatever the files and the number of cores. A plain scan of many files is split by both.
    """
    if partitions is None:
        return df
    return df.repartition(partitions, key).sortWithinPartitions(key)


def training_table(
    train: DataFrame,
    columns: Sequence[str],
    key: str,
    *,
    label: str = LABEL,
    folds: int = FOLDS,
    seed: int = SEED,
) -> DataFrame:
    """Key, features, label and fold, stored in the shared folder; reads ``train`` once."""
    needed = list(dict.fromkeys([key, *columns, label]))
    folded = with_fold(train.select(*needed), key, folds, seed)
    path = scratch_path(train.sparkSession, "training")
    folded.write.parquet(path)
    return train.sparkSession.read.schema(folded.schema).parquet(path)


def cross_validate(
    train: DataFrame,
    columns: Sequence[str],
    key: str,
    *,
    model_type: str = "rf",
    label: str = LABEL,
    folds: int = FOLDS,
    grid: Grid | None = None,
    seed: int = SEED,
    parallelism: int = 4,
    partitions: int | None = None,
) -> CrossValidatorModel:
    """Choose the parameters with the best mean AUC over the folds and refit on all of ``train``.

    Runs at once. Folds come from the key's hash, so they are the same in every layout. ``train`` is
    read once, into a narrow table in the shared folder that all fits scan; a table that already has
    a column ``fold`` is taken as such a one. With ``partitions`` its rows are laid out by key and
    held, so they are dealt out once.
    """
    classifier = build_classifier(model_type, label=label, seed=seed)
    validator = CrossValidator(
        estimator=build_stages(columns, classifier),
        estimatorParamMaps=param_grid(classifier, grid),
        evaluator=auc_evaluator(label),
        numFolds=folds,
        foldCol="fold",
        seed=seed,
        parallelism=parallelism,
    )
    if "fold" not in train.columns:
        train = training_table(train, columns, key, label=label, folds=folds, seed=seed)
    # The validator holds both sides of a fold while it fits them; the refit reads the whole.
    rows = laid_out(train, key, partitions).select(*columns, label, "fold")
    if partitions is None:
        return validator.fit(rows)
    rows = rows.persist()
    try:
        return validator.fit(rows)
    finally:
        rows.unpersist()


def best_parameters(model: PipelineModel) -> dict[str, int | None]:
    """Trees and depth of the fitted forest; None for a classifier that has neither."""
    fitted = model.stages[-1]
    trees = getattr(fitted, "getNumTrees", None)
    depth = fitted.getMaxDepth() if hasattr(fitted, "getMaxDepth") else None
    return {"best_numTrees": trees, "best_maxDepth": depth}


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``rawPrediction``, ``probability`` and ``prediction``."""
    return model.transform(df)


def evaluate(
    predictions: DataFrame, label: str = LABEL, *, exact_auc: bool = False
) -> dict[str, float | None]:
    """AUC, accuracy and weighted F1 of scored rows; runs at once.

    AUC is None unless both classes occur: Spark's evaluator would report 0 or 1 then. The evaluator
    puts scores into bins; ``exact_auc`` counts every pair, so that a strict comparison of two
    models does not hang on the bins.
    """
    needed = predictions.select(label, "rawPrediction", "prediction").persist()
    try:
        counts = needed.agg(
            F.min(label).alias("lowest"), F.max(label).alias("highest")
        ).first()
        values = classification_metrics(needed, label).first()
        two_classes = counts["lowest"] != counts["highest"]
        if exact_auc:
            scored = needed.withColumn("score", F.get(vector_to_array("rawPrediction"), F.lit(1)))
            auc = area_under_roc(scored, label).first()["auc"]
        else:
            auc = auc_evaluator(label).evaluate(needed) if two_classes else None
        return {"auc": auc, "accuracy": values["accuracy"], "f1": values["f1"]}
    finally:
        needed.unpersist()


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
