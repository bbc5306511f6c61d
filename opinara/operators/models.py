"""Training, scoring and judging the one-vs-rest classifiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions import hash_bucket, positive_probability
from opinara.operators.many_models import cross_validate_all
from opinara.operators.words import counted_once

# Fixed values of the two models.
MAX_ITERATIONS = 10
REG_PARAMS = (1.0,)
FOLDS = 5
SEED = 17


@dataclass(frozen=True)
class Target:
    """A 0/1 label column and the probability above which it is predicted."""

    label: str
    threshold: float


POSITIVE = Target("poslabel", 0.2)
NEGATIVE = Target("neglabel", 0.25)
TARGETS = {"pos": POSITIVE, "neg": NEGATIVE}


def hash_split(
    df: DataFrame, key: str, fraction: float = 0.5, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts by the key's hash; the same key always goes the same way."""
    steps = 10_000
    chosen = hash_bucket(F.col(key), steps, seed) < F.lit(round(fraction * steps))
    return df.where(chosen), df.where(~chosen)


def _classifier(target: Target, max_iter: int) -> LogisticRegression:
    return LogisticRegression(
        labelCol=target.label,
        featuresCol="features",
        maxIter=max_iter,
        threshold=target.threshold,
    )


def fold_of(key: str, folds: int = FOLDS, seed: int = SEED) -> Column:
    """The cross-validation fold of a row, by its key's hash."""
    return hash_bucket(F.col(key), folds, seed + 1)


def cross_validate(
    features: DataFrame,
    target: Target,
    reg_params: Sequence[float] = REG_PARAMS,
    max_iter: int = MAX_ITERATIONS,
    folds: int = FOLDS,
    seed: int = SEED,
    key: str = "id",
    parallelism: int = 2,
) -> CrossValidatorModel:
    """Choose the regularisation by area under the ROC curve over hashed folds.

    Folds by hash instead of by ``rand``: each fold is filtered out of the
    table anew, and a fold that changed between two readings would leak. The
    evaluator reads the target's own 0/1 label.
    """
    classifier = _classifier(target, max_iter)
    grid = ParamGridBuilder().addGrid(classifier.regParam, list(reg_params)).build()
    validator = CrossValidator(
        estimator=classifier,
        estimatorParamMaps=grid,
        evaluator=BinaryClassificationEvaluator(labelCol=target.label, numBins=0),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    )
    rows = features.select("features", target.label, fold_of(key, folds, seed).alias("fold"))
    return validator.fit(rows)


def choose_reg_params(
    vectors: DataFrame,
    targets: Mapping[str, Target],
    reg_params: Sequence[float] = REG_PARAMS,
    folds: int = FOLDS,
    seed: int = SEED,
    key: str = "id",
) -> dict[str, float]:
    """For each target the penalty with the largest mean area over the folds.

    All targets, values and folds are fitted in one optimisation. Folds without an area,
    for want of a class, do not count; equal means go by the order of ``reg_params``.
    """
    if len(reg_params) == 1:
        return dict.fromkeys(targets, reg_params[0])
    if folds < 2:
        raise ValueError("several reg_params need two folds or more to choose by")
    labels = {name: target.label for name, target in targets.items()}
    rows = vectors.withColumn("fold", fold_of(key, folds, seed))
    found, _ = cross_validate_all(rows, labels, reg_params, folds, most_steps=MAX_ITERATIONS)
    means = found.groupBy("model", "reg_param").agg(F.avg("auc").alias("auc")).collect()
    by_value = {(r.model, r.reg_param): r.auc if r.auc is not None else -1.0 for r in means}
    return {name: max(reg_params, key=lambda reg: by_value[name, float(reg)]) for name in targets}


def train(
    features: DataFrame,
    vectoriser: CountVectorizerModel,
    target: Target,
    reg_params: Sequence[float] = REG_PARAMS,
    max_iter: int = MAX_ITERATIONS,
    folds: int = FOLDS,
    seed: int = SEED,
    key: str = "id",
) -> PipelineModel:
    """Vectoriser and the classifier fitted to its vectors, as one model.

    With one value of ``reg_params`` there is nothing to choose: the best model of a
    cross-validation is the one fitted to all rows, and that alone is fitted.
    """
    if folds < 2 and len(reg_params) != 1:
        raise ValueError("several reg_params need two folds or more to choose by")
    if len(reg_params) > 1:
        fitted = cross_validate(features, target, reg_params, max_iter, folds, seed, key).bestModel
    else:
        classifier = _classifier(target, max_iter).setRegParam(reg_params[0])
        fitted = classifier.fit(features.select("features", target.label))
    return PipelineModel(stages=[vectoriser, fitted])


def score(df: DataFrame, models: Mapping[str, PipelineModel], words: str = "words") -> DataFrame:
    """Add each model's 0.0/1.0 prediction, and its probability vector, in one pass.

    Models with the same fitted vectoriser share the vectors too. Rows without
    words get no prediction. Later filters stay above the scoring.
    """
    kept = [F.col(c) for c in df.columns]
    has_words = F.col(words).isNotNull()
    scored = df.withColumn("_words", F.coalesce(words, F.array().cast("array<string>")))
    vectors: dict[str, str] = {}
    added = []
    for name, model in models.items():
        vectoriser, classifier = model.stages
        fitted = vectoriser.uid
        if fitted not in vectors:
            vectors[fitted] = f"_features_{len(vectors)}"
            columns = {vectoriser.inputCol: "_words", vectoriser.outputCol: vectors[fitted]}
            scored = vectoriser.copy(columns).transform(scored)
        columns = {
            classifier.featuresCol: vectors[fitted],
            classifier.rawPredictionCol: f"_raw_{name}",
            classifier.probabilityCol: f"{name}_probability",
            classifier.predictionCol: name,
        }
        scored = classifier.copy(columns).transform(scored)
        added += [
            F.when(has_words, F.col(column)).alias(column)
            for column in (name, f"{name}_probability")
        ]
    return counted_once(scored.select(*kept, *added), "score")


def with_probability(scored: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace each probability vector by the probability of class 1."""
    return scored.withColumns(
        {
            f"{name}_probability": positive_probability(F.col(f"{name}_probability"))
            for name in names
        }
    )
