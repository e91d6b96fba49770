"""Churn models on pyspark.ml: one fitted pipeline serves training, comparison and scoring."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell import fixed_values as fixed
from keepwell.functions.ladders import lookup
from keepwell.operators.mlprep import binary_metrics, fill_categories
from keepwell.operators.ranking import rank_auc, stratified_split
from keepwell.plans.medians import ExactMedianImputer

ID = "customer_id"
FLAG = "never_purchased"
_NUMERIC = [*fixed.NUMERIC_FEATURES, FLAG]
_SEED = fixed.SPLIT_SEED
# Weight of churners in the second boosted candidate.
POSITIVE_WEIGHT = 2.4


def model_frame(features: DataFrame) -> DataFrame:
    """Model input: missing categories named, and the never-purchased code replaced by NULL plus a flag."""
    never = F.col("days_since_last_purchase") >= fixed.NEVER_PURCHASED_DAYS
    prepared = fill_categories(features).withColumns(
        {
            FLAG: never.cast("double"),
            "days_since_last_purchase": F.when(~never, F.col("days_since_last_purchase")),
        }
    )
    return prepared.select(
        ID, fixed.LABEL, *[F.col(c).cast("double").alias(c) for c in _NUMERIC], *fixed.CATEGORICAL_FEATURES
    )


def split_frame(features: DataFrame) -> DataFrame:
    return stratified_split(model_frame(features), fixed.LABEL, ID, fixed.SPLIT_SHARES, _SEED)


def with_weights(train: DataFrame) -> DataFrame:
    """Balanced weight n / (2 n_class), and the fixed weight of the weighted candidate."""
    counts = {row[fixed.LABEL]: row["count"] for row in train.groupBy(fixed.LABEL).count().collect()}
    total = sum(counts.values())
    balanced = {label: total / (len(counts) * n) for label, n in counts.items()}
    return train.withColumns(
        {
            "balanced_weight": lookup(F.col(fixed.LABEL), balanced, 1.0),
            "positive_weight": lookup(F.col(fixed.LABEL), {1: POSITIVE_WEIGHT}, 1.0),
        }
    )


def _logistic(rows: int) -> Estimator:
    return LogisticRegression(
        featuresCol="features", labelCol=fixed.LABEL, weightCol="balanced_weight",
        regParam=1.0 / max(rows, 1), maxIter=1000,
    )


def _forest(rows: int) -> Estimator:
    return RandomForestClassifier(
        featuresCol="features", labelCol=fixed.LABEL, weightCol="balanced_weight",
        numTrees=100, maxDepth=10, seed=_SEED,
    )


def _boosted(rows: int) -> Estimator:
    return GBTClassifier(
        featuresCol="features", labelCol=fixed.LABEL, maxIter=100, maxDepth=5, stepSize=0.1, seed=_SEED
    )


def _boosted_weighted(rows: int) -> Estimator:
    return GBTClassifier(
        featuresCol="features", labelCol=fixed.LABEL, weightCol="positive_weight",
        maxIter=100, maxDepth=5, stepSize=0.1, seed=_SEED,
    )


CANDIDATES: dict[str, Callable[[int], Estimator]] = {
    "logistic_regression": _logistic,
    "random_forest": _forest,
    "gradient_boosting": _boosted,
    # stands in for the gradient boosting library that Spark does not ship
    "gradient_boosting_weighted": _boosted_weighted,
}


def preparation() -> list:
    """Median imputation, one-hot encoding, scaling; levels unseen in training encode as all zeros."""
    categories = list(fixed.CATEGORICAL_FEATURES)
    return [
        ExactMedianImputer(inputCols=_NUMERIC, outputCols=[f"{c}_filled" for c in _NUMERIC]),
        StringIndexer(
            inputCols=categories, outputCols=[f"{c}_index" for c in categories],
            stringOrderType="alphabetAsc", handleInvalid="keep",
        ),
        OneHotEncoder(
            inputCols=[f"{c}_index" for c in categories], outputCols=[f"{c}_levels" for c in categories], dropLast=True
        ),
        VectorAssembler(inputCols=[f"{c}_filled" for c in _NUMERIC], outputCol="numeric"),
        StandardScaler(inputCol="numeric", outputCol="scaled", withMean=True),
        VectorAssembler(inputCols=["scaled", *[f"{c}_levels" for c in categories]], outputCol="features"),
    ]


@dataclass(frozen=True)
class Trained:
    name: str
    model: PipelineModel
    metrics: DataFrame
    path: str
    predictions: DataFrame


def fit_preparation(train: DataFrame) -> PipelineModel:
    return Pipeline(stages=preparation()).fit(train)


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def train_candidates(
    names: Sequence[str], prepared: PipelineModel, split: DataFrame, train: DataFrame, rows: int, base: str
) -> list[Trained]:
    """Fit candidates on the training rows, store each, and measure it on every split.

    The rows are prepared once for all of them. A boosted model is hundreds of short jobs one after the other, so
    the candidates are fitted side by side. Predictions and measures are stored: what follows reads them.
    """
    ready = prepared.transform(train).select("features", fixed.LABEL, "balanced_weight", "positive_weight").persist()

    def one(name: str) -> Trained:
        path = f"{base}/{name}"
        PipelineModel(stages=[*prepared.stages, CANDIDATES[name](rows).fit(ready)]).write().overwrite().save(path)
        # as stored it is without the training's summary, whose session no task can take once it has observed a frame
        model = PipelineModel.load(path)
        predictions = _stored(predict(model, split), f"{path}-predictions")
        return Trained(name, model, _stored(evaluate(predictions, name), f"{path}-metrics"), path, predictions)

    try:
        with ThreadPoolExecutor(max_workers=len(names)) as pool:
            return list(pool.map(one, names))
    finally:
        ready.unpersist()


def predict(model: PipelineModel, frame: DataFrame) -> DataFrame:
    scored = model.transform(frame)
    return scored.select(
        ID,
        fixed.LABEL,
        *[c for c in ("split",) if c in frame.columns],
        vector_to_array("probability")[1].alias("ml_churn_probability"),
        F.col("prediction").cast("int").alias("ml_prediction"),
    )


def evaluate(predictions: DataFrame, name: str) -> DataFrame:
    metrics = binary_metrics(predictions, fixed.LABEL, "ml_prediction", ["split"])
    auc = rank_auc(predictions, "ml_churn_probability", fixed.LABEL, ["split"]).select("split", "roc_auc")
    return metrics.join(auc, "split", "left").select(
        F.lit(name).alias("model"), "split", "f1", "accuracy", "precision", "recall", "roc_auc", "tp", "fp", "fn", "tn"
    )


def run_record(trained: Trained) -> DataFrame:
    """A row per split for the run table: parameters, metrics, where the model is stored."""
    classifier = trained.model.stages[-1]
    parameters = {p.name: str(v) for p, v in classifier.extractParamMap().items()}
    return trained.metrics.withColumns(
        {
            "parameters": F.lit(json.dumps(parameters, sort_keys=True)),
            "model_path": F.lit(trained.path),
        }
    )


def leaderboard(metrics: DataFrame) -> DataFrame:
    """Candidates by validation F1; test figures are reported, not used for the choice."""

    def of(split: str, name: str):
        return F.max(F.when(F.col("split") == split, F.col(name)))

    return (
        metrics.groupBy("model")
        .agg(
            of("validation", "f1").alias("validation_f1"),
            *[
                of("test", name).alias(f"test_{name}")
                for name in ("f1", "accuracy", "precision", "recall", "roc_auc")
            ],
        )
        .orderBy(F.desc("validation_f1"), "model")
    )


def feature_names(transformed: DataFrame) -> list[str]:
    """Names of the slots of the feature vector, from its metadata."""
    attributes = transformed.schema["features"].metadata["ml_attr"]["attrs"]
    slots = {a["idx"]: a["name"] for group in attributes.values() for a in group}
    numeric = dict(enumerate(_NUMERIC))
    categories = {f"{c}_levels": c for c in fixed.CATEGORICAL_FEATURES}

    def readable(index: int, name: str) -> str:
        if index in numeric:
            return numeric[index]
        for prefix, column in categories.items():
            if name.startswith(f"{prefix}_"):
                return f"{column}={name.removeprefix(f'{prefix}_')}"
        return name

    return [readable(i, slots[i]) for i in sorted(slots)]


def feature_importance(model: PipelineModel, frame: DataFrame, n: int = 15) -> DataFrame:
    """The n weightiest features with the running share of the total."""
    names = feature_names(model.transform(frame))
    classifier = model.stages[-1]
    if hasattr(classifier, "featureImportances"):
        weights = classifier.featureImportances.toArray()
        signs = [1.0] * len(weights)
    else:
        coefficients = classifier.coefficients.toArray()
        weights, signs = abs(coefficients), [1.0 if c >= 0 else -1.0 for c in coefficients]
    total = float(sum(weights)) or 1.0
    ranked = sorted(zip(names, weights, signs), key=lambda item: (-item[1], item[0]))
    rows, running = [], 0.0
    for position, (name, weight, sign) in enumerate(ranked[:n], start=1):
        running += float(weight)
        rows.append((position, name, float(weight), sign, running / total))
    return frame.sparkSession.createDataFrame(
        rows, "position int, feature string, importance double, direction double, cumulative_share double"
    )
