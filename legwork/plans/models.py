"""Model registry over MLlib, feature importances."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    OneVsRest,
    OneVsRestModel,
)
from pyspark.ml.feature import StandardScaler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legwork.plans.boosting import HistogramBoosting
from legwork.plans.forest import HistogramForest
from legwork.plans.kernel import FourierFeatures, RadialFeatures

SEED = 42
FEATURES, LABEL = "features", "label"


def _columns(features: str = FEATURES) -> dict:
    return {"featuresCol": features, "labelCol": LABEL}


def _scaled(estimator: Estimator) -> Pipeline:
    scaler = StandardScaler(inputCol=FEATURES, outputCol="scaled", withMean=False, withStd=True)
    return Pipeline(stages=[scaler, estimator])


def logistic_regression(**params) -> Estimator:
    return LogisticRegression(**_columns(), **{"maxIter": 3000, "standardization": False, **params})


def logistic_regression_pipeline(**params) -> Estimator:
    return _scaled(LogisticRegression(**_columns("scaled"), **{"maxIter": 3000, "standardization": False, **params}))


def random_forest(**params) -> Estimator:
    defaults = {"numTrees": 200, "maxDepth": 16, "minInstancesPerNode": 10, "seed": SEED}
    return HistogramForest(**_columns(), **{**defaults, **params})


def hist_gradient_boosting(**params) -> Estimator:
    """Boosted trees that stop when the loss on a tenth of the rows stalls."""
    defaults = {"stepSize": 0.08, "maxIter": 300, "maxDepth": 5, "minInstancesPerNode": 20, "priors": True, "heldOut": True}
    return HistogramBoosting(**_columns(), **{"seed": SEED, "minHessian": 1e-3, **defaults, **params})


def xgboost(**params) -> Estimator:
    """Boosted trees with an L2 weight: all rounds on all rows."""
    defaults = {"stepSize": 0.06, "maxIter": 400, "maxDepth": 7, "l2": 10.0, "minHessian": 1.0, "hessianFactor": 2.0}
    return HistogramBoosting(**_columns(), **{"seed": SEED, "subsamplingRate": 1.0, "columnRate": 1.0, **defaults, **params})


def naive_bayes(**params) -> Estimator:
    return NaiveBayes(**_columns(), modelType="gaussian", **params)


class OneVersusRest(OneVsRest):
    """One classifier per class; the rows are not held in memory a second time beside the classifier's own copy."""

    def _fit(self, dataset: DataFrame) -> OneVsRestModel:
        label, features, machine = self.getLabelCol(), self.getFeaturesCol(), self.getClassifier()
        weight = self.getWeightCol() if self.isDefined(self.weightCol) else None
        kept = dataset.select(label, features, *([weight] if weight else []))
        classes = int(dataset.agg(F.max(label)).first()[0]) + 1
        fitted = []
        for c in range(classes):
            own = kept.withColumn("_own", (F.col(label) == c).cast("double"))
            given = {machine.labelCol: "_own", machine.featuresCol: features, machine.predictionCol: self.getPredictionCol()}
            fitted.append(machine.fit(own, {**given, **({machine.weightCol: weight} if weight else {})}))
        return self._copyValues(OneVsRestModel(models=fitted))


def svc(kernel: str = "rbf", gamma: str | float = "scale", components: int = 512, **params) -> Estimator:
    """Support vectors, one class against the rest; the radial kernel stands on random Fourier features."""
    if kernel not in ("rbf", "linear"):
        raise ValueError(f"Unsupported kernel: {kernel}")
    column = "scaled" if kernel == "linear" else "radial"
    machine = LinearSVC(**_columns(column), **{"regParam": 0.01 if kernel == "linear" else 1e-4, "maxIter": 100, **params})
    pipeline = _scaled(OneVersusRest(classifier=machine, **_columns(column)))
    if kernel == "linear":
        return pipeline
    scaler, classes = pipeline.getStages()
    rule = {"rule": gamma} if isinstance(gamma, str) else {"gamma": float(gamma)}
    radial = RadialFeatures(inputCol="scaled", outputCol=column, components=components, seed=SEED, **rule)
    return Pipeline(stages=[scaler, radial, classes])


def decision_tree(**params) -> Estimator:
    return DecisionTreeClassifier(**_columns(), **{"maxDepth": 20, "seed": SEED, **params})


def neural_network(layers: list[int] | None = None, hidden=(512, 128, 32), inputs: int = 0, classes: int = 4, **params) -> Estimator:
    """Feed-forward net; ``inputs`` is the length of the feature vector."""
    sizes = layers or [inputs, *hidden, classes]
    return MultilayerPerceptronClassifier(**_columns(), layers=sizes, **{"maxIter": 30, "seed": SEED, **params})


MODELS: dict[str, Callable[..., Estimator]] = {
    "logistic_regression": logistic_regression,
    "logistic_regression_pipeline": logistic_regression_pipeline,
    "random_forest": random_forest,
    "hist_gradient_boosting": hist_gradient_boosting,
    "xgboost": xgboost,
    "naive_bayes": naive_bayes,
    "svc": svc,
    "support_vector_classifier": svc,
    "decision_tree": decision_tree,
    "neural_network": neural_network,
}
# predicted without a fit, see operators.evaluate
RULES = ("dummy", "Baseline")


def make_model(name: str, **params) -> Estimator:
    """The estimator of that name; an unknown name raises."""
    if name not in MODELS:
        raise ValueError(f"Unsupported model: {name}")
    return MODELS[name](**params)


def with_weights(estimator: Estimator, weight_column: str | None) -> Estimator:
    """Uses the row weight where the (innermost) estimator knows one."""
    if weight_column is None:
        return estimator
    if isinstance(estimator, Pipeline):
        stages = estimator.getStages()
        return Pipeline(stages=[*stages[:-1], with_weights(stages[-1], weight_column)])
    if isinstance(estimator, OneVsRest):
        estimator.setWeightCol(weight_column)
    elif estimator.hasParam("weightCol"):
        estimator.set(estimator.getParam("weightCol"), weight_column)
    return estimator


def _weights_of(model: Model) -> np.ndarray | None:
    if isinstance(model, PipelineModel):
        if any(isinstance(stage, FourierFeatures) for stage in model.stages):
            return None  # the weights are those of cosines
        return _weights_of(model.stages[-1])
    if hasattr(model, "featureImportances"):
        return model.featureImportances.toArray()
    if hasattr(model, "coefficientMatrix"):
        return np.abs(model.coefficientMatrix.toArray()).sum(axis=0)
    if hasattr(model, "layers") and hasattr(model, "weights"):
        sizes = model.getLayers()
        first = model.weights.toArray()[: sizes[0] * sizes[1]]
        # the weight matrix is stored column by column, one column per input
        return np.abs(first.reshape(sizes[0], sizes[1])).sum(axis=1)
    if hasattr(model, "models"):
        parts = [_weights_of(m) for m in model.models]
        known = [p for p in parts if p is not None]
        return np.sum(known, axis=0) if known else None
    if hasattr(model, "coefficients"):
        return np.abs(model.coefficients.toArray())
    return None


def feature_importances(spark: SparkSession, model: Model, names: list[str], top: int | None = None) -> DataFrame:
    """(feature, importance) with shares that add to 1, largest first; empty if unknown."""
    weights = _weights_of(model)
    rows = []
    if weights is not None:
        total = float(weights.sum()) or 1.0
        rows = sorted(((n, float(w) / total) for n, w in zip(names, weights)), key=lambda r: (-r[1], r[0]))[:top]
    return spark.createDataFrame(rows, "feature string, importance double")
