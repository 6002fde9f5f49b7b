"""Model fits and the search over them."""

from pyspark.sql import functions as F

from legwork.operators import evaluate
from legwork.plans import models, training, tuning
from legwork.registry.base import query
from legwork.registry.feature_rows import feature_rows
from legwork.schemas import DELAY_CLASSES


#: Prepared rows per application and input; they stand in the shared folder.
_PREPARED: dict[tuple[str, str], training.Prepared] = {}


def _prepared(spark, d):
    key = (spark.sparkContext.applicationId, d)
    if key not in _PREPARED:
        _PREPARED[key] = training.prepare(feature_rows(spark, d), training.TrainingConfig())
    return _PREPARED[key]


def _scores(spark, d, name, **params):
    scored, _ = training.predict(_prepared(spark, d), name, **params)
    metrics = training.split_metrics(scored, name, name)
    return metrics.select("model_name", "split", "metric", F.round("value", 6).alias("value"))


@query("model_dummy")
def model_dummy(spark, d):
    return _scores(spark, d, "dummy")


@query("model_rule")
def model_rule(spark, d):
    return _scores(spark, d, "Baseline")


@query("logreg")
def logreg(spark, d):
    return _scores(spark, d, "logistic_regression")


@query("logreg_scaled")
def logreg_scaled(spark, d):
    return _scores(spark, d, "logistic_regression_pipeline")


@query("forest")
def forest(spark, d):
    return _scores(spark, d, "random_forest")


@query("boosted")
def boosted(spark, d):
    return _scores(spark, d, "hist_gradient_boosting")


@query("xgboost")
def xgboost(spark, d):
    return _scores(spark, d, "xgboost")


@query("bayes")
def bayes(spark, d):
    return _scores(spark, d, "naive_bayes")


@query("svc_linear")
def svc_linear(spark, d):
    return _scores(spark, d, "svc", kernel="linear")


@query("svc_radial")
def svc_radial(spark, d):
    return _scores(spark, d, "svc")


@query("mlp")
def mlp(spark, d):
    return _scores(spark, d, "neural_network")


@query("tree")
def tree(spark, d):
    return _scores(spark, d, "decision_tree")


@query("importances")
def importances(spark, d):
    prepared = _prepared(spark, d)
    model = training.fit_model(prepared, "random_forest")
    return models.feature_importances(spark, model, prepared.names, 30)


@query("model_comparison")
def model_comparison(spark, d):
    names = ["logistic_regression", "naive_bayes", "decision_tree", "random_forest", "hist_gradient_boosting"]
    return training.compare_models(_prepared(spark, d), names)


@query("model_auc")
def model_auc(spark, d):
    from pyspark.ml.functions import vector_to_array

    scored, _ = training.predict(_prepared(spark, d), "naive_bayes")
    shares = vector_to_array("probability")
    test = scored.filter("split = 'test'").select(
        F.col("label").cast("int").alias("label"), *[shares[c].alias(f"p{c}") for c in range(len(DELAY_CLASSES))])
    return evaluate.roc_auc_ovr(test, "label", {c: F.col(f"p{c}") for c in range(len(DELAY_CLASSES))})


@query("random_search")
def random_search(spark, d):
    rows = feature_rows(spark, d)
    return tuning.random_search(
        _prepared(spark, d), "logistic_regression", rows, "CRSDepDateTime_UTC", "FlightID",
        n_iter=3, folds=3,
    )
