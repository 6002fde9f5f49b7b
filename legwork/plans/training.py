"""Feature table -> split, scale, encode, weight, fit, score, record."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field, fields
from datetime import datetime, timezone

from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legwork import schemas
from legwork.functions.times import minute_of_day
from legwork.operators import encode, evaluate, scale, split, target
from legwork.plans import tuning
from legwork.plans.models import FEATURES, LABEL, RULES, feature_importances, make_model, with_weights
from legwork.session import cut_lineage, cut_to_table, even_parts
from legwork.sources import sinks


@dataclass(frozen=True)
class TrainingConfig:
    model_name: str = "hist_gradient_boosting"
    delay_column: str = schemas.DELAY_COLUMN
    target_column: str = schemas.TARGET_COLUMN
    time_column: str = schemas.TIME_COLUMN
    id_column: str = "FlightID"
    sample_frac: float = 1.0
    weights: dict[int, float] | str | None = "balanced"
    scaling: str = "minmax"
    train_size: float = 0.7
    val_size: float = 0.15
    time_threshold: str | None = None
    model_params: dict = field(default_factory=dict)
    tune: bool = False
    n_iter: int = 20
    cv_splits: int = 3
    store_tuned: bool = True


@dataclass
class Prepared:
    """Encoded rows with ``split``, ``label``, ``weight`` and the feature vector."""

    rows: DataFrame
    names: list[str]
    scaler: DataFrame
    weights: DataFrame


def sample_rows(df: DataFrame, config: TrainingConfig) -> DataFrame:
    return df if config.sample_frac >= 1.0 else split.hash_sample(df, config.id_column, config.sample_frac)


def label_and_split(features: DataFrame, config: TrainingConfig) -> DataFrame:
    rows = target.add_delay_class(sample_rows(features, config), config.delay_column, config.target_column)
    if config.time_threshold is not None:
        return split.threshold_split(rows, config.time_column, config.time_threshold)
    return split.chronological_split(
        rows, config.time_column, config.id_column, config.train_size, config.val_size
    )


def encode_rows(
    rows: DataFrame, config: TrainingConfig, parts: int | None = None
) -> tuple[DataFrame, list[str], DataFrame, list[str]]:
    """Fits category dictionary and scaler on the train split and applies them to every row.

    With ``parts`` the rows are dealt to as many before that, when they are narrowest. Categories
    become sparse vectors. Returns the rows with their numbers and vectors, the names of the
    elements in order, the scaler, and the columns to assemble.
    """
    present = set(rows.columns)
    scaled = [c for c in schemas.SCALED_COLUMNS if c in present]
    plain = [c for c in schemas.UNSCALED_NUMERIC + schemas.FLAG_COLUMNS + schemas.THREE_VALUED_COLUMNS if c in present]
    hot = [c for c in schemas.ONE_HOT_COLUMNS if c in present]
    rows = rows.withColumns(
        {c: minute_of_day(F.col(c)) for c in schemas.TIME_OF_DAY_COLUMNS if c in present}
    )
    kept = rows.select(
        config.id_column, "split", config.target_column, *hot, *scaled, *plain,
        *([F.col(schemas.RULE_FEATURE).alias("_rule")] if schemas.RULE_FEATURE in present else []),
    )
    train = kept.filter("split = 'train'")
    dictionary = cut_to_table(encode.fit_dictionary(train, hot), "categories")
    params = scale.fit_scaler(train, scaled, config.scaling)
    dealt = kept if parts is None else kept.repartition(parts)
    coded = scale.apply_scaler(dealt, params, scaled).fillna(0.0, subset=scaled + plain)
    coded, vectors = encode.one_hot_vectors(coded, dictionary, hot)
    order = {c: i for i, c in enumerate(hot)}
    # a name per element of the feature vector, as many as a fitted model has weights
    shown = sorted(dictionary.collect(), key=lambda r: (order[r["column"]], r["index"]))
    names = scaled + plain + [f"{r['column']}_{r['value']}" for r in shown]
    return target.encode_label(coded, config.target_column, LABEL), names, params, scaled + plain + vectors


def prepare(features: DataFrame, config: TrainingConfig) -> Prepared:
    """Everything up to the fit; the encoded rows are written once, in even parts, all models read them.

    ``features`` should be a stored table: cuts, dictionary and scaler each read a few of its columns.
    A recorded feature that the table lacks is left out with a warning.
    """
    found = schemas.check_columns(features.columns)
    lost = [c for c in found["missing"] if c in schemas.FEATURE_COLUMNS]
    if lost:
        warnings.warn(f"The table has no column {', '.join(lost)}", stacklevel=2)
    rows = label_and_split(features, config)
    # a stored table has few large files, which would leave most tasks of a fit without rows
    parts = even_parts(features, features.count())
    coded, names, params, columns = encode_rows(rows, config, parts)
    assembler = VectorAssembler(inputCols=columns, outputCol=FEATURES, handleInvalid="error")
    extra = ["_rule"] if "_rule" in coded.columns else []
    vectors = assembler.transform(coded).select(config.id_column, "split", LABEL, FEATURES, *extra)
    train = target.encode_label(rows.filter("split = 'train'"), config.target_column, LABEL)
    weights = cut_lineage(target.class_weights(train, LABEL, config.weights))
    weighted = target.add_row_weight(vectors, weights)
    if len(names) > encode.FEW_VALUES:  # a join of categories may have dealt the rows by their values
        weighted = weighted.repartition(parts)
    stored = cut_to_table(weighted, "prepared")
    return Prepared(stored, names, params, weights)


def fit_model(prepared: Prepared, name: str, **params) -> Model:
    if name == "neural_network":
        params = {"inputs": len(prepared.names), "classes": len(schemas.DELAY_CLASSES), **params}
    estimator = with_weights(make_model(name, **params), "weight")
    return estimator.fit(prepared.rows.filter("split = 'train'"))


def predict(prepared: Prepared, name: str, **params) -> tuple[DataFrame, Model | None]:
    """Rows with ``prediction``; the two rules need no fit."""
    if name == "dummy":
        answer = evaluate.majority_class(prepared.rows.filter("split = 'train'"))
        return prepared.rows.withColumn("prediction", answer), None
    if name == "Baseline":
        return prepared.rows.withColumn("prediction", evaluate.rule_class(F.col("_rule"))), None
    model = fit_model(prepared, name, **params)
    return model.transform(prepared.rows), model


def split_metrics(scored: DataFrame, run_id: str, model_name: str) -> DataFrame:
    """(run_id, model_name, split, metric, value) from one pass over the scored rows."""
    counts = evaluate.pair_counts(scored, ["split"])
    headline = evaluate.headline_metrics(evaluate.per_class(counts, ["split"]), ["split"])
    long = evaluate.long_metrics(headline, ["split"])
    return long.select(F.lit(run_id).alias("run_id"), F.lit(model_name).alias("model_name"), "split", "metric", "value")


def run_training(features: DataFrame, config: TrainingConfig, output: str | None = None) -> DataFrame:
    """Trains and scores one model; with ``output`` the run is written below it.

    With ``tune`` the settings and class weights come from a random search on time folds of
    the train split, and the first candidate is fitted again on all of it. Returns the long
    metric table.
    """
    spark = features.sparkSession
    prepared = prepare(features, config)
    tuned, results = None, None
    if config.tune:
        if config.model_name in RULES:
            raise ValueError(f"{config.model_name} has nothing to tune")
        results = cut_lineage(tuning.random_search(
            prepared, config.model_name, features, config.time_column, config.id_column,
            config.n_iter, config.cv_splits, fixed=config.model_params,
        ))
        first = results.orderBy("position").first()
        model = tuning.refit(prepared, config.model_name, first, config.model_params)
        scored = model.transform(prepared.rows)
        tuned = {
            "scoring": "macro_f2", "n_iter": config.n_iter, "cv_splits": config.cv_splits,
            "best_score": first["mean_test_score"],
            "best_params": first["params"] | {c: str(first[c]) for c in results.columns if c.startswith("param_")},
        }
    else:
        scored, model = predict(prepared, config.model_name, **config.model_params)
    run_id = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%SZ}_{config.model_name}"
    metrics = cut_lineage(split_metrics(scored, run_id, config.model_name))
    if output is not None:
        run_dir = f"{output}/runs/{run_id}"
        reports = {part: f"{run_dir}/classification_report_{part}" for part in ("train", "validation", "test")}
        artifacts = {"scaler": f"{run_dir}/scaler", "reports": reports}
        if model is not None:
            artifacts["model"] = f"{run_dir}/model"
            model.write().overwrite().save(artifacts["model"])
        if results is not None and config.store_tuned:
            artifacts["tuned_models"] = tuning.store_candidates(
                prepared, config.model_name, results, f"{run_dir}/tuned_models", model, config.model_params
            )
        sinks.write_parquet(prepared.scaler, f"{run_dir}/scaler")
        names = prepared.names
        top = feature_importances(spark, model, names, 30) if model is not None else None
        record = run_record(spark, run_id, config, prepared, metrics, top, tuned, artifacts)
        sinks.write_json(record, f"{run_dir}/run_info.json")
        for part, path in reports.items():
            counts = evaluate.pair_counts(scored.filter(F.col("split") == part))
            sinks.write_csv(evaluate.class_report(evaluate.per_class(counts)), path)
        sinks.append_metrics(metrics, f"{output}/metrics")
        settings = [(run_id, f.name, str(getattr(config, f.name))) for f in fields(config)]
        sinks.append_metrics(spark.createDataFrame(settings, "run_id string, name string, value string"), f"{output}/params")
    return metrics


def run_record(
    spark: SparkSession,
    run_id: str,
    config: TrainingConfig,
    prepared: Prepared,
    metrics: DataFrame,
    importances: DataFrame | None = None,
    tuned: dict | None = None,
    artifacts: dict | None = None,
) -> DataFrame:
    """One nested row that describes the run."""
    counts = {r["split"]: r["count"] for r in prepared.rows.groupBy("split").count().collect()}
    values = metrics.groupBy("split").agg(F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("m"))
    by_split = {r["split"]: r["m"] for r in values.collect()}  # one row per split
    gaps = {r["gap"]: r["value"] for r in evaluate.overfit_gaps(metrics, ["run_id"]).collect()}
    weights = {str(int(r["label"])): r["weight"] for r in prepared.weights.collect()}
    top = [(r["feature"], r["importance"]) for r in importances.collect()] if importances is not None else []
    tuned, artifacts = tuned or {}, artifacts or {}
    schema = (
        "run_id string, created_at_utc string, "
        "data struct<sample_frac:double,target_column:string,delay_column:string,time_column:string>, "
        "splits struct<train_rows:bigint,validation_rows:bigint,test_rows:bigint>, "
        "features struct<count:int,names:array<string>>, target_classes array<string>, "
        "model struct<name:string,class_name:string,parameters:map<string,string>,class_weights:map<string,double>>, "
        "tuning struct<enabled:boolean,scoring:string,n_iter:int,cv_splits:int,best_score:double,best_params:map<string,string>>, "
        "metrics struct<train:map<string,double>,validation:map<string,double>,test:map<string,double>,overfit_gaps:map<string,double>>, "
        "feature_importances_top_30 array<struct<feature:string,importance:double>>, "
        "artifacts struct<model:string,scaler:string,reports:map<string,string>,tuned_models:array<string>>"
    )
    names = prepared.names
    row = (
        run_id,
        datetime.now(timezone.utc).isoformat(),
        (config.sample_frac, config.target_column, config.delay_column, config.time_column),
        tuple(int(counts.get(s, 0)) for s in ("train", "validation", "test")),
        (len(names), names),
        list(schemas.DELAY_CLASSES),
        (config.model_name, "rule" if config.model_name in RULES else "mllib",
         {k: str(v) for k, v in config.model_params.items()}, weights),
        (bool(tuned), tuned.get("scoring"), tuned.get("n_iter"), tuned.get("cv_splits"),
         tuned.get("best_score"), tuned.get("best_params")),
        (by_split.get("train"), by_split.get("validation"), by_split.get("test"), gaps),
        top,
        tuple(artifacts.get(k) for k in ("model", "scaler", "reports", "tuned_models")),
    )
    return spark.createDataFrame([row], schema)


def compare_models(prepared: Prepared, names: Sequence[str], params: dict[str, dict] | None = None) -> DataFrame:
    """Weighted validation metrics and wall-clock times of several models, best F1 first."""
    import time

    spark = prepared.rows.sparkSession
    valid = prepared.rows.filter("split = 'validation'")
    rows = []
    for name in names:
        started = time.monotonic()
        model = fit_model(prepared, name, **(params or {}).get(name, {}))
        fitted = time.monotonic()
        counts = evaluate.pair_counts(model.transform(valid))
        found = evaluate.weighted_metrics(evaluate.per_class(counts)).first()
        rows.append((name, *found, round(fitted - started, 2), round(time.monotonic() - fitted, 2)))
    schema = "model string, accuracy double, precision double, recall double, f1 double, train_time_s double, pred_time_s double"
    return spark.createDataFrame(rows, schema).orderBy(F.desc("f1"), "model")


__all__ = ["TrainingConfig", "Prepared", "prepare", "fit_model", "predict", "run_training", "compare_models"]
