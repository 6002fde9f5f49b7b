"""Confusion counts and the metrics that follow from them.

Scored rows are reduced to (keys, label, prediction, rows) once; everything after that
works on at most classes * classes rows per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwork.functions.scalars import delay_class, class_ordinal, ratio
from legwork.operators.ranking import prefix_sums, value_levels
from legwork.schemas import DELAY_CLASSES, RULE_FEATURE

CLASSES = tuple(range(len(DELAY_CLASSES)))


def rule_class(feature: Column | None = None) -> Column:
    """Class of the day-so-far mean departure delay, missing counts as none."""
    x = F.col(RULE_FEATURE) if feature is None else feature
    return class_ordinal(delay_class(F.coalesce(x.try_cast("double"), F.lit(0.0))))


def majority_class(train: DataFrame, label: str = "label") -> Column:
    """The most frequent label of ``train`` as a scalar, ties by the smaller label."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max_by(label, F.struct(F.col("n"), -F.col(label)))).scalar()


def _class_rows(df: DataFrame, keys: Sequence[str], classes: Sequence[int], name: str) -> DataFrame:
    listed = F.explode(F.array(*[F.lit(c) for c in classes])).alias(name)
    return df.select(*keys).distinct().select(*keys, listed) if keys else df.sparkSession.range(1).select(listed)


def pair_counts(df: DataFrame, keys: Sequence[str] = (), label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (keys, label, prediction)."""
    return df.groupBy(
        *keys, F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("rows"))


def confusion(counts: DataFrame, classes: Sequence[int] = CLASSES) -> DataFrame:
    """Dense confusion matrix, absent pairs 0."""
    cells = _class_rows(counts, [], classes, "label").select(
        "label", F.explode(F.array(*[F.lit(c) for c in classes])).alias("prediction")
    )
    return cells.join(counts, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("rows", F.lit(0)).alias("rows")
    )


def per_class(counts: DataFrame, keys: Sequence[str] = (), classes: Sequence[int] = CLASSES) -> DataFrame:
    """True positives, support, predicted count and precision, recall, F1 per class."""
    hit = F.col("label") == F.col("prediction")
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.when(hit, F.col("rows")).otherwise(0).alias("tp"),
                 F.col("rows").alias("support"), F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("tp"),
                 F.lit(0).cast("bigint").alias("support"), F.col("rows").alias("predicted")),
    )
    summed = counts.select(*keys, F.inline(sides)).groupBy(*keys, "class").agg(
        *[F.sum(c).alias(c) for c in ("tp", "support", "predicted")]
    )
    dense = _class_rows(counts, keys, classes, "class").join(summed, [*keys, "class"], "left")
    dense = dense.fillna(0, subset=["tp", "support", "predicted"])
    return dense.withColumns(
        {
            "precision": ratio(F.col("tp"), F.col("predicted")),
            "recall": ratio(F.col("tp"), F.col("support")),
            "f1": ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")),
        }
    )


def fbeta(beta: float) -> Column:
    """F-beta over the columns of ``per_class``."""
    b2 = F.lit(float(beta * beta))
    return ratio((1 + b2) * F.col("tp"), b2 * F.col("support") + F.col("predicted"))


def headline_metrics(classes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Accuracy, balanced accuracy, macro F1 and F2, weighted F1, precision and recall per class.

    Balanced accuracy averages over classes that occur, macro F2 over classes that
    occur or are predicted, macro F1 over all classes.
    """
    present = F.col("support") > 0
    either = present | (F.col("predicted") > 0)
    named = []
    for i, label in enumerate(DELAY_CLASSES):
        for part in ("precision", "recall"):
            named.append(F.max(F.when(F.col("class") == i, F.col(part))).alias(f"{label}_{part}"))
    return classes.groupBy(*keys).agg(
        ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        F.avg(F.when(present, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("f1").alias("macro_f1"),
        F.avg(F.when(either, fbeta(2))).alias("macro_f2"),
        ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"),
        *named,
    )


def class_report(classes: DataFrame, names: Sequence[str] = tuple(DELAY_CLASSES)) -> DataFrame:
    """Per-class rows followed by accuracy, macro and weighted averages."""
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("class") + 1)
    parts = ["precision", "recall", "f1"]
    rows = classes.select(label.alias("name"), *parts, F.col("support").cast("double").alias("support"))
    total = F.sum("support").cast("double")
    accuracy = ratio(F.sum("tp"), F.sum("support"))
    overall = classes.agg(
        F.array(
            F.struct(F.lit("accuracy").alias("name"), *[accuracy.alias(p) for p in parts], accuracy.alias("support")),
            F.struct(F.lit("macro avg").alias("name"), *[F.avg(p).alias(p) for p in parts], total.alias("support")),
            F.struct(
                F.lit("weighted avg").alias("name"),
                *[ratio(F.sum(F.col(p) * F.col("support")), F.sum("support")).alias(p) for p in parts],
                total.alias("support"),
            ),
        ).alias("o")
    )
    return rows.union(overall.select(F.inline("o")))


def weighted_metrics(classes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1."""
    return classes.groupBy(*keys).agg(
        ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        *[
            ratio(F.sum(F.col(p) * F.col("support")), F.sum("support")).alias(p)
            for p in ("precision", "recall", "f1")
        ],
    )


def roc_auc(df: DataFrame, keys: Sequence[str], positive: Column, score: Column) -> DataFrame:
    """Area under the ROC curve per key: the rank-sum form with ties counted half.

    Rows are counted per distinct score first; the running count goes by score cells.
    """
    counted = df.select(*keys, positive.cast("int").alias("_y"), score.cast("double").alias("_s")).groupBy(
        *keys, "_s"
    ).agg(F.sum("_y").alias("_pos"), F.sum(1 - F.col("_y")).alias("_neg"))
    ranked = prefix_sums(counted, keys, value_levels(F.col("_s")), ["_s"], {"_below": F.col("_neg")})
    pairs = F.sum(F.col("_pos") * (F.col("_below") + F.col("_neg") / 2))
    return ranked.groupBy(*keys).agg(
        F.sum("_pos").alias("positives"),
        F.when(
            (F.sum("_pos") > 0) & (F.sum("_neg") > 0), pairs / (F.sum("_pos") * F.sum("_neg"))
        ).alias("roc_auc"),
    )


def roc_auc_ovr(df: DataFrame, label: str, scores: dict[int, Column]) -> DataFrame:
    """One-vs-rest AUC per class and the average weighted by class size."""
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("class"), (F.col(label) == c).alias("hit"), s.cast("double").alias("score"))
            for c, s in scores.items()
        ]
    )
    long = df.select(F.inline(entries))
    per = roc_auc(long, ["class"], F.col("hit"), F.col("score"))
    whole = per.agg(
        F.lit(None).cast("int").alias("class"),
        F.sum("positives").alias("positives"),
        (F.sum(F.col("roc_auc") * F.col("positives")) / F.sum("positives")).alias("roc_auc"),
    )
    return per.select("class", "positives", "roc_auc").union(whole)


def long_metrics(headline: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Headline metrics as (keys, metric, value)."""
    return headline.unpivot(list(keys), [c for c in headline.columns if c not in keys], "metric", "value")


def overfit_gaps(metrics: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Train minus validation and train minus test of every metric."""
    split = F.col("split")
    wide = metrics.groupBy(*keys, "metric").agg(
        *[F.max(F.when(split == s, F.col("value"))).alias(s) for s in ("train", "validation", "test")]
    )
    gaps = F.array(
        *[
            F.struct(
                F.concat(F.lit(f"train_minus_{s}_"), F.col("metric")).alias("gap"),
                (F.col("train") - F.col(s)).alias("value"),
            )
            for s in ("validation", "test")
        ]
    )
    return wide.select(*keys, F.inline(gaps)).filter(F.col("value").isNotNull())
