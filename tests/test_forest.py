"""The histogram forest against plain rules and MLlib's forest."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from legwork.plans import forest, models


def rows(spark, n, seed=1):
    draw = np.random.default_rng(seed)
    x = draw.random((n, 6))
    x[:, 4] = x[:, 4] > 0.7
    label = (x[:, 0] + 0.5 * x[:, 1] > 0.75).astype(int) + (x[:, 2] > 0.8)
    data = [(int(i), Vectors.dense(v), float(c), 1.0 + (i % 3)) for i, (v, c) in enumerate(zip(x, label))]
    return spark.createDataFrame(data, ["id", "features", "label", "weight"])


def accuracy(model, df):
    return model.transform(df).agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]


def test_random_forest_is_grown_by_few_jobs():
    """MLlib sends the sums of all nodes of all trees, which did not end on 0.1 GB."""
    assert isinstance(models.make_model("random_forest"), forest.HistogramForest)


def test_predicts_like_mllib(spark):
    df, other = rows(spark, 1500), rows(spark, 600, 2)
    settings = {"numTrees": 20, "maxDepth": 6, "minInstancesPerNode": 5, "seed": 3}
    own = models.with_weights(forest.HistogramForest(**settings), "weight").fit(df)
    theirs = models.with_weights(RandomForestClassifier(**settings), "weight").fit(df)
    assert accuracy(own, other) > accuracy(theirs, other) - 0.03
    gap = own.featureImportances.toArray() - theirs.featureImportances.toArray()
    assert np.abs(gap).max() < 0.1


@pytest.mark.parametrize("node_rows", [1, 200])
def test_jobs_and_branches_grow_the_same_trees(spark, monkeypatch, node_rows):
    df = rows(spark, 1200)
    settings = {"numTrees": 4, "maxDepth": 5, "minInstancesPerNode": 10}
    whole = forest.HistogramForest(**settings).fit(df)
    monkeypatch.setattr(forest, "NODE_ROWS", node_rows)
    parted = forest.HistogramForest(**settings).fit(df)
    def shown(m):
        return [(r["id"], np.round(list(r["probability"]), 5).tolist()) for r in m.transform(df).orderBy("id").collect()]
    assert shown(whole) == shown(parted)
    assert np.allclose(whole.featureImportances.toArray(), parted.featureImportances.toArray())


def test_leaves_keep_the_least_rows_and_the_depth(spark):
    df = rows(spark, 800)
    model = forest.HistogramForest(numTrees=3, maxDepth=4, minInstancesPerNode=50, featureSubsetStrategy="all").fit(df)
    for tree in model.trees:
        assert 1 < len(tree.shares) <= 16
        assert np.allclose(tree.shares.sum(axis=1), 1, atol=1e-6)


def test_one_class_and_saved_model(spark, tmp_path):
    same = rows(spark, 50).withColumn("label", F.lit(0.0))
    assert accuracy(forest.HistogramForest(numTrees=2).fit(same), same) == 1.0
    df = rows(spark, 300)
    model = forest.HistogramForest(numTrees=3).fit(df)
    model.write().overwrite().save(f"{tmp_path}/m")
    again = forest.ForestModel.load(f"{tmp_path}/m")
    assert accuracy(again, df) == accuracy(model, df)
    assert again.featureImportances == model.featureImportances
