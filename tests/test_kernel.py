"""Radial kernel features against the exact kernel, and on rows no line divides."""

import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from legwork.plans import models
from legwork.plans.kernel import FourierFeatures, RadialFeatures
from legwork.registry import load


def rings(spark, n=600):
    draw = random.Random(4)
    rows = []
    for i in range(n):
        angle, radius = draw.uniform(0, 2 * math.pi), (1.0 if i % 2 else 3.0) + draw.gauss(0, 0.2)
        rows.append((Vectors.dense(radius * math.cos(angle), radius * math.sin(angle)), float(i % 2), 1.0))
    return spark.createDataFrame(rows, ["features", "label", "weight"]).repartition(4)


def test_features_come_near_the_exact_kernel(spark):
    draw = np.random.default_rng(1)
    rows = draw.standard_normal((60, 5))
    vectors = [Vectors.sparse(5, dict(enumerate(r))) if i % 2 else Vectors.dense(r) for i, r in enumerate(rows)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], ["i", "features"])
    made = RadialFeatures(inputCol="features", outputCol="z", components=4000, gamma=0.3).fit(df)
    found = np.array([r["z"].toArray() for r in made.transform(df).orderBy("i").collect()])
    exact = np.exp(-0.3 * ((rows[:, None] - rows[None]) ** 2).sum(-1))
    assert np.abs(found @ found.T - exact).max() < 0.1
    assert made.transform(df.limit(0)).count() == 0


def test_gamma_of_the_rows(spark):
    df = rings(spark)
    table = np.array([r["features"].toArray() for r in df.collect()])
    for rule, want in (("auto", 1 / 2), ("scale", 1 / (2 * table.var(axis=0).mean()))):
        made = RadialFeatures(inputCol="features", outputCol="z", rule=rule).fit(df)
        assert made.getOrDefault("gamma") == pytest.approx(want)
    same = spark.createDataFrame([(Vectors.dense(2.0, 2.0),)] * 3, ["features"])
    assert RadialFeatures(inputCol="features", outputCol="z").fit(same).getOrDefault("gamma") == 0.5
    with pytest.raises(ValueError):
        models.make_model("svc", gamma="wide")
    with pytest.raises(ValueError):
        models.make_model("svc", kernel="poly")


def test_radial_machine_divides_rings(spark, tmp_path):
    df = rings(spark).cache()
    shares = {}
    for kernel in ("rbf", "linear"):
        model = models.with_weights(models.make_model("svc", kernel=kernel, maxIter=30, **({"components": 128} if kernel == "rbf" else {})), None).fit(df)
        right = F.avg((F.col("prediction") == F.col("label")).cast("double"))
        shares[kernel] = model.transform(df).agg(right).first()[0]
        if kernel == "rbf":
            assert models.feature_importances(spark, model, ["x", "y"]).count() == 0
            path = str(tmp_path / "svc")
            model.write().save(path)
            again = PipelineModel.load(path)
            assert isinstance(again.stages[1], FourierFeatures)
            assert again.transform(df).agg(right).first()[0] == shares[kernel]
    assert shares["rbf"] > 0.98 and shares["linear"] < 0.75


def test_linear_machine_scores_in_a_session_that_ran_the_chain(spark):
    assert load()["turnaround"].run(spark, "/root/testdata/sf0.001").count() > 0
    df = rings(spark, 60)
    model = models.make_model("svc", kernel="linear", maxIter=2).fit(df)
    assert model.transform(df).filter("prediction IS NOT NULL").count() == 60
