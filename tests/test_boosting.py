"""Histogram boosting against plain boosting on the raw values."""

import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from legwork.plans import boosting, models

KIND = ["label", "weight", "features"]


def sample(n, seed, classes=3):
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        x = [float(draw.randrange(12)), float(draw.randrange(2)), round(draw.random(), 1), float(draw.randrange(30)) / 4]
        label = int(x[0] > 5) + int(x[2] > 0.6) if draw.random() < 0.8 else draw.randrange(classes)
        rows.append((float(label), 1.0 + label, Vectors.dense(x)))
    return rows


def table(spark, rows, parts=3):
    return spark.createDataFrame(rows, KIND).repartition(parts)


def plain(rows, rounds, step, depth, l2, min_rows, min_hessian, factor, start=None):
    """Losses after every round, by trying every value of every feature as a border."""
    x = np.array([r[2].toArray() for r in rows])
    y, w = np.array([int(r[0]) for r in rows]), np.array([r[1] for r in rows])
    k = y.max() + 1
    scores = np.tile(np.zeros(k) if start is None else start, (len(rows), 1))
    losses = []

    def strength(g, h):
        return g * g / (h + l2) if h + l2 > 0 else 0.0

    def descend(at, g, h, level, out):
        best = (0.0, None, None)
        if level < depth:
            for f in range(x.shape[1]):
                for border in np.unique(x[at, f])[:-1]:
                    left = at[x[at, f] <= border]
                    right = at[x[at, f] > border]
                    sums = [(g[s].sum(), h[s].sum()) for s in (left, right)]
                    if min(len(left), len(right)) < min_rows or min(s[1] for s in sums) < min_hessian:
                        continue
                    gain = round(sum(strength(*s) for s in sums) - strength(g[at].sum(), h[at].sum()), 9)
                    if gain > best[0]:
                        best = (gain, left, right)
        if best[1] is None:
            out[at] = -step * g[at].sum() / (h[at].sum() + l2)
        else:
            descend(best[1], g, h, level + 1, out)
            descend(best[2], g, h, level + 1, out)

    for _ in range(rounds):
        e = np.exp(scores - scores.max(axis=1, keepdims=True))
        p = e / e.sum(axis=1, keepdims=True)
        new = np.zeros_like(scores)
        for c in range(k):
            descend(np.arange(len(rows)), w * (p[:, c] - (y == c)), factor * w * p[:, c] * (1 - p[:, c]), 0, new[:, c])
        scores += new
        e = np.exp(scores - scores.max(axis=1, keepdims=True))
        p = e / e.sum(axis=1, keepdims=True)
        losses.append(-(w * np.log(p[np.arange(len(y)), y])).sum() / w.sum())
    return losses, p


def loss_of(model, rows, spark):
    got = model.transform(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], ["i", *KIND])).orderBy("i").collect()
    p = np.array([r["probability"].toArray() for r in got])
    y, w = np.array([int(r[0]) for r in rows]), np.array([r[1] for r in rows])
    assert [r["prediction"] for r in got] == p.argmax(axis=1).tolist()
    return -(w * np.log(p[np.arange(len(y)), y])).sum() / w.sum(), p


@pytest.mark.parametrize("path", ["one task", "jobs"])
def test_losses_of_500_rows_like_plain_boosting(spark, monkeypatch, path):
    if path == "jobs":  # sums over several tasks, slices of features, stored scores
        for name, value in (("NODE_ROWS", 40), ("BLOCK_ROWS", 64), ("SLICE_BINS", 20), ("STORE_ROUNDS", 3), ("PARTITION_BYTES", 4000)):
            monkeypatch.setattr(boosting, name, value)
    rows = sample(500, 1)
    settings = dict(stepSize=0.3, maxIter=7, maxDepth=3, l2=2.0, minInstancesPerNode=4, minHessian=1.0, hessianFactor=2.0)
    model = models.with_weights(models.make_model("xgboost", **settings), "weight").fit(table(spark, rows))
    losses, p = plain(rows, 7, 0.3, 3, 2.0, 4, 1.0, 2.0)
    loss, got = loss_of(model, rows, spark)
    assert model.n_rounds == 7 and abs(loss - losses[-1]) < 1e-9
    np.testing.assert_allclose(got, p, atol=1e-9)


def test_stop_rule_and_held_out_loss(spark):
    assert not boosting.stalled([3, 2, 1], patience=3)
    assert boosting.stalled([3, 4, 2, 2.5, 2.2, 2.1], patience=3) and not boosting.stalled([3, 4, 2, 2.5, 2.2, 1], patience=3)
    assert boosting.stalled([1.0] * 16) and not boosting.stalled([1.0] * 15)
    rows = sample(400, 2)
    model = models.with_weights(models.make_model("hist_gradient_boosting", maxIter=120), "weight").fit(table(spark, rows))
    errors = model.errors
    assert 15 < model.n_rounds < 120 and len(errors) == model.n_rounds + 1  # one error before the first round
    assert boosting.stalled(errors) and not any(boosting.stalled(errors[:n]) for n in range(len(errors)))
    assert min(errors) < errors[0]
    assert model.transform(table(spark, rows)).filter("label <> prediction").count() < 120


def test_all_rounds_sampling_and_unseen_classes(spark):
    rows = [(r[0] * 2, *r[1:]) for r in sample(200, 3)]  # class 1 and 3 have no rows
    settings = dict(maxIter=20, maxDepth=2, columnRate=0.5, subsamplingRate=0.7)
    fit = lambda: models.make_model("xgboost", **settings).fit(table(spark, rows))
    first, again = fit(), fit()
    assert first.n_rounds == 20 and all(len(trees) == 5 for trees in first.trees)
    used = [{f for t in trees for f, left in zip(t.feature, t.left) if left} for trees in first.trees]
    assert all(len(u) <= 2 for u in used) and len(set().union(*used)) > 2
    seen = {r["prediction"] for r in first.transform(table(spark, rows)).collect()}
    assert seen <= {0.0, 2.0, 4.0} and first.featureImportances.toArray().sum() == pytest.approx(1.0)
    assert len(again.trees) == 20
    same = sample(50, 4)
    flat = models.make_model("xgboost", maxIter=2).fit(table(spark, [(0.0, 1.0, r[2]) for r in same]))
    assert {r["prediction"] for r in flat.transform(table(spark, same)).collect()} == {0.0}


@pytest.mark.parametrize("name", ["xgboost", "hist_gradient_boosting"])
def test_rows_of_one_partition_need_no_job_per_round(spark, monkeypatch, name):
    """400 rounds were some 3,000 jobs, which did not end on 0.1 GB."""
    rows = sample(300, 6)
    df = table(spark, rows)

    def fit(group):
        spark.sparkContext.setJobGroup(group, "fit")
        model = models.with_weights(models.make_model(name, maxIter=12, maxDepth=3, columnRate=0.75), "weight").fit(df)
        return model, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    one, few = fit(f"{name} in one job")
    assert one.n_rounds == 12 and few < 24
    monkeypatch.setattr(boosting, "PARTITION_BYTES", 4000)
    jobs, many = fit(f"{name} in jobs")
    assert jobs.n_rounds == 12 and many > few
    np.testing.assert_allclose(one.errors, jobs.errors, atol=1e-9)
    np.testing.assert_allclose(loss_of(one, rows, spark)[1], loss_of(jobs, rows, spark)[1], atol=1e-9)


def test_boosted_model_is_stored(spark, tmp_path):
    rows = sample(120, 5)
    model = models.make_model("xgboost", maxIter=3, maxDepth=2).fit(table(spark, rows))
    model.write().overwrite().save(str(tmp_path / "m"))
    again = boosting.BoostedModel.load(str(tmp_path / "m"))
    assert again.trees == model.trees
    np.testing.assert_array_equal(loss_of(again, rows, spark)[1], loss_of(model, rows, spark)[1])
