"""Gradient steps against NumPy, and against the optimum another solver finds."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors

from tallyforge.operators import mail, sgd


def data(seed=2, n=120, size=6):
    rng = np.random.default_rng(seed)
    x = rng.poisson(1.0, size=(n, size)).astype(float)
    y = (x @ np.linspace(-1, 1, size) + rng.normal(size=n) > 0).astype(float)
    return x, y


def frame(spark, x, y):
    rows = [
        (Vectors.dense(a) if i % 3 else Vectors.sparse(len(a), [(j, v) for j, v in enumerate(a) if v]), float(b))
        for i, (a, b) in enumerate(zip(x, y))
    ]
    return spark.createDataFrame(rows, ["features", "label"])


def steps(x, y, iterations, reg=0.01):
    w = np.zeros(x.shape[1])
    for t in range(1, iterations + 1):
        gradient = x.T @ (1 / (1 + np.exp(-x @ w)) - y) / len(y)
        w = w * (1 - reg / np.sqrt(t)) - gradient / np.sqrt(t)
    return w


def test_equals_numpy_and_repeats(spark):
    x, y = data()
    rows = frame(spark, x, y)
    models = [sgd.logistic_sgd(rows, x.shape[1], iterations=6, tolerance=0.0) for _ in range(2)]
    assert np.allclose(models[0].weights, steps(x, y, 6), atol=1e-6)
    assert (models[0].weights == models[1].weights).all() and models[0].steps == 6 and not models[0].settled
    # NULLs are left out of the fit and get no prediction.
    odd = rows.unionByName(spark.createDataFrame([(None, 1.0), (Vectors.dense(x[0]), None)], rows.schema))
    assert np.allclose(sgd.logistic_sgd(odd, x.shape[1], iterations=6, tolerance=0.0).weights, models[0].weights, atol=1e-9)
    found = sgd.predict(models[0], odd).collect()
    assert sorted(r.prediction for r in found if r.prediction is not None) == sorted(
        ((np.vstack([x, x[:1]]) @ models[0].weights) > 0).astype(float))
    assert sum(r.prediction is None for r in found) == 1


def test_drawn_rows_come_near_the_optimum(spark):
    x, y = data(n=300)
    rows = frame(spark, x, y)
    model = sgd.logistic_sgd(rows, x.shape[1], iterations=40, step=4.0, fraction=0.5, seed=3)
    best = LogisticRegression(regParam=0.01, fitIntercept=False, standardization=False, maxIter=200).fit(rows)

    def loss(w):
        return np.mean(np.logaddexp(0, x @ w) - y * (x @ w)) + 0.005 * w @ w

    assert loss(model.weights) < 1.05 * loss(best.coefficients.toArray())


def test_messages(spark):
    spam = spark.createDataFrame([("cheap money now",), ("GET cheap stuff",), ("send money",)], "text string")
    normal = spark.createDataFrame([("Hi Dad I study",), ("the other day",), ("",)], "text string")
    model = mail.spam_sgd(mail.label_messages(spam, normal), iterations=8)
    found = mail.classify_sgd(model, spark.createDataFrame([("cheap money",), ("Hi Dad",)], "text string"))
    assert {r.text: r.prediction for r in found.collect()} == {"cheap money": 1.0, "Hi Dad": 0.0}


def test_no_rows(spark):
    model = sgd.logistic_sgd(frame(spark, *data()).limit(0), 6, iterations=2)
    assert not model.weights.any()


def test_rows_are_stored_in_blocks(spark, monkeypatch):
    """Steps read packed blocks, whose size changes nothing; short, empty and long rows, all rows or some."""
    rng = np.random.default_rng(5)
    x = rng.poisson(0.5, size=(90, 12)).astype(float)
    x[::7] = 0
    rows = frame(spark, x, (x[:, 0] > 0).astype(float)).coalesce(1)
    stored, write = [], sgd.materialize
    monkeypatch.setattr(sgd, "materialize", lambda df, tag: stored.append(write(df, tag)) or stored[-1])
    fits = []
    for block in (250_000, 20, 1):
        monkeypatch.setattr(sgd, "_BLOCK", block, raising=False)
        fits.append([sgd.logistic_sgd(rows, 12, iterations=3, tolerance=0.0, fraction=f, seed=1).weights for f in (1.0, 0.4)])
    assert stored[0].count() == 1 < stored[2].count() < stored[4].count()
    assert np.allclose(fits[0][0], steps(x, (x[:, 0] > 0), 3), atol=1e-6)
    for fit in fits[1:]:
        assert np.allclose(fit, fits[0], atol=1e-8)
