"""Model definitions against their formulas."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallyshore.operators.split import with_weights
from tallyshore.operators import softmax
from tallyshore.plans import churn_model, topic_model


def points(spark, n=400):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(n, 3))
    y = (rng.random(n) < 1 / (1 + np.exp(-(2 + x @ [1.0, -2.0, 0.0])))).astype(int)
    rows = [(i, int(y[i]), Vectors.dense(x[i])) for i in range(n)]
    return x, y, spark.createDataFrame(rows, ["user_id", "churned", "features"])


def test_logistic_regression_minimizes_the_summed_loss_plus_half_the_squared_norm(spark):
    x, y, df = points(spark)
    weighted = with_weights(df, "churned")
    fitted = churn_model.candidate_models(len(y))["logistic_regression"].fit(weighted)
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    beta, b = fitted.coefficients.toArray(), fitted.intercept
    error = w * (1 / (1 + np.exp(-(x @ beta + b))) - y)
    gradient = np.append(x.T @ error + beta, error.sum())
    assert np.abs(gradient).max() < 0.05  # against sums of several hundred
    assert beta[0] > 0.5 and beta[1] < -1


@pytest.mark.parametrize("name", ["random_forest", "gradient_boosting"])
def test_trees_rank_better_than_chance(spark, name):
    from tallyshore.operators.metrics import ranking_metrics

    _, _, df = points(spark)
    model = churn_model.candidate_models(400, trees=30, max_depth=4, rounds=10)[name]
    fitted = model.fit(with_weights(df.filter("user_id < 300"), "churned"))
    held = fitted.transform(df.filter("user_id >= 300")).select(
        F.col("churned").alias("label"),
        churn_model.vector_to_array("probability")[1].alias("probability"))
    assert ranking_metrics(held).first().roc_auc > 0.75


def test_baseline_and_best(spark):
    from tallyshore.operators.metrics import best_model, ranking_metrics

    _, y, df = points(spark)
    row = ranking_metrics(churn_model.predict(None, "base", df)).first()
    assert row.roc_auc == 0.5 and row.pr_auc == pytest.approx(y.mean(), abs=1e-4)
    scores = spark.createDataFrame(
        [("always", 0.99), ("b", 0.7), ("a", 0.7), ("c", None)], "model string, roc_auc double")
    assert best_model(scores, "always").first().model == "a"


def test_boosting_stops_by_rows_it_does_not_learn_from(spark):
    _, _, df = points(spark)
    marked = with_weights(df, "churned").withColumn("held_back", F.col("user_id") % 4 == 0)
    small, large = (churn_model.candidate_models(n, rounds=40)["gradient_boosting"] for n in (10_000, 10_001))
    assert not small.isDefined(small.validationIndicatorCol)
    assert large.getValidationIndicatorCol() == "held_back"
    estimator = churn_model.candidate_models(400, rounds=40, stop_early=True)["gradient_boosting"]
    assert estimator.fit(marked).getNumTrees < 40


def topics(spark, n=1500, width=400, classes=3):
    """Texts as unit vectors in which most terms are rare, in several classes."""
    rng = np.random.default_rng(5)
    x = (rng.random((n, width)) < 0.5 / np.arange(1, width + 1)) * rng.exponential(size=(n, width))
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    y = (x @ rng.normal(scale=4, size=(width, classes)) + rng.gumbel(size=(n, classes))).argmax(axis=1)
    rows = [(float(k), Vectors.sparse(width, np.flatnonzero(v), v[v != 0])) for k, v in zip(y, x)]
    return x, y, with_weights(spark.createDataFrame(rows, ["label", "features"]), "label")


def test_topic_regression_arrives_in_few_passes_however_rare_the_terms(spark, monkeypatch):
    x, y, df = topics(spark)
    passes, once = [], softmax.total
    monkeypatch.setattr(softmax, "total", lambda *a: passes.append(0) or once(*a))
    fitted = topic_model.topic_regression(len(y)).fit(df)
    assert len(passes) < 150
    beta, b = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    margins = x @ beta.T + b
    guess = np.exp(margins - margins.max(axis=1, keepdims=True))
    error = guess / guess.sum(axis=1, keepdims=True) - np.eye(3)[y]
    error *= (len(y) / (3 * np.bincount(y)))[y][:, None]
    assert np.abs(error.T @ x + beta).max() < 0.01 and np.abs(error.sum(axis=0)).max() < 0.01
    assert not fitted.isSet(fitted.getParam("lowerBoundsOnCoefficients"))
    first = fitted.transform(df.limit(1)).select("features", "probability").first()
    own = first.features.toArray() @ beta.T + b
    assert first.probability.toArray() == pytest.approx(np.exp(own) / np.exp(own).sum())


def test_topic_regression_scales_anew_where_labels_are_clear_and_loses_little_where_they_are_not(spark, monkeypatch):
    rng = np.random.default_rng(5)
    y, chance = np.arange(1500) % 3, np.tile(0.5 / np.arange(1, 401), (1500, 1))
    chance[:, :60] = np.where(np.arange(60) % 3 == y[:, None], 0.5, 0.02)  # words that each class has for itself
    x = (rng.random((1500, 400)) < chance) * rng.exponential(size=(1500, 400))
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    rows = [(float(k), 1.0, Vectors.sparse(400, np.flatnonzero(v), v[v != 0])) for k, v in zip(y, x)]
    clear = spark.createDataFrame(rows, ["label", "weight", "features"])
    seen, once, anew = [], softmax.total, softmax.SCALED_ANEW
    monkeypatch.setattr(softmax, "total", lambda *a: seen.append(0) or once(*a))

    def passes(df, penalty, size):
        monkeypatch.setattr(softmax, "SCALED_ANEW", size)
        seen.clear()
        found = softmax.MultinomialRegression(penalty).search(df)
        assert found.sum(axis=0) == pytest.approx(0, abs=1e-6 * np.abs(found).max())
        return len(seen), found

    (some, found), (many, same) = passes(clear, 1 / 150_000, anew), passes(clear, 1 / 150_000, 0.0)
    assert some < 50 < many and found == pytest.approx(same, abs=0.01 * np.abs(same).max())
    noisy = topics(spark)[2]
    assert passes(noisy, 1 / 1500, anew)[0] < 1.3 * passes(noisy, 1 / 1500, 0.0)[0]


def test_loss_and_curvature_of_a_block_against_their_formulas():
    rng = np.random.default_rng(3)
    n, width, classes = 50, 6, 3
    x = np.where(rng.random((n, width)) < 0.4, rng.normal(size=(n, width)), 0)
    y, w = rng.integers(classes, size=n), rng.random(n)
    (block,) = softmax.blocks([(k, v, Vectors.dense(row)) for k, v, row in zip(y, w, x)], width)
    c = rng.normal(size=(classes, width + 1))
    whole = np.column_stack([x, np.ones(n)])
    p = np.exp(whole @ c.T)
    p /= p.sum(axis=1, keepdims=True)
    value, slope = softmax.loss(block, c[:-1] - c[-1])
    assert value == pytest.approx(-(w * np.log(p[np.arange(n), y])).sum())
    assert slope == pytest.approx((((p - np.eye(classes)[y]) * w[:, None]).T @ whole)[:-1])
    (found,) = softmax.curvature(block, c[:-1] - c[-1])
    assert found == pytest.approx((p * (1 - p) * w[:, None]).T @ whole ** 2)
    far = softmax.curvature(block, 1e4 * (c[:-1] - c[-1]))[0]  # no row in doubt
    assert np.isfinite(far).all() and (far >= 0).all()


def test_tasks_of_a_pass_are_more_of_them_at_first_then_larger_ones():
    assert [softmax.tasks(n) for n in (0, 4_999, 5_000, 34_826, 217_000, 480_000, 2_600_000)] == [1, 1, 2, 7, 24, 25, 131]


def test_topic_regression_of_one_class_and_of_blocks_of_one_row(spark, monkeypatch):
    x, y, df = topics(spark, 60, 20)
    whole = topic_model.topic_regression(60).fit(df).coefficientMatrix.toArray()
    assert len(list(softmax.blocks([(0, 1.0, Vectors.dense(row)) for row in x], 20))) == 1
    monkeypatch.setattr(softmax, "ENTRIES", 1)
    assert len(list(softmax.blocks([(0, 1.0, Vectors.dense(row)) for row in x], 20))) == 60
    assert topic_model.topic_regression(60).fit(df).coefficientMatrix.toArray() == pytest.approx(whole, abs=1e-6)
    assert {r.prediction for r in topic_model.topic_regression(60).fit(
        df.filter("label = 2")).transform(df).select("prediction").collect()} == {2.0}


def test_training_rows_spread_early_and_their_tasks_grow_before_there_are_more():
    found = {n: churn_model.partitions(n) for n in (0, 9_999, 10_000, 109_548, 650_000, 1_200_000, 3_000_001)}
    assert found == {0: 1, 9_999: 1, 10_000: 2, 109_548: 11, 650_000: 12, 1_200_000: 12, 3_000_001: 31}
