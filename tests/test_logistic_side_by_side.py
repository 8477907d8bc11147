"""Logistic regressions that share their passes are those of Spark's separate fits."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskframe.config import AlgorithmConfig, TrainerConfig
from riskframe.operators import logistic, train

GRID = {"C": (0.02, 5.0), "penalty": ("l1", "l2"), "solver": ("liblinear", "saga")}
WIDTH = 8


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(23)
    x = draw.normal(size=(400, WIDTH)) * [1, 5, 1, 1, 0.1, 1, 1, 1] + [0, 40, 0, 0, 0, 0, 0, 0]
    x[:, 3:6] = draw.integers(0, 2, (400, 3))
    x[:, 6], x[:, 7] = 0.3, 0.0  # without deviation
    x = np.vstack([x, x[:100]])  # equal rows, whose scores must tie
    y = (x[:, 0] + x[:, 3] * x[:, 2] + draw.normal(size=500) > 0.4).astype(float)
    made = spark.createDataFrame([(i, [float(v) for v in r], float(t), i % 3) for i, (r, t) in enumerate(zip(x, y))], "id long, x array<double>, label double, fold int")
    return made.select("id", array_to_vector("x").alias("features"), "label", "fold").coalesce(1).cache()


@pytest.fixture
def blocks(rows):
    return logistic.blocked(rows.repartition(3)).rdd.map(lambda r: bytes(r["block"])).persist()


@pytest.mark.parametrize("settings, k", [({"maxIter": 1000, "tol": 1e-4, "standardization": False}, 1), ({"maxIter": 7}, None)])
def test_weights_are_those_of_separate_fits(rows, blocks, settings, k):
    estimator, points = LogisticRegression(**settings), train.expand_grid(GRID)
    kept = rows if k is None else rows.where(F.col("fold") != k)
    found = logistic.fit_blocks(blocks, [train.logistic_fit(estimator, p, kept.count(), k) for p in points])
    for own, params in zip(found, points):
        theirs = train.fitted(estimator, kept, params, kept.count())
        assert own[:-1] == pytest.approx(theirs.coefficients.toArray(), abs=1e-6), params
        assert own[-1] == pytest.approx(theirs.intercept, abs=1e-5), params


def test_folds_of_a_logistic_search_share_their_passes(rows, monkeypatch):
    config = TrainerConfig(folds=3)
    algorithm = AlgorithmConfig("L", "logistic", {"C": (0.02, 0.1), "penalty": ("l1", "l2")})
    estimator, points, score = train.base_estimator(algorithm, config), train.expand_grid(algorithm.grid), train.evaluator()
    want = []
    for params in points:
        for k in range(3):
            kept, rest = rows.where(F.col("fold") != k), rows.where(F.col("fold") == k)
            want.append(score.evaluate(train.fitted(estimator, kept, params, kept.count()).transform(rest)))
    passes, separate = [], []
    sums, fitted = logistic.pass_sums, train.fitted
    monkeypatch.setattr(logistic, "pass_sums", lambda blocks, weights, without: passes.append(len(without)) or sums(blocks, weights, without))
    monkeypatch.setattr(train, "fitted", lambda *a: separate.append(a[2]) or fitted(*a))
    found = train.cross_validated(rows, estimator, points, config)
    assert np.ravel(found) == pytest.approx(want, abs=1e-9)
    assert passes[0] == 12 and not separate  # four points and three folds ask together
    best = train.tune(rows, rows, algorithm, config)
    assert len(separate) == 1 and best.cv_score == pytest.approx(max(np.mean(s) for s in found))


def test_areas_of_tied_scores(rows, monkeypatch):
    """Rows of one coded column: a score for each code, and all other order is ties."""
    coded = rows.withColumn("features", array_to_vector(F.slice(vector_to_array("features"), 4, 1)))
    estimator, config, score = LogisticRegression(maxIter=1000, tol=1e-12, standardization=False), TrainerConfig(folds=3), train.evaluator()
    found = train.cross_validated(coded, estimator, [{"C": 1e12}], config)[0]
    for k, area in enumerate(found):
        kept = coded.where(F.col("fold") != k)
        model = train.fitted(estimator, kept, {"C": 1e12}, kept.count())
        assert area == pytest.approx(score.evaluate(model.transform(coded.where(F.col("fold") == k))), abs=1e-12)


def test_what_the_common_passes_leave_to_spark(rows):
    plain, config = LogisticRegression(maxIter=10), TrainerConfig(folds=3)
    assert train.descends_side_by_side(rows, plain, config)
    assert not train.descends_side_by_side(rows, LogisticRegression(fitIntercept=False), config)
    assert not train.descends_side_by_side(rows, plain, TrainerConfig(folds=4))  # a fold without rows
    assert not train.descends_side_by_side(rows.withColumn("fold", F.when(F.col("id") > 0, F.col("fold"))), plain, config)
    assert not train.descends_side_by_side(rows.withColumn("label", F.when(F.col("fold") == 1, 1.0).otherwise(F.col("label"))), plain, config)
    assert not train.descends_side_by_side(rows.withColumn("label", F.when(F.col("id") > 0, F.col("label"))), plain, config)
    odd = rows.withColumn("features", array_to_vector(F.when(F.col("id") == 1, F.transform(vector_to_array("features"), lambda x: F.lit(float("nan")))).otherwise(vector_to_array("features"))))
    assert not train.descends_side_by_side(odd, plain, config)


def test_steps_that_fail_twice_end_a_descent():
    """A value that grows wherever the gradient leads: the memory is dropped once, then the point is returned."""
    start = np.array([1.0, 2.0])
    descent, asked = logistic.descent(start, None, 100, 1e-4), []
    point = next(descent)
    try:
        while True:
            asked.append(point)
            point = descent.send((1.0 + 10 * np.abs(point - start).sum(), np.array([1.0, -1.0])))
    except StopIteration as end:
        assert (end.value == start).all() and len(asked) == 1 + 2 * (1 + logistic.ZOOMS)
