"""Boosted fits grown in tasks give what fits with common passes give; grids of many fits are searched whole."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskframe.config import EXTREME_BOOSTING, FOREST_GRID, GRADIENT_BOOSTING, LOGISTIC_GRID, AlgorithmConfig, TrainerConfig
from riskframe.operators import boosting, boosting_in_tasks, forest, train, trees
from riskframe.plans import queries

WIDTH = 14


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(23)
    x = draw.normal(size=(600, WIDTH))
    x[:, 3] = draw.integers(0, 3, 600)
    x[:, 4:] = draw.integers(0, 2, (600, WIDTH - 4))  # more than a byte of features of two bins
    x[:, 12] = 1.0
    y = (x[:, 0] + x[:, 1] * x[:, 4] + draw.normal(size=600) > 0.3).astype(float)
    made = spark.createDataFrame([(i, [float(v) for v in r], float(t), i % 3) for i, (r, t) in enumerate(zip(x, y))], "id long, x array<double>, label double, fold int")
    return made.select("id", array_to_vector("x").alias("features"), "label", "fold").cache(), x


@pytest.mark.parametrize("params", [{"n_estimators": 6, "max_depth": 4, "subsample": 0.8, "colsample_bytree": 0.7}, {"n_estimators": 4, "max_depth": 2, "first_order": True},
                                    {"n_estimators": 5, "max_depth": 6, "first_order": True, "min_child_weight": 3.0}])
def test_trees_are_those_of_common_passes(rows, params, monkeypatch):
    df, x = rows
    params = dict(params)
    build = boosting.spark_trees if params.pop("first_order", False) else boosting.Boosting
    fits = [build(**params, without_fold=k) for k in (1, None)]
    own = forest.fold_thresholds(df, (1, None), 32, "id")
    want = boosting.fit_side_by_side(df, fits, "id", thresholds=forest.common_cuts(own))
    monkeypatch.setattr(boosting_in_tasks, "VALUES_AT_ONCE", 999)
    mine = boosting_in_tasks.ensemble(boosting_in_tasks.grow(df.repartition(5), fits[1:], "id", own, [()]), fits[1], own)
    assert len(mine.trees) == len(want[1].trees)
    for a, b in zip(mine.trees, want[1].trees):
        assert (a.left == b.left).all() and (a.feature == b.feature).all() and a.threshold == pytest.approx(b.threshold)
        assert a.value == pytest.approx(b.value) and a.cover == pytest.approx(b.cover) and (a.rows == b.rows).all()
    scored = boosting_in_tasks.held_out(boosting_in_tasks.grow(df, fits[:1], "id", own, [(2, params["n_estimators"])])).collect()
    variants = [trees.Variant(2), trees.Variant(params["n_estimators"])]
    p = 1 / (1 + np.exp(-(trees.staged_scores(x[1::3], want[0].trees, variants) + want[0].start)))
    assert sorted((r.variant, round(r.probability, 9)) for r in scored) == sorted((k, round(float(v), 9)) for k in range(2) for v in p[:, k])


@pytest.mark.parametrize("family", ["boosting", "extreme"])
def test_a_grid_of_many_fits_is_searched_whole(rows, family, monkeypatch):
    """In tasks, or so many at a time: the same scores as all fits side by side, and one fit to all rows."""
    df, _ = rows
    grid, config = AlgorithmConfig("B", family, {"n_estimators": (2, 5), "max_depth": (2, 3), "learning_rate": (0.1, 0.3)}), TrainerConfig(folds=3)
    want = train.tune(df, df, grid, config, "id")
    every = train.tune_boosting(df, family, train.expand_grid(grid.grid), config, "id")[0]
    passes, tasks, fit, grow = [], [], boosting.fit_side_by_side, boosting_in_tasks.grow
    monkeypatch.setattr(boosting, "fit_side_by_side", lambda d, fits, *a, **k: passes.append(len(fits)) or fit(d, fits, *a, **k))
    monkeypatch.setattr(boosting_in_tasks, "grow", lambda d, fits, *a: tasks.append(len(fits)) or grow(d, fits, *a))
    monkeypatch.setattr(train, "SIDE_BY_SIDE", 5)
    for largest, seen in ((boosting_in_tasks.LARGEST, ([], [12, 1])), (600 * WIDTH - 1, ([5, 5, 2, 1], []))):
        monkeypatch.setattr(boosting_in_tasks, "LARGEST", largest)
        passes.clear(), tasks.clear()
        found = train.tune(df, df, grid, config, "id")
        assert (passes, tasks) == seen
        assert (found.params, found.searched, found.published) == (want.params, 8, 8)
        assert (found.cv_score, found.test_score) == pytest.approx((want.cv_score, want.test_score))
        assert np.array(train.tune_boosting(df, family, train.expand_grid(grid.grid), config, "id")[0]) == pytest.approx(np.array(every))
        assert found.model.getNumTrees == want.model.getNumTrees
    assert not train.boosts_in_tasks(df.limit(30).withColumn("label", F.lit(None).cast("double"))) and not train.boosts_in_tasks(df.limit(0))


def test_the_leaderboard_searches_every_point(monkeypatch):
    monkeypatch.setattr(queries, "searched", lambda spark, sf_dir, config: config)
    config = queries.QUERIES["leaderboard"](None, "")
    assert [a.grid for a in config.algorithms] == [LOGISTIC_GRID, FOREST_GRID, GRADIENT_BOOSTING.grid, EXTREME_BOOSTING.grid]
    assert config.max_points is None and not config.within and config.folds == 5
