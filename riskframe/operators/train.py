"""Grid search, cross-validation, leaderboard and selection with Spark ML."""

from __future__ import annotations

import itertools
import logging
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import cached_property
from multiprocessing.pool import ThreadPool
from statistics import fmean, pstdev

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.config import KEY, AlgorithmConfig, TrainerConfig
from riskframe.operators import boosting, boosting_in_tasks, forest, logistic, metrics, trees
from riskframe.operators.score import Scorecard

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Candidate:
    """A tuned algorithm: its parameters, refitted model, and scores. A model whose trees are written is loaded when asked for."""

    name: str
    params: dict
    build: Callable[[], Model]
    cv_score: float | None
    cv_std: float | None
    test_score: float
    searched: int = 0
    published: int = 0

    @cached_property
    def model(self) -> Model:
        return self.build()


def evaluator(label: str = "label") -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=0)


def expand_grid(grid: dict[str, tuple]) -> list[dict]:
    names = list(grid)
    return [dict(zip(names, values)) for values in itertools.product(*(grid[n] for n in names))]


def base_estimator(algorithm: AlgorithmConfig, config: TrainerConfig) -> Estimator | None:
    """Spark's estimator of a family; None for second-order boosting, which ``boosting`` grows."""
    if algorithm.family == "logistic":
        return LogisticRegression(maxIter=config.max_iter, tol=config.tolerance, standardization=False)
    if algorithm.family == "forest":
        # published trees grow until their leaves are pure; 30 levels are the most that Spark's trees can have
        return RandomForestClassifier(seed=config.seed, numTrees=100, maxDepth=30)
    if algorithm.family == "boosting":
        return GBTClassifier(seed=config.seed, maxIter=100, maxDepth=3)
    if algorithm.family == "extreme":
        return None
    raise ValueError(f"unknown family {algorithm.family}")


#: Names of parameters by estimator: those that ``fitted`` handles itself have none.
PARAMETERS = {
    RandomForestClassifier: {"n_estimators": "numTrees", "max_depth": "maxDepth", "min_samples_leaf": "minInstancesPerNode",
                             "subsample": "subsamplingRate", "colsample_bytree": "featureSubsetStrategy", "min_samples_split": None},
    GBTClassifier: {"n_estimators": "maxIter", "max_depth": "maxDepth", "learning_rate": "stepSize",
                    "min_samples_leaf": "minInstancesPerNode", "subsample": "subsamplingRate", "colsample_bytree": "featureSubsetStrategy"},
}


def param_map(estimator: Estimator, params: dict, rows: int) -> dict:
    """Translate published parameter names; ``rows`` turns C (1 unless given) into a mean-loss penalty (l2 unless given)."""
    if isinstance(estimator, LogisticRegression):
        return {estimator.elasticNetParam: 1.0 if params.get("penalty", "l2") == "l1" else 0.0,
                estimator.regParam: 1.0 / (params.get("C", 1.0) * max(1, rows))}
    names = PARAMETERS[type(estimator)]
    for name in params:
        if name not in names:
            raise ValueError(f"parameter {name} has no counterpart in {type(estimator).__name__}")
    named = {names[n]: v for n, v in params.items() if names[n]}
    if "featureSubsetStrategy" in named:
        named["featureSubsetStrategy"] = "all" if named["featureSubsetStrategy"] == 1 else str(named["featureSubsetStrategy"])
    return {estimator.getParam(n): v for n, v in named.items()}


def fitted(estimator: Estimator, data: DataFrame, params: dict, rows: int) -> Model:
    """One model. The liblinear solver penalises the intercept like any weight; a forest with a minimum split size is the
    grown forest with smaller nodes collapsed."""
    at = param_map(estimator, params, rows)
    if isinstance(estimator, LogisticRegression) and params.get("solver") == "liblinear":
        return _penalised_intercept(estimator.copy(at), data, rows)
    model = estimator.fit(data, at)
    least = params.get("min_samples_split", 2)
    return trees.collapse(model, least) if least > 2 else model


def _penalised_intercept(estimator: LogisticRegression, data: DataFrame, rows: int) -> LogisticRegressionModel:
    """Fit with a column of ones under the penalty, whose weight becomes the intercept.

    Spark gives a constant column no weight, so one row of zeros is added: it has no gradient whatever the weights are, and
    counts as much as all others only to spread the column. The penalty is scaled to the doubled count.
    """
    features, label = estimator.getFeaturesCol(), estimator.getLabelCol()
    cells = vector_to_array(features)
    ones = data.select(array_to_vector(F.array_append(cells, F.lit(1.0))).alias(features), F.col(label).cast("double").alias(label), F.lit(1.0).alias("weight"))
    zeros = data.limit(1).select(array_to_vector(F.array_append(F.transform(cells, lambda x: F.lit(0.0)), F.lit(0.0))).alias(features),
                                 F.lit(0.0).alias(label), F.lit(float(rows)).alias("weight"))
    wide = estimator.copy({estimator.fitIntercept: False, estimator.weightCol: "weight", estimator.regParam: estimator.getRegParam() / 2})
    weights = wide.fit(ones.unionByName(zeros)).coefficients.toArray()
    return logistic_model(data.sparkSession, weights[:-1], weights[-1])


def logistic_model(spark: SparkSession, weights: Sequence[float], intercept: float) -> LogisticRegressionModel:
    """Spark's logistic model with given weights."""
    context = spark.sparkContext
    return LogisticRegressionModel(context._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        f"logistic_{uuid.uuid4().hex[:12]}", _py2java(context, Vectors.dense(weights)), float(intercept)))


@dataclass(frozen=True)
class Shared:
    """One fit that serves several points of a grid: the positions of the points, and what part of the fit each one is."""

    params: dict
    points: tuple[int, ...]
    variants: tuple[trees.Variant, ...]


#: Levels up to which Spark grows a forest fast: its nodes are few, and each of them has many rows.
SHALLOW = 10
#: Parameters whose smaller values are contained in a fit with the largest.
CONTAINED = {"forest": ("n_estimators", "max_depth", "min_samples_split"), "boosting": ("n_estimators",), "extreme": ("n_estimators",)}


def shared_fits(points: Sequence[dict], family: str) -> list[Shared]:
    """The fits that a grid of trees needs. Trees are grown greedily and one after another, so a model with fewer or
    shallower trees, or with small nodes left whole, is part of a larger one; only other parameters need a fit of their own."""
    contained, groups = CONTAINED[family], {}
    for i, point in enumerate(points):
        groups.setdefault(tuple(sorted((n, v) for n, v in point.items() if n not in contained)), []).append(i)
    out = []
    for own, members in groups.items():
        largest = {n: max(points[i][n] for i in members) for n in ("n_estimators", "max_depth") if n in contained and n in points[members[0]]}
        variants = tuple(trees.Variant(points[i].get("n_estimators", 100), points[i].get("max_depth") if "max_depth" in contained else None,
                                       points[i].get("min_samples_split", 2)) for i in members)
        out.append(Shared(dict(own) | largest, tuple(members), variants))
    return out


def fold_sizes(train: DataFrame) -> dict[int, int]:
    return {r["fold"]: r["count"] for r in train.groupBy("fold").count().collect()}


#: Parameters of Spark's logistic regression that common passes follow.
FOLLOWED = {"maxIter", "tol", "standardization", "regParam", "elasticNetParam"}
#: Features up to which the rows of common passes are held as whole columns.
WIDEST = 512


def descends_side_by_side(train: DataFrame, estimator: LogisticRegression, config: TrainerConfig) -> bool:
    """Whether no other parameter is set, and all rows are such as Spark's solver takes, few features, with both labels in every fold."""
    if config.folds < 2 or any(estimator.isSet(p) and p.name not in FOLLOWED for p in estimator.params):
        return False
    cells = vector_to_array("features")
    plain = F.col("label").isin(0.0, 1.0) & F.forall(cells, lambda x: F.abs(x) < float("inf"))  # in Spark NaN is above infinity
    seen = {r["fold"]: r for r in train.groupBy("fold").agg(
        F.count("*").alias("n"), F.count_if(plain).alias("plain"), F.count_if(F.col("label") == 1.0).alias("ones"),
        F.min(F.size(cells)).alias("least"), F.max(F.size(cells)).alias("most")).collect()}
    return set(seen) == set(range(config.folds)) and len({w for r in seen.values() for w in (r["least"], r["most"])}) == 1 and all(
        r["n"] == r["plain"] and 0 < r["ones"] < r["n"] and 0 < r["most"] <= WIDEST for r in seen.values())


def logistic_fit(estimator: LogisticRegression, params: dict, rows: int, without_fold: int) -> logistic.Fit:
    """One of the fits that share their passes, as ``fitted`` would make it."""
    at = param_map(estimator, params, rows)
    return logistic.Fit(at[estimator.regParam], at[estimator.elasticNetParam] == 1.0, params.get("solver") == "liblinear",
                        estimator.getMaxIter(), estimator.getTol(), estimator.getStandardization(), without_fold)


def cross_validated(train: DataFrame, estimator: Estimator, points: Sequence[dict], config: TrainerConfig) -> list[list[float]]:
    """Fold scores of each point of a grid, from one fit for each point and fold. Where they can, logistic regressions share their
    passes; other fits run ``config.parallelism`` at a time.

    The penalty follows the rows a fold is fitted on.
    """
    sizes = fold_sizes(train)
    rows, score = sum(sizes.values()), evaluator()
    if isinstance(estimator, LogisticRegression) and descends_side_by_side(train, estimator, config):
        fits = [logistic_fit(estimator, points[i], rows - sizes[k], k) for i in range(len(points)) for k in range(config.folds)]
        found = logistic.held_out_areas(train, fits)
        return [found[i * config.folds:(i + 1) * config.folds] for i in range(len(points))]

    def one(task: tuple[int, int]) -> float:
        i, k = task
        fit_on, rest = train.where(F.col("fold") != k), train.where(F.col("fold") == k)
        return score.evaluate(fitted(estimator, fit_on, points[i], rows - sizes.get(k, 0)).transform(rest))

    tasks = [(i, k) for i in range(len(points)) for k in range(config.folds)]
    with ThreadPool(min(config.parallelism, len(tasks))) as pool:
        found = pool.map(one, tasks)
    return [found[i * config.folds:(i + 1) * config.folds] for i in range(len(points))]


def variant_scores(rows: DataFrame, model: trees.Ensemble, variants: Sequence[trees.Variant]) -> list[float]:
    """Area under the ROC curve of each variant; one half where a class is absent."""
    scored = trees.staged_probabilities(rows, model, variants, ["label"])
    found = {r["variant"]: r["auc"] for r in metrics.roc_auc_by(scored, ["variant"]).collect()}
    return [found[i] if found.get(i) is not None else 0.5 for i in range(len(variants))]


def cross_validated_trees(train: DataFrame, estimator: Estimator, family: str, points: Sequence[dict], config: TrainerConfig) -> list[list[float]]:
    """The same for trees, with one fit for each fold and group of points that share it."""
    groups = shared_fits(points, family)
    scores = [[0.0] * config.folds for _ in points]

    def one(task: tuple[Shared, int]) -> None:
        group, k = task
        model = trees.ensemble(estimator.fit(train.where(F.col("fold") != k), param_map(estimator, group.params, 0)))
        for i, auc in zip(group.points, variant_scores(train.where(F.col("fold") == k), model, group.variants)):
            scores[i][k] = auc

    tasks = [(group, k) for group in groups for k in range(config.folds)]
    with ThreadPool(min(config.parallelism, len(tasks))) as pool:
        pool.map(one, tasks)
    return scores


#: Parameters of first-order boosting whose trees do not depend on Spark's random draws.
UNDRAWN = {"n_estimators", "max_depth", "learning_rate", "min_samples_leaf"}


def grows_side_by_side(train: DataFrame, points: Sequence[dict]) -> bool:
    """Whether first-order boosting needs no draws, and all rows are such as Spark's trees take, with some in every fit."""
    if any(set(p) - UNDRAWN for p in points):
        return False
    known = F.forall(vector_to_array("features"), lambda x: F.abs(x) < float("inf"))  # in Spark NaN is above infinity
    seen = train.groupBy("fold").agg(F.count("*").alias("n"), F.count_if(F.col("label").isin(0.0, 1.0) & known).alias("plain")).collect()
    return len(seen) > 1 and all(r["n"] == r["plain"] and r["fold"] is not None for r in seen)


#: Boosted fits that share their passes: the margins of all of them and the histograms of a level are held at once.
SIDE_BY_SIDE = 20


def boosts_in_tasks(train: DataFrame) -> bool:
    """Whether boosted fits can each be grown in a task: few enough values, rows with features, labels 0 and 1."""
    cells = vector_to_array("features")
    seen = train.agg(F.count("*").alias("n"), F.max(F.size(cells)).alias("width"),
                     F.count_if(F.col("label").isin(0.0, 1.0) & F.col("features").isNotNull()).alias("plain")).first()
    return 0 < seen["n"] == seen["plain"] and 0 < seen["width"] and seen["n"] * seen["width"] <= boosting_in_tasks.LARGEST


def tune_boosting(train: DataFrame, family: str, points: Sequence[dict], config: TrainerConfig, key: str) -> tuple[list[list[float]], Callable[[int], trees.Ensemble]]:
    """Fold scores of each point of a grid of boosted trees, and what gives the fit to all rows for a point.

    Up to ``SIDE_BY_SIDE`` fits grow in the same passes, folds and full fits together. Of more fits, those of the folds come first
    and only the chosen point is fitted to all rows: each fit in a task where the table is small, else so many at a time.
    """
    groups = shared_fits(points, family)
    folds, build = tuple(range(config.folds)) if points != [{}] else (), boosting.spark_trees if family == "boosting" else boosting.Boosting
    fit_of = lambda group, k: build(**group.params, seed=config.seed, without_fold=k)
    every = [(group, k) for group in groups for k in folds]
    together = len(groups) * (len(folds) + 1) <= SIDE_BY_SIDE
    if together:
        every = [(group, k) for group in groups for k in (*folds, None)]
    first = fit_of(groups[0], None)
    own = forest.fold_thresholds(train, (*folds, None), first.max_bins, key) if family == "boosting" else None
    common = forest.common_cuts(own) if own else None
    scores, full = [[0.0] * config.folds for _ in points], {}

    labelled = train.where(F.col("label").isNotNull())
    if not together and boosts_in_tasks(labelled):
        if own is None:
            width = len(labelled.select("features").first()[0])
            same = boosting.cut_points(labelled, "features", width, min(256, first.max_bins))
            own = {k: same for k in (*folds, None)}
        fits = [fit_of(group, k) for group, k in every]
        stages = [[min(v.trees, fit.n_estimators) for v in group.variants] for (group, _), fit in zip(every, fits)]
        written = boosting_in_tasks.grow(labelled, fits, key, own, stages)
        found = {(r["fit"], r["variant"]): r["auc"] for r in metrics.roc_auc_by(boosting_in_tasks.held_out(written), ["fit", "variant"]).collect()}
        for i, (group, k) in enumerate(every):
            for variant, point in enumerate(group.points):
                auc = found.get((i, variant))
                scores[point][k] = auc if auc is not None else 0.5

        def refit(at: int) -> trees.Ensemble:
            group = next(group for group in groups if at in group.points)
            fit = replace(fit_of(group, None), n_estimators=points[at].get("n_estimators", first.n_estimators))
            return boosting_in_tasks.ensemble(boosting_in_tasks.grow(labelled, [fit], key, own, [()]), fit, own)

        return scores, refit

    def grown(some: Sequence[tuple[Shared, int | None]]) -> None:
        models = boosting.fit_side_by_side(train, [fit_of(group, k) for group, k in some], key, thresholds=common)

        def one(i: int) -> None:
            (group, k), model = some[i], models[i]
            if k is None:
                full[group.points] = model
                return
            for point, auc in zip(group.points, variant_scores(train.where(F.col("fold") == k), model, group.variants)):
                scores[point][k] = auc

        with ThreadPool(min(config.parallelism, len(some))) as pool:
            pool.map(one, range(len(some)))

    for start in range(0, len(every), SIDE_BY_SIDE):
        grown(every[start:start + SIDE_BY_SIDE])

    def chosen(at: int) -> trees.Ensemble:
        group = next(group for group in groups if at in group.points)
        if group.points not in full:
            grown([(group, None)])
        return full[group.points]

    return scores, chosen


def fits_in_tasks(train: DataFrame, points: Sequence[dict]) -> bool:
    """Whether a forest is grown tree by tree: for deep trees, and few enough rows, all labelled 0 or 1, with features."""
    if max(p.get("max_depth", forest.Forest.max_depth) for p in points or [{}]) <= SHALLOW:
        return False
    seen = train.agg(F.count("*").alias("n"), F.count_if(F.col("label").isin(0.0, 1.0) & F.col("features").isNotNull()).alias("plain")).first()
    return 0 < seen["n"] <= forest.LARGEST and seen["n"] == seen["plain"]


def tune_forest(train: DataFrame, points: Sequence[dict], config: TrainerConfig, key: str) -> list[list[float]]:
    """Fold scores of each point, from forests grown tree by tree; left-out rows are scored in tasks."""
    groups = shared_fits(points, "forest")
    every = [(group, k) for group in groups for k in range(config.folds)]
    fits, variants = [forest.Forest(**group.params, seed=config.seed, without_fold=k) for group, k in every], [group.variants for group, _ in every]
    scored = forest.held_out(forest.grow(train, fits, key, left_out=True), [f.n_estimators for f in fits], variants)
    found = {(r["fit"], r["variant"]): r["auc"] for r in metrics.roc_auc_by(scored, ["fit", "variant"], score="score").collect()}
    scores = [[0.0] * config.folds for _ in points]
    for i, (group, k) in enumerate(every):
        for variant, point in enumerate(group.points):
            auc = found.get((i, variant))
            scores[point][k] = auc if auc is not None else 0.5
    return scores


#: In place of a fold: test rows beside the training rows.
TEST = -2


def fitted_forest(train: DataFrame, test: DataFrame, params: dict, config: TrainerConfig, key: str) -> tuple[Callable[[], Model], float | None]:
    """One forest on all rows, grown tree by tree, that can be loaded as Spark's model, and its area on the test rows. These are
    scored in a task if they are few enough, with features and both labels; else there is no area."""
    part = trees.Variant(params.get("n_estimators", forest.Forest.n_estimators), params.get("max_depth", forest.Forest.max_depth), params.get("min_samples_split", 2))
    fit = forest.Forest(**{n: v for n, v in params.items() if n != "min_samples_split"}, seed=config.seed, without_fold=TEST)
    seen = test.agg(F.count("*").alias("n"), F.count_if(F.col("label").isin(0.0, 1.0) & F.col("features").isNotNull()).alias("plain"),
                    F.count_if(F.col("label") == 1.0).alias("ones")).first()
    here = 0 < seen["ones"] < seen["n"] <= forest.LARGEST and seen["n"] == seen["plain"]
    rows = train.select(key, "features", F.col("label").cast("double").alias("label"), F.lit(0).alias("fold"))
    if here:
        rows = rows.unionByName(test.select(F.lit(None).cast(train.schema[key].dataType).alias(key), "features", F.col("label").cast("double").alias("label"), F.lit(TEST).alias("fold")))
    written, count = forest.grow(rows, [fit], key, left_out=here), fit.n_estimators
    area = metrics.roc_auc_by(forest.held_out(written, [count], [[part]], sums=True), ["fit", "variant"], score="score", share=f"s / {count}").first()["auc"] if here else None
    width = len(train.select("features").first()[0])
    return forest.spark_model(written, 0, part, width), area


def tune(train: DataFrame, test: DataFrame, algorithm: AlgorithmConfig, config: TrainerConfig = TrainerConfig(), key: str = KEY) -> Candidate:
    """Cross-validated grid search over ``fold``, one refit on all training rows, test score.

    ``train`` needs ``features``, ``label`` and ``fold``, ``test`` the first two; rows are drawn by ``key``, for boosting and
    for thresholds. ``config.max_points`` bounds the points searched, evenly spread over the grid, and ``config.within`` keeps those
    with the values it names; the candidate says how many of how many they were.
    """
    estimator, score = base_estimator(algorithm, config), evaluator()
    grid = expand_grid(algorithm.grid) if algorithm.grid else []
    kept = [p for p in grid if all(p[n] in config.within[n] for n in p if n in config.within)]
    most = min(len(kept), config.max_points or len(kept))
    points = [kept[i * len(kept) // most] for i in range(most)]
    best, cv_score, cv_std, scores, full = {}, None, None, None, None
    in_tasks = algorithm.family == "forest" and fits_in_tasks(train, points)
    together = algorithm.family == "extreme" or algorithm.family == "boosting" and grows_side_by_side(train, points)
    if together:
        found, full = tune_boosting(train, algorithm.family, points or [{}], config, key)
        scores = found if points else None
    elif in_tasks and points:
        for params in points:
            param_map(estimator, params, 0)  # names without a counterpart are refused
        scores = tune_forest(train, points, config, key)
    elif points:
        scores = (cross_validated(train, estimator, points, config) if algorithm.family == "logistic"
                  else cross_validated_trees(train, estimator, algorithm.family, points, config))
    at, area, build = 0, None, None
    if scores:
        at = max(range(len(points)), key=lambda i: (fmean(scores[i]), -i))
        best, cv_score, cv_std = points[at], fmean(scores[at]), pstdev(scores[at])
    if together:
        grown = full(at)
        part = replace(grown, trees=grown.trees[:best.get("n_estimators", len(grown.trees))])
        rate = boosting.spark_trees(**best).learning_rate if algorithm.family == "boosting" else None
        model = boosting.as_spark_model(train.sparkSession, part, len(train.select("features").first()[0]), rate)
    elif in_tasks:
        build, area = fitted_forest(train, test, best, config, key)
    else:
        model = fitted(estimator, train, best, train.count())
    if build is None:
        build = lambda: model
    found = Candidate(algorithm.name, best, build, cv_score, cv_std, area, len(points), len(grid))
    return found if area is not None else replace(found, test_score=score.evaluate(found.model.transform(test)))


def tune_all(train: DataFrame, test: DataFrame, config: TrainerConfig = TrainerConfig(), key: str = KEY) -> list[Candidate]:
    """The candidates in the order of the algorithms, which are tuned side by side, ``config.parallelism`` fits of each at a time."""
    with ThreadPool(max(1, min(config.parallelism, len(config.algorithms)))) as pool:
        return pool.map(lambda a: tune(train, test, a, config, key), config.algorithms, 1)


def select_best(candidates: list[Candidate], config: TrainerConfig = TrainerConfig()) -> Candidate:
    """The first of the best; judged by cross-validation, or by the test score for parity."""
    def value(c: Candidate) -> float:
        return c.test_score if config.select_by == "test" or c.cv_score is None else c.cv_score

    best = candidates[0]
    for c in candidates[1:]:
        if value(c) > value(best):
            best = c
    if best.test_score < config.warn_below:
        log.warning("best model %s scores only %.3f", best.name, best.test_score)
    return best


def leaderboard(spark, candidates: list[Candidate]) -> DataFrame:
    rows = [(i, c.name, str(c.params), c.cv_score, c.cv_std, c.test_score, c.searched, c.published) for i, c in enumerate(candidates)]
    return spark.createDataFrame(
        rows, "position int, model_name string, best_params string, cv_score double, cv_std double, test_auc double, "
              "points_searched int, points_published int",
    ).orderBy(F.desc("test_auc"), "position")


def fold_scores(data: DataFrame, estimator: Estimator, params: dict | None = None, config: TrainerConfig = TrainerConfig()) -> DataFrame:
    """(fold, auc): one fit per fold on the other folds, with the penalty rule of the grid search."""
    found = cross_validated(data, estimator, [params or {}], config)[0]
    return data.sparkSession.createDataFrame(list(enumerate(found)), "fold int, auc double")


def cv_report(scores: DataFrame) -> DataFrame:
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("fold", "auc"))), lambda x: x["auc"])
    return scores.agg(F.avg("auc").alias("mean_cv_score"), F.stddev_pop("auc").alias("std_cv_score"),
                      ordered.alias("cv_scores"))


def feature_importances(model: Model, names: list[str]) -> DataFrame | None:
    """Split-based importances of a tree model by feature name; None for other models."""
    values = getattr(model, "featureImportances", None)
    if values is None:
        return None
    rows = [(n, float(v)) for n, v in zip(names, values.toArray())]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature")


def as_scorecard(model: Model, names: list[str]) -> Scorecard:
    """A fitted logistic regression as intercept and weights by feature name."""
    return Scorecard(float(model.intercept), dict(zip(names, map(float, model.coefficients.toArray()))))
