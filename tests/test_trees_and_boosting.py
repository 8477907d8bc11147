"""Trees as node tables, attribution by cover and by kernel weights, second-order boosting, shared grid searches."""

import itertools
import math
import threading

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskframe.config import (
    EXTREME_BOOSTING, FOREST_GRID, GRADIENT_BOOSTING, LOGISTIC_GRID, RANDOM_FOREST, AlgorithmConfig, TrainerConfig,
)
from riskframe.operators import boosting, kernel, metrics, train, trees

WIDTH = 5
NAMES = [f"x{i}" for i in range(WIDTH)]


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(3)
    x = np.round(draw.normal(size=(400, WIDTH)), 1)
    x[:, 4] = draw.integers(0, 3, 400)
    y = (x[:, 0] + x[:, 1] * x[:, 2] + draw.normal(size=400) * 0.5 > 0.3).astype(float)
    made = spark.createDataFrame([(i, [float(v) for v in r], float(t), i % 3) for i, (r, t) in enumerate(zip(x, y))], "id long, x array<double>, label double, fold int")
    return made.select("id", array_to_vector("x").alias("features"), "label", "fold").cache(), x, y


def probabilities(model, df):
    return np.array([r.p for r in model.transform(df).orderBy("id").select(vector_to_array("probability")[1].alias("p")).collect()])


def score(model, x, variants=None):
    variants = variants or [trees.Variant(len(model.trees))]
    return trees.staged_scores(x, model.trees, variants) + model.start


# ---------------------------------------------------------------- node tables

@pytest.mark.parametrize("family", ["forest", "boosting"])
def test_read_trees_score_like_the_model(rows, family):
    df, x, _ = rows
    fitted = (RandomForestClassifier(numTrees=6, maxDepth=6, seed=1) if family == "forest" else GBTClassifier(maxIter=5, maxDepth=3, seed=1)).fit(df)
    model = trees.ensemble(fitted)
    assert model.log_odds == (family == "boosting") and len(model.trees) == (6 if family == "forest" else 5)
    assert model.probability(score(model, x)[:, 0]) == pytest.approx(probabilities(fitted, df), abs=1e-12)


def test_variants_are_contained_in_one_fit(rows):
    df, x, _ = rows
    fitted = RandomForestClassifier(numTrees=5, maxDepth=8, seed=2).fit(df)
    model = trees.ensemble(fitted)
    variants = [trees.Variant(3, 2, 2), trees.Variant(5, None, 30), trees.Variant(5, 4, 12), trees.Variant(9, 8, 2)]
    found = trees.staged_scores(x, model.trees, variants)

    def walk(tree, row, depth, least, node=0, level=0):
        if tree.left[node] < 0 or level == depth or tree.rows[node] < least:
            return tree.value[node]
        side = tree.left if row[tree.feature[node]] <= tree.threshold[node] else tree.right
        return walk(tree, row, depth, least, side[node], level + 1)

    for i, v in enumerate(variants):
        want = [sum(walk(t, r, 99 if v.depth is None else v.depth, v.min_split) for t in model.trees[:v.trees]) for r in x[:40]]
        assert found[:40, i] == pytest.approx(want, abs=1e-12)
    staged = {(r.id, r.variant): r.probability for r in trees.staged_probabilities(df, model, variants, ["id"]).collect()}
    assert len(staged) == 400 * 4 and staged[7, 0] == pytest.approx(found[7, 0] * 5 / 3) and staged[7, 1] == pytest.approx(found[7, 1])
    cut = trees.collapse(fitted, 30)
    assert probabilities(cut, df) == pytest.approx(found[:, 1], abs=1e-12)
    again = trees.ensemble(cut)
    assert all((t.rows[~t.leaf] >= 30).all() for t in again.trees) and cut.totalNumNodes < fitted.totalNumNodes
    assert max(int(t.depth.max()) for t in again.trees) <= 8


def test_a_collapsed_forest_of_single_leaves(rows):
    df, _, y = rows
    cut = trees.collapse(RandomForestClassifier(numTrees=2, maxDepth=3, seed=2).fit(df), 10_000)
    assert cut.totalNumNodes == 2 and len(set(probabilities(cut, df).round(12))) == 1


# ---------------------------------------------------------------- attribution by cover

def by_subsets(model, row, width):
    """Shapley values by enumerating all subsets of known features."""
    def value(tree, known, node=0):
        if tree.left[node] < 0:
            return tree.value[node]
        low, high = tree.left[node], tree.right[node]
        if tree.feature[node] in known:
            return value(tree, known, low if row[tree.feature[node]] <= tree.threshold[node] else high)
        return (tree.cover[low] * value(tree, known, low) + tree.cover[high] * value(tree, known, high)) / tree.cover[node]

    total = {s: sum(value(t, s) for t in model.trees) for k in range(width + 1) for s in map(frozenset, itertools.combinations(range(width), k))}
    return [sum(math.factorial(len(s)) * math.factorial(width - len(s) - 1) / math.factorial(width) * (total[s | {i}] - v)
                for s, v in total.items() if i not in s) for i in range(width)], total[frozenset()]


@pytest.mark.parametrize("family", ["forest", "boosting"])
def test_cover_attribution_equals_all_subsets(rows, family):
    df, x, _ = rows
    fitted = (RandomForestClassifier(numTrees=3, maxDepth=7, seed=1) if family == "forest" else GBTClassifier(maxIter=4, maxDepth=4, seed=1)).fit(df)
    model = trees.ensemble(fitted)
    found = trees.cover_attribution(df.where("id < 12"), model, NAMES, "id").toPandas()
    for i, own in found.groupby("id"):
        want, base = by_subsets(model, x[i], WIDTH)
        assert own.set_index("feature").loc[NAMES, "contribution"].to_numpy() == pytest.approx(want, abs=1e-10)
        assert own["base_value"].iloc[0] == pytest.approx(base) and own["value"].tolist() == x[i].tolist()
    assert found.groupby("id")["probability"].first().to_numpy() == pytest.approx(probabilities(fitted, df)[:12], abs=1e-10)


def test_cover_attribution_of_odd_trees(rows):
    df, x, _ = rows
    leaf = trees.from_nested((0.3, 5.0), NAMES)
    unmet = trees.from_nested(("x0", 0.0, ("x1", 0.0, (1.0, 0.0), (2.0, 4.0)), ("x0", 1.0, (-1.0, 3.0), (0.5, 3.0))), NAMES)  # no cover on one side
    model = trees.Ensemble((leaf, unmet), True)
    found = trees.cover_attribution(df.where("id < 30"), model, NAMES, "id").toPandas()
    for i, own in found.groupby("id"):
        assert own.set_index("feature").loc[NAMES, "contribution"].to_numpy() == pytest.approx(by_subsets(model, x[i], WIDTH)[0], abs=1e-12)
    assert trees.cover_attribution(df.where("id < 0"), model, NAMES, "id").count() == 0


# ---------------------------------------------------------------- kernel attribution

def test_kernel_weights_of_all_coalitions_are_exact():
    draw = np.random.default_rng(0)
    for width in (1, 2, 4, 6):
        made = kernel.coalitions(width, 2048)
        values = {tuple(m): draw.normal() for m in made.masks}
        v = np.array([values[tuple(m)] for m in made.masks])
        want = []
        for i in range(width):
            total = 0.0
            for m, known in values.items():
                if not m[i]:
                    s = sum(m)
                    total += math.factorial(s) * math.factorial(width - s - 1) / math.factorial(width) * (values[m[:i] + (1,) + m[i + 1:]] - known)
            want.append(total)
        assert made.solve @ v == pytest.approx(want, abs=1e-9)


def test_drawn_coalitions_add_up_and_solve_additive_games():
    made = kernel.coalitions(30, 400, seed=1)
    assert len(made.masks) <= 402 and not made.masks[0].any() and made.masks[-1].all()
    weights = np.arange(30.0)
    v = (made.masks * weights).sum(1) + 2.0
    assert (made.solve * v).sum(1) == pytest.approx(weights, abs=1e-6)
    few = kernel.coalitions(30, 8, seed=1)  # too few to determine all features, still adding up
    assert (few.solve * (few.masks * weights).sum(1)).sum() == pytest.approx(weights.sum())


def test_kernel_attribution_of_a_forest(rows):
    df, x, _ = rows
    fitted = RandomForestClassifier(numTrees=3, maxDepth=4, seed=1).fit(df)
    model, background = trees.ensemble(fitted), x[100:110]
    found = kernel.kernel_attribution(df.where("id < 3"), fitted, NAMES, "id", background).toPandas()
    for i, own in found.groupby("id"):
        total = {}
        for mask in itertools.product((0, 1), repeat=WIDTH):
            total[mask] = score(model, np.where(np.array(mask, bool), x[i], background))[:, 0].mean()
        want = [sum(math.factorial(sum(m)) * math.factorial(WIDTH - sum(m) - 1) / math.factorial(WIDTH) * (total[m[:f] + (1,) + m[f + 1:]] - v)
                    for m, v in total.items() if not m[f]) for f in range(WIDTH)]
        assert own.set_index("feature").loc[NAMES, "contribution"].to_numpy() == pytest.approx(want, abs=1e-9)
        assert own["base_value"].iloc[0] == pytest.approx(total[(0,) * WIDTH]) and own["probability"].iloc[0] == pytest.approx(total[(1,) * WIDTH])


# ---------------------------------------------------------------- second-order boosting

def plain_round(x, y, margins, use, features, fit):
    """One tree by brute force: every present value of every feature is tried in every node."""
    p = 1 / (1 + np.exp(-margins))
    g, h, out = p - y, p * (1 - p), np.zeros(len(y))

    def grow(at, everywhere, level):
        G, H = g[at].sum(), h[at].sum()
        best = (1e-6, None)
        if level < fit.max_depth:
            for f in features:
                for cut in sorted(set(x[at, f]))[:-1]:
                    low = x[at, f] <= cut
                    gl, hl = g[at][low].sum(), h[at][low].sum()
                    if min(hl, H - hl) >= fit.min_child_weight:
                        gain = gl ** 2 / (hl + fit.reg_lambda) + (G - gl) ** 2 / (H - hl + fit.reg_lambda) - G ** 2 / (H + fit.reg_lambda)
                        if gain > max(best[0], fit.gamma) + 1e-12:
                            best = (gain, (f, cut))
        if best[1] is None:
            out[everywhere] = -fit.learning_rate * G / (H + fit.reg_lambda)
            return
        f, cut = best[1]
        grow(at[x[at, f] <= cut], everywhere[x[everywhere, f] <= cut], level + 1)
        grow(at[x[at, f] > cut], everywhere[x[everywhere, f] > cut], level + 1)

    grow(np.flatnonzero(use), np.arange(len(y)), 0)
    return out


def marks(df):
    return np.array([r.m for r in df.select("id", F.xxhash64("id").alias("m")).orderBy("id").collect()], np.int64)


@pytest.mark.parametrize("fit", [
    boosting.Boosting(n_estimators=3, max_depth=3, max_bins=256),
    boosting.Boosting(n_estimators=3, max_depth=2, learning_rate=0.1, subsample=0.7, colsample_bytree=0.6, max_bins=256, seed=5),
    boosting.Boosting(n_estimators=2, max_depth=4, reg_lambda=5.0, gamma=1.0, min_child_weight=6.0, max_bins=256, base_score=0.3, without_fold=1),
], ids=["plain", "sampled", "restrained"])
def test_boosting_equals_brute_force(rows, fit, monkeypatch):
    monkeypatch.setattr(boosting, "ROUNDS_HELD", 2)
    df, x, y = rows
    model = boosting.fit_side_by_side(df, [fit], "id")[0]
    margins, folds = np.full(len(y), fit.start), np.arange(len(y)) % 3
    for round_ in range(fit.n_estimators):
        use = boosting.drawn(fit, round_, marks(df), folds)
        assert 0.5 < use.mean() <= 1 and (fit.subsample == 1 or use.mean() < 0.85)
        margins = margins + plain_round(x, y, margins, use, boosting.sampled_features(fit, round_, WIDTH), fit)
    assert score(model, x)[:, 0] == pytest.approx(margins, abs=1e-9)


def test_fits_grow_side_by_side_as_alone(rows, monkeypatch):
    df, x, _ = rows
    fits = [boosting.Boosting(n_estimators=2, max_depth=2), boosting.Boosting(n_estimators=4, max_depth=1, subsample=0.8, without_fold=2)]
    together = boosting.fit_side_by_side(df, fits, "id")
    monkeypatch.setattr(boosting, "TASK_ROWS", 50)  # sums of several tasks are exchanged
    for fit, model in zip(fits, together):
        alone = boosting.fit_side_by_side(df.repartition(5), [fit], "id")[0]
        assert len(model.trees) == fit.n_estimators
        assert score(alone, x)[:, 0] == pytest.approx(score(model, x)[:, 0], abs=1e-9)


def test_boosted_trees_become_a_spark_model(spark, rows, tmp_path):
    df, x, _ = rows
    model = boosting.fit_side_by_side(df, [boosting.Boosting(n_estimators=3, max_depth=3, base_score=0.4)], "id")[0]
    loaded = boosting.as_spark_model(spark, model, WIDTH)
    assert probabilities(loaded, df) == pytest.approx(model.probability(score(model, x)[:, 0]), abs=1e-12)
    loaded.write().save(str(tmp_path / "m"))
    from pyspark.ml.classification import GBTClassificationModel
    again = GBTClassificationModel.load(str(tmp_path / "m"))
    assert probabilities(again, df) == pytest.approx(probabilities(loaded, df))
    read = trees.ensemble(again)  # attribution works on it like on any other
    assert score(read, x)[:, 0] == pytest.approx(score(model, x)[:, 0], abs=1e-12)


def test_boosting_without_rows_or_with_one_class(spark, rows):
    df, x, _ = rows
    assert boosting.fit_side_by_side(df.limit(0), [boosting.Boosting()], "id") == [trees.Ensemble((), True, 0.0)]
    same = boosting.fit_side_by_side(df.withColumn("label", F.lit(0.0)), [boosting.Boosting(n_estimators=2, max_depth=2)], "id")[0]
    assert all(len(t.left) == 1 for t in same.trees) and (score(same, x) < 0).all()


def test_sums_of_a_block_by_node_feature_and_bin():
    """Each fit's sums equal plain ones, cell by cell, for features of one, two and many bins, sampled rows and features left out."""
    draw = np.random.default_rng(1)
    sizes, n = np.array([7, 2, 1, 2, 3]), 500
    layout = boosting.Layout(np.concatenate([[0], np.cumsum(sizes)]))
    bins = np.stack([draw.integers(0, k, n) for k in sizes]).astype(np.uint8)
    tree = boosting.Growing()
    tree.open = tree.split(0, 0, 3, (0, 0, 0), (0, 0, 0))
    fits = [boosting.Boosting(subsample=0.7, without_fold=1), boosting.Boosting()]
    block = draw.integers(-2**62, 2**62, n), draw.integers(0, 2, n).astype(float), draw.integers(0, 3, n).astype(np.int32), bins, draw.normal(size=(2, n))
    growing = {i: (tree.arrays(), np.array(tree.open), np.array([0, 1, 2, 4])) for i in range(2)}
    for i, sums in boosting.block_sums(block, fits, growing, 4, layout):
        use = boosting.drawn(fits[i], 4, block[0], block[2])
        p = 1 / (1 + np.exp(-block[4][i]))
        for node, below in enumerate((bins[0] <= 3, bins[0] > 3)):
            for f in range(5):
                cells = sums[:, node, layout.offsets[f]:layout.offsets[f + 1]]
                for b in range(sizes[f]):
                    at = use & below & (bins[f] == b) if f != 3 else np.zeros(n, bool)
                    assert cells[:, b] == pytest.approx([(p - block[1])[at].sum(), (p * (1 - p))[at].sum(), at.sum()], abs=1e-9)


def test_large_trees_apply_like_small_ones(monkeypatch):
    draw = np.random.default_rng(2)
    tree, bins = boosting.Growing(), draw.integers(0, 9, (4, 300)).astype(np.uint8)
    for node in range(20):
        tree.split(node, int(draw.integers(4)), int(draw.integers(8)), (0, 0, 0), (0, 0, 0))
    small = boosting.node_of(tree.arrays(), bins)
    monkeypatch.setattr(boosting, "SMALL_TREE", 3)
    assert len(set(small)) > 5 and (boosting.node_of(tree.arrays(), bins) == small).all()


def test_tasks_of_a_pass_are_bounded(rows, monkeypatch):
    """Every task sends its sums, so tiny tasks would make the exchange grow faster than the rows."""
    df, x, _ = rows
    monkeypatch.setattr(boosting, "TASK_ROWS", 4)
    seen, best = [], boosting.best_splits
    monkeypatch.setattr(boosting, "best_splits", lambda blocks, *a: seen.append(blocks.getNumPartitions()) or best(blocks, *a))
    fit = boosting.Boosting(n_estimators=2, max_depth=1)
    found = boosting.fit_side_by_side(df, [fit], "id")[0]
    assert max(seen) <= boosting.TASKS_A_CORE * df.sparkSession.sparkContext.defaultParallelism
    monkeypatch.setattr(boosting, "TASK_ROWS", 20_000)
    assert score(found, x)[:, 0] == pytest.approx(score(boosting.fit_side_by_side(df, [fit], "id")[0], x)[:, 0], abs=1e-9)


def test_cuts_of_many_values_are_quantiles(spark):
    df = spark.range(5000).select(array_to_vector(F.array(F.col("id").cast("double"), (F.col("id") % 4).cast("double"), F.lit(1.0))).alias("features"))
    many, few, one = boosting.cut_points(df, "features", 3, 16)
    assert len(many) == 15 and np.abs(np.diff(many) - 5000 / 16).max() < 5 and few.tolist() == [0, 1, 2] and len(one) == 0


# ---------------------------------------------------------------- searches

def test_published_points_and_the_fits_they_need():
    count = lambda a, family: (len(train.expand_grid(a.grid)), len(train.shared_fits(train.expand_grid(a.grid), family)))
    assert len(train.expand_grid(LOGISTIC_GRID)) == 16
    assert count(RANDOM_FOREST, "forest") == (81, 3)
    assert count(GRADIENT_BOOSTING, "boosting") == (18, 9)
    assert count(EXTREME_BOOSTING, "extreme") == (243, 81)
    group = train.shared_fits(train.expand_grid(FOREST_GRID), "forest")[0]
    assert group.params == {"min_samples_leaf": 1, "n_estimators": 300, "max_depth": 30} and len(group.variants) == 27


def test_search_of_each_family(rows):
    df, x, _ = rows
    config = TrainerConfig(folds=3, max_iter=30)
    forest = train.tune(df, df, AlgorithmConfig("F", "forest", {"n_estimators": (2, 4), "max_depth": (2, 6), "min_samples_split": (2, 60)}), config, "id")
    assert (forest.searched, forest.published) == (8, 8) and 0.5 < forest.cv_score < 1
    assert all((t.rows[~t.leaf] >= forest.params["min_samples_split"]).all() for t in trees.ensemble(forest.model).trees)
    assert len(forest.model.trees) == forest.params["n_estimators"]
    extreme = train.tune(df, df, AlgorithmConfig("X", "extreme", {"n_estimators": (1, 3), "max_depth": (2,), "learning_rate": (0.3,)}), config, "id")
    assert extreme.searched == 2 and len(extreme.model.trees) == extreme.params["n_estimators"] + 1 and extreme.test_score > 0.7
    some = train.tune(df, df, AlgorithmConfig("B", "boosting", {"n_estimators": (1, 2), "max_depth": (2, 3)}), TrainerConfig(folds=3, within={"max_depth": (2,)}), "id")
    assert (some.searched, some.published) == (2, 4) and some.params["max_depth"] == 2


def test_area_by_group_equals_the_single_one(spark, rows):
    df, x, y = rows
    scored = df.select("id", "label", "fold", (F.round(F.abs(vector_to_array("features")[0]) / 4, 2)).alias("probability"))
    found = {r.fold: r.auc for r in metrics.roc_auc_by(scored, ["fold"], ranges=7).collect()}
    for k, auc in found.items():
        assert auc == pytest.approx(metrics.roc_auc(scored.where(F.col("fold") == k), "label"))
    assert metrics.roc_auc_by(scored.where("label = 1"), ["fold"]).where("auc is not null").count() == 0


def test_solvers_differ_in_the_penalty_of_the_intercept(rows):
    df, x, y = rows
    estimator = train.base_estimator(AlgorithmConfig("L", "logistic"), TrainerConfig(tolerance=1e-10))
    n = len(y)
    free = train.fitted(estimator, df, {"C": 0.02, "penalty": "l2", "solver": "saga"}, n)
    held = train.fitted(estimator, df, {"C": 0.02, "penalty": "l2", "solver": "liblinear"}, n)
    assert abs(held.intercept) < abs(free.intercept)
    for model, all_ in ((free, False), (held, True)):  # the gradient vanishes at the optimum
        w, b = model.coefficients.toArray(), model.intercept
        gap = 1 / (1 + np.exp(-(x @ w + b))) - y
        assert x.T @ gap + w / 0.02 == pytest.approx(np.zeros(WIDTH), abs=1e-3)
        assert gap.sum() + (b / 0.02 if all_ else 0.0) == pytest.approx(0.0, abs=1e-3)


def test_algorithms_are_tuned_side_by_side_in_their_order(rows, monkeypatch):
    """Each waits for the others: one after another they would never meet."""
    df, _, _ = rows
    meet, tune = threading.Barrier(3, timeout=30), train.tune
    monkeypatch.setattr(train, "tune", lambda a, b, algorithm, *rest: (meet.wait(), algorithm.name)[1])
    algorithms = tuple(AlgorithmConfig(name, "logistic") for name in "bca")
    assert train.tune_all(df, df, TrainerConfig(algorithms=algorithms)) == ["b", "c", "a"]
    monkeypatch.setattr(train, "tune", tune)
    assert train.tune_all(df, df, TrainerConfig(algorithms=())) == []
