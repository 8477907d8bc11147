"""Attribution of scores to inputs: linear in closed form, sampled for any classifier.

Linear attributions stay wide (one expression per feature) as long as possible: global tables
are one aggregate over the rows, per-row tables are array expressions. Neither shuffles rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel, RandomForestClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import add_all, array, double, names_of, num, q, struct, text
from riskframe.operators.score import Scorecard, sigmoid
from riskframe.operators.split import sample_rows


# ---------------------------------------------------------------- linear attribution

@dataclass(frozen=True)
class LinearAttribution:
    """Contributions weight * (x - background mean) in log-odds; they add up to the logit."""

    card: Scorecard
    background: Mapping[str, float]
    columns: Mapping[str, str] | None = None

    @property
    def features(self) -> tuple[str, ...]:
        return self.card.features

    @property
    def base_value(self) -> float:
        return self.card.intercept + sum(w * self.background[f] for f, w in self.card.weights.items())

    def value(self, feature: str) -> str:
        return (self.columns or {}).get(feature) or double(feature)

    def contribution(self, feature: str) -> str:
        weight, mean = float(self.card.weights[feature]), float(self.background[feature])
        return f"({num(weight)} * ({self.value(feature)} - {num(mean)}))"

    def records(self) -> str:
        """array<struct<feature, value, contribution>> in feature order."""
        return array([struct(feature=text(f), value=self.value(f), contribution=self.contribution(f))
                      for f in self.features])


def background_means(df: DataFrame, card: Scorecard, key: Sequence[str], n: int = 100, seed: int = 42,
                     columns: Mapping[str, str] | None = None) -> dict[str, float]:
    """Feature means over a background sample of at most ``n`` rows: one small row."""
    sample = sample_rows(df, key, n, seed)
    means = [F.expr(f"avg({(columns or {}).get(f) or double(f)})") for f in card.features]
    row = sample.agg(*means).first()
    return {f: float(row[i]) if row[i] is not None else 0.0 for i, f in enumerate(card.features)}


def linear_attribution(df: DataFrame, card: Scorecard, key: Sequence[str], background_rows: int = 100,
                       seed: int = 42, columns: Mapping[str, str] | None = None) -> LinearAttribution:
    return LinearAttribution(card, background_means(df, card, key, background_rows, seed, columns), columns)


def attribution_method(model: Model) -> str:
    """Which attribution fits the model family."""
    if isinstance(model, LogisticRegressionModel):
        return "linear"
    return "tree" if isinstance(model, (RandomForestClassificationModel, GBTClassificationModel)) else "sampled"


def contributions(df: DataFrame, how: LinearAttribution, keep: Sequence[str]) -> DataFrame:
    """Long table (kept columns, feature, value, contribution); no shuffle."""
    return df.selectExpr(*names_of(keep), f"inline({how.records()})")


def _wide_aggregate(df: DataFrame, cells: Sequence[str]) -> DataFrame:
    """One global aggregate of struct expressions, turned to rows at the end."""
    wide = df.agg(*[F.expr(c).alias(f"s{i}") for i, c in enumerate(cells)])
    return wide.selectExpr(f"inline({array([f's{i}' for i in range(len(cells))])})")


def attribution_stats(df: DataFrame, how: LinearAttribution) -> DataFrame:
    """Mean, population deviation and mean size of the contributions, most important first."""
    width = f"{len(how.features)}L"
    cells = [
        struct(feature=text(f), mean_contribution=f"avg({c})", std_contribution=f"stddev_pop({c})",
               mean_abs_contribution=f"avg(abs({c}))", n_rows="count(*)", n_features=width)
        for f in how.features for c in [how.contribution(f)]
    ]
    return _wide_aggregate(df, cells).orderBy(F.desc("mean_abs_contribution"), "feature")


def global_importance(df: DataFrame, how: LinearAttribution, top: int | None = None) -> DataFrame:
    cells = [struct(feature=text(f), importance=f"avg(abs({how.contribution(f)}))") for f in how.features]
    out = _wide_aggregate(df, cells).orderBy(F.desc("importance"), "feature")
    return out if top is None else out.limit(top)


def importance_of_long(long: DataFrame, top: int | None = None) -> DataFrame:
    """The same from a long contribution table, such as a sampled attribution."""
    out = (long.groupBy("feature").agg(F.expr("avg(abs(contribution)) AS importance"))
           .orderBy(F.desc("importance"), "feature"))
    return out if top is None else out.limit(top)


def stats_of_long(long: DataFrame, n_features: int) -> DataFrame:
    return long.groupBy("feature").agg(
        F.expr("avg(contribution) AS mean_contribution"),
        F.expr("stddev_pop(contribution) AS std_contribution"),
        F.expr("avg(abs(contribution)) AS mean_abs_contribution"),
        F.expr("count(*) AS n_rows"), F.expr(f"{n_features}L AS n_features"),
    ).orderBy(F.desc("mean_abs_contribution"), "feature")


def ranked_features(df: DataFrame, how: LinearAttribution, top: int) -> list[str]:
    """Names of the most important features, best first: a list as short as the model is wide."""
    return [r["feature"] for r in global_importance(df, how, top).collect()]


def by_size(records: str) -> str:
    """Sort attribution records by absolute contribution, largest first, names break ties."""
    keyed = (f"transform({records}, r -> struct(-abs(r.contribution) AS k, r.feature AS feature, "
             "r.value AS value, r.contribution AS contribution))")
    return (f"transform(sort_array({keyed}), r -> struct(r.feature AS feature, r.value AS value, "
            "r.contribution AS contribution))")


def top_contributions(df: DataFrame, how: LinearAttribution, keep: Sequence[str], k: int = 10) -> DataFrame:
    """Per row an ``explanation`` array with its k largest contributions."""
    return df.selectExpr(*names_of(keep), f"slice({by_size(how.records())}, 1, {k}) AS explanation")


def local_explanation(scored: DataFrame, how: LinearAttribution, keep: Sequence[str], k: int = 10) -> DataFrame:
    """Class, both probabilities, base value, all contributions and the top k, per row."""
    packed = scored.selectExpr(
        *names_of(keep), "prediction", "array(1D - probability, probability) AS prediction_probability",
        f"{num(how.base_value)} AS base_value", f"{how.records()} AS contributions")
    return packed.selectExpr("*", f"slice({by_size('contributions')}, 1, {k}) AS feature_contributions")


def waterfall(df: DataFrame, how: LinearAttribution, keep: Sequence[str], max_display: int = 15) -> DataFrame:
    """Ordered contributions with the running total; what does not fit is summed as one step."""
    n = len(how.features)
    steps = "ordered"
    if n > max_display:
        other = struct(
            feature=text(f"{n - max_display + 1} other features"), value="CAST(NULL AS DOUBLE)",
            contribution=f"aggregate(slice(ordered, {max_display}, {n}), 0D, (acc, r) -> acc + r.contribution)")
        steps = f"concat(slice(ordered, 1, {max_display - 1}), array({other}))"
    # one pass that carries the running total
    empty = "CAST(array() AS ARRAY<STRUCT<step: INT, feature: STRING, contribution: DOUBLE, running_total: DOUBLE>>)"
    step = ("struct(size(acc.rows) + 1 AS step, r.feature AS feature, r.contribution AS contribution, "
            "acc.total + r.contribution AS running_total)")
    running = (f"aggregate(steps, struct({num(how.base_value)} AS total, {empty} AS rows), (acc, r) -> "
               f"struct(acc.total + r.contribution AS total, concat(acc.rows, array({step})) AS rows), acc -> acc.rows)")
    kept = names_of(keep)
    return (df.selectExpr(*kept, f"{by_size(how.records())} AS ordered")
            .selectExpr(*kept, f"{steps} AS steps")
            .selectExpr(*kept, f"inline({running})"))


def push_totals(df: DataFrame, how: LinearAttribution, keep: Sequence[str]) -> DataFrame:
    """How much each row is pushed up, pushed down, and where it ends."""
    terms = [how.contribution(f) for f in how.features]
    base = num(how.base_value)
    return df.selectExpr(
        *names_of(keep), f"{base} AS base_value",
        add_all([f"greatest({t}, 0D)" for t in terms]) + " AS push_up",
        add_all([f"least({t}, 0D)" for t in terms]) + " AS push_down",
        add_all([base, *terms]) + " AS output_value")


def impact_table(df: DataFrame, how: LinearAttribution, keep: Sequence[str], top: int = 15) -> DataFrame:
    """Feature values against contributions for the most important features."""
    records = array([
        struct(rank=str(i + 1), feature=text(f), value=how.value(f), contribution=how.contribution(f))
        for i, f in enumerate(ranked_features(df, how, top))])
    return df.selectExpr(*names_of(keep), f"inline({records})")


def decision_paths(df: DataFrame, how: LinearAttribution, key: Sequence[str], n: int = 20,
                   seed: int = 42) -> DataFrame:
    """Cumulative output of sampled rows, from the least to the most important feature.

    The order is the same for all rows, so the running sums are plain column expressions.
    """
    order = list(reversed(ranked_features(df, how, len(how.features))))
    terms = [num(how.base_value)]
    steps = []
    for i, f in enumerate(order):
        terms.append(how.contribution(f))
        steps.append(struct(step=str(i + 1), feature=text(f), cumulative=add_all(terms)))
    return sample_rows(df, key, n, seed).selectExpr(*names_of(key), f"inline({array(steps)})")


def contribution_matrix(scored: DataFrame, how: LinearAttribution, key: Sequence[str], n: int = 50,
                        top: int = 15, seed: int = 42) -> DataFrame:
    """One row per sampled account, one column per important feature, by falling probability."""
    names = ranked_features(scored, how, top)
    cells = [f"{how.contribution(f)} AS {q(f)}" for f in names]
    return sample_rows(scored, key, n, seed).selectExpr(*names_of(key), "probability", *cells).orderBy(
        F.desc("probability"), *names_of(key))


def partial_dependence(df: DataFrame, card: Scorecard, features: Sequence[str], points: int = 100) -> DataFrame:
    """Mean probability when one feature is set to each grid value between its extremes.

    The log-odds of a row are computed once; a grid value changes one term of them. So each feature is one aggregate of
    ``points`` averages over the rows as they are, and one row per task is shuffled.
    """
    ends = df.agg(*[F.expr(struct(lo=f"min({double(f)})", hi=f"max({double(f)})")) for f in features]).first()
    base = df.selectExpr(f"{card.logit()} AS z", *[f"{double(f)} AS {q(f)}" for f in features])
    out = None
    for i, f in enumerate(features):
        lo, hi = ends[i].lo, ends[i].hi
        if lo is None:
            continue
        weight = num(float(card.weights[f]))
        grid = [float(lo + (hi - lo) * p / max(1, points - 1)) for p in range(points)]
        shifted = [sigmoid(f"(z + {weight} * ({num(g)} - {q(f)}))") for g in grid]
        curve = _wide_aggregate(base, [struct(feature=text(f), point=str(p), grid_value=num(g), mean_probability=f"avg({e})")
                                       for p, (g, e) in enumerate(zip(grid, shifted))])
        out = curve if out is None else out.unionByName(curve)
    if out is None:
        raise ValueError("no feature has a present value")
    return out


# ---------------------------------------------------------------- sampled attribution

def _spread(df: DataFrame, key: str, features_col: str) -> DataFrame:
    """Key and feature array, over all cores: a sample usually sits in a single partition."""
    tasks = max(2, df.sparkSession.sparkContext.defaultParallelism)
    return df.select(q(key), vector_to_array(features_col).alias("x")).repartition(tasks, q(key))


SAMPLED_SCHEMA = "feature string, value double, contribution double, base_value double, probability double"


def _row_seeds(seed: int):
    """A function from keys to random seeds; nested, so that tasks need no import of this package."""
    def seeds(keys: pd.Series) -> np.ndarray:
        return pd.util.hash_pandas_object(keys.astype(str), index=False).to_numpy() ^ np.uint64(seed)

    return seeds


def sampled_linear_attribution(df: DataFrame, model: LogisticRegressionModel, names: Sequence[str], key: str,
                               background: np.ndarray, permutations: int = 10, seed: int = 42,
                               features_col: str = "features") -> DataFrame:
    """Shapley values in probability space for a logistic model, by random permutations.

    Along one permutation the log-odds of every background row change one feature at a time,
    so a path is a cumulative sum. Contributions and base value add up to the probability
    exactly. Each row draws its permutations from its own key, independent of partitioning.
    """
    weights = model.coefficients.toArray()
    start = background @ weights + model.intercept
    base = float(np.mean(1.0 / (1.0 + np.exp(-start))))
    names = list(names)
    seeds = _row_seeds(seed)

    def explain(batches):
        for pdf in batches:
            frames = []
            for k, x, s in zip(pdf[key], pdf["x"], seeds(pdf[key])):
                x = np.asarray(x)
                step = (x - background) * weights
                rng = np.random.default_rng(int(s))
                total = np.zeros(len(names))
                for _ in range(permutations):
                    order = rng.permutation(len(names))
                    path = np.concatenate([start[:, None], start[:, None] + np.cumsum(step[:, order], axis=1)], axis=1)
                    total[order] += np.diff((1.0 / (1.0 + np.exp(-path))).mean(axis=0))
                phi = total / permutations
                frames.append(pd.DataFrame({
                    key: k, "feature": names, "value": x, "contribution": phi,
                    "base_value": base, "probability": base + phi.sum()}))
            if frames:
                yield pd.concat(frames, ignore_index=True)

    key_type = df.schema[key].dataType.simpleString()
    return (_spread(df, key, features_col)
            .mapInPandas(explain, f"{q(key)} {key_type}, {SAMPLED_SCHEMA}"))


def sampled_attribution(df: DataFrame, model: Model, names: Sequence[str], key: str, background: np.ndarray,
                        permutations: int = 1, seed: int = 42, features_col: str = "features") -> DataFrame:
    """The same for any Spark ML classifier, tree ensembles included.

    Python only builds the hybrid inputs (row values for the features already visited,
    background values for the others); the model scores them as a DataFrame. The step from
    one hybrid to the next is credited to the feature that changed, so each hybrid adds its
    probability to one feature and takes it from the next; the sums are map-side combined.
    """
    names = list(names)
    width = len(names)
    key_type = df.schema[key].dataType.simpleString()
    seeds = _row_seeds(seed)

    def hybrids(batches):
        for batch in batches:
            keys, rows = batch.column(0), batch.column(1).to_pylist()
            for i, s in enumerate(seeds(keys.to_pandas())):
                x = np.asarray(rows[i])
                rng = np.random.default_rng(int(s))
                for _ in range(permutations):
                    order = rng.permutation(width)
                    rank = np.empty(width, dtype=int)
                    rank[order] = np.arange(width)
                    taken = rank[None, :] < np.arange(width + 1)[:, None]
                    cells = np.where(taken[None, :, :], x[None, None, :], background[:, None, :])
                    n = len(background) * (width + 1)
                    yield pa.RecordBatch.from_arrays([
                        pa.repeat(keys[i], n),
                        pa.array(np.tile(np.concatenate([[-1], order]), len(background)).astype("int32")),
                        pa.array(np.tile(np.concatenate([order, [-1]]), len(background)).astype("int32")),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(n + 1, dtype="int32") * width), pa.array(cells.ravel())),
                    ], names=[key, "gains", "loses", "h"])

    inputs = _spread(df, key, features_col)
    mixed = inputs.mapInArrow(hybrids, f"{q(key)} {key_type}, gains int, loses int, h array<double>")
    scored = model.transform(mixed.withColumn(features_col, array_to_vector("h"))).select(
        q(key), "gains", "loses", vector_to_array("probability")[1].alias("p"))
    parts = scored.selectExpr(q(key), f"inline({array([
        struct(at='gains', up='p', down='0D'), struct(at='loses', up='0D', down='p')])})")
    runs = num(float(permutations * len(background)))
    summed = parts.groupBy(key, "at").agg(F.expr(f"sum(up) / {runs} AS up"), F.expr(f"sum(down) / {runs} AS down"))
    # at = -1 gains the pure background, hybrid 0, and loses the full row, the last hybrid
    per_row = summed.groupBy(key).agg(
        F.expr("max(CASE WHEN at < 0 THEN up END) AS base_value"),
        F.expr("max(CASE WHEN at < 0 THEN down END) AS probability"),
        F.expr("collect_list(CASE WHEN at >= 0 THEN struct(at, up - down AS phi) END) AS phis"))
    labels = array([text(n) for n in names])
    records = (f"transform(phis, r -> struct(get({labels}, r.at) AS feature, get(x, r.at) AS value, "
               "r.phi AS contribution))")
    return per_row.join(inputs, key).selectExpr(q(key), f"inline({records})", "base_value", "probability")


@dataclass(frozen=True)
class Leaf:
    """What a tree's leaf adds to the score, and the interval (lo, hi] of each feature on the way to it."""

    value: float
    conditions: tuple[tuple[int, float, float], ...]


def tree_leaves(model: Model) -> list[Leaf]:
    """The leaves of a fitted tree ensemble, as many as the model has. A forest adds up to the probability, boosted trees to
    the log-odds."""
    forest = isinstance(model, RandomForestClassificationModel)
    leaves: list[Leaf] = []
    for tree, weight in zip(model.trees, model.treeWeights):
        scale = 1.0 / len(model.treeWeights) if forest else 2.0 * weight
        open_ = [(tree._call_java("rootNode"), {})]
        while open_:
            node, bounds = open_.pop()
            if node.getClass().getSimpleName() == "LeafNode":
                stats = list(node.impurityStats().stats()) if forest else ()
                value = stats[1] / sum(stats) if forest else node.prediction()
                leaves.append(Leaf(scale * value, tuple((f, lo, hi) for f, (lo, hi) in sorted(bounds.items()))))
                continue
            split = node.split()
            f, cut = split.featureIndex(), split.threshold()
            lo, hi = bounds.get(f, (-math.inf, math.inf))
            open_.append((node.leftChild(), bounds | {f: (lo, min(hi, cut))}))
            open_.append((node.rightChild(), bounds | {f: (max(lo, cut), hi)}))
    return leaves


def tree_attribution(df: DataFrame, leaves: Sequence[Leaf], names: Sequence[str], key: str, background: np.ndarray,
                     log_odds: bool, features_col: str = "features") -> DataFrame:
    """Exact Shapley values of a tree ensemble against a background sample, in the units of the leaves.

    Against one background row, a leaf counts for the features that only the row satisfies and against those that only
    the background row satisfies; it counts for nothing if neither satisfies some feature. With a features of the first
    kind and b of the second, each of the first gets value * (a-1)! b! / (a+b)!, each of the second loses
    value * a! (b-1)! / (a+b)!. So no permutation is drawn, and contributions and base value add up to the score.
    """
    names = list(names)
    base = sum(leaf.value * np.mean(np.all([(background[:, f] > lo) & (background[:, f] <= hi) for f, lo, hi in leaf.conditions], axis=0))
               if leaf.conditions else leaf.value for leaf in leaves)
    deepest = max((len(leaf.conditions) for leaf in leaves), default=0)
    factorial = np.cumprod([1.0, *range(1, deepest + 1)])
    parts = [(leaf.value, leaf.conditions) for leaf in leaves if leaf.conditions]

    def explain(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 64):  # rows x background x conditions stay small
                some = pdf.iloc[at:at + 64]
                x = np.array(some["x"].tolist())
                phi = np.zeros(x.shape)
                for value, conditions in parts:
                    f = [c[0] for c in conditions]
                    lo, hi = np.array([c[1] for c in conditions]), np.array([c[2] for c in conditions])
                    row = ((x[:, f] > lo) & (x[:, f] <= hi))[:, None, :]
                    other = ((background[:, f] > lo) & (background[:, f] <= hi))[None, :, :]
                    gains, loses = row & ~other, ~row & other
                    a, b = gains.sum(2), loses.sum(2)
                    live = (row | other).all(2) & (a + b > 0)
                    up = np.where(live & (a > 0), factorial[np.maximum(a - 1, 0)] * factorial[b] / factorial[a + b], 0.0)
                    down = np.where(live & (b > 0), factorial[a] * factorial[np.maximum(b - 1, 0)] / factorial[a + b], 0.0)
                    phi[:, f] += value * ((gains * up[:, :, None]) - (loses * down[:, :, None])).mean(1)
                total = base + phi.sum(1)
                chance = 1.0 / (1.0 + np.exp(-total)) if log_odds else total
                width = len(names)
                yield pd.DataFrame({key: some[key].repeat(width).to_numpy(), "feature": names * len(some), "value": x.ravel(),
                                    "contribution": phi.ravel(), "base_value": base, "probability": chance.repeat(width)})

    key_type = df.schema[key].dataType.simpleString()
    return _spread(df, key, features_col).mapInPandas(explain, f"{q(key)} {key_type}, {SAMPLED_SCHEMA}")


def background_matrix(df: DataFrame, key: Sequence[str], n: int = 100, seed: int = 42,
                      features_col: str = "features") -> np.ndarray:
    """At most ``n`` sampled feature vectors as a matrix; bounded by ``n``."""
    rows = sample_rows(df, key, n, seed).select(vector_to_array(features_col).alias("x")).collect()
    return np.array([r["x"] for r in rows])
