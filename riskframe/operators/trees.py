"""Fitted tree ensembles as node tables: reading, pruning, staged scores, and attribution by node cover.

A tree is a set of arrays over its nodes. The nodes of a fitted model come from its written form, which is a table; a pruned
model is that table rewritten and loaded again. Trees are part of the model, so they reach the driver and the tasks as it does.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.columns import q
from riskframe.sources.writers import working_dir

NONE = -1
#: Rows attributed at a time by a task.
AT_ONCE = 256
ATTRIBUTION = "feature string, value double, contribution double, base_value double, probability double"


@dataclass(frozen=True)
class Tree:
    """Arrays over nodes, the root first and parents before children. ``left`` is -1 at a leaf; a row goes left if its value
    is at most the threshold. ``value`` is what a node adds to the score as a leaf, ``cover`` the weight and ``rows`` the
    number of training rows that reached it."""

    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    rows: np.ndarray

    @property
    def leaf(self) -> np.ndarray:
        return self.left == NONE

    def kept(self, stop: np.ndarray) -> np.ndarray:
        """Nodes that remain if those marked become leaves, parents before children."""
        reached, open_ = [], [0]
        while open_:
            node = open_.pop()
            reached.append(node)
            if not stop[node] and self.left[node] != NONE:
                open_ += [self.right[node], self.left[node]]
        return np.array(reached)

    def cut(self, stop: np.ndarray) -> Tree:
        """The tree in which marked nodes are leaves. Growing is greedy, so a node is split alike whatever happens below it:
        this is the tree that would have been grown had the marked nodes not been split."""
        kept = self.kept(stop)
        number = np.full(len(self.left), NONE)
        number[kept] = np.arange(len(kept))
        ends = stop | self.leaf
        child = lambda side: np.where(ends[kept], NONE, number[side[kept]])
        return Tree(child(self.left), child(self.right), self.feature[kept], self.threshold[kept], self.value[kept], self.cover[kept], self.rows[kept])

    def collapsed(self, min_split: int) -> Tree:
        """No node with fewer training rows is split."""
        return self.cut(self.rows < min_split)

    @property
    def depth(self) -> np.ndarray:
        out = np.zeros(len(self.left), np.int64)
        for node in np.flatnonzero(~self.leaf):  # parents come first
            out[[self.left[node], self.right[node]]] = out[node] + 1
        return out


@dataclass(frozen=True)
class Ensemble:
    """Trees whose leaf values add up, with ``start``, to log-odds or to a probability."""

    trees: tuple[Tree, ...]
    log_odds: bool
    start: float = 0.0

    def probability(self, score: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-score)) if self.log_odds else score


def node_rows(spark: SparkSession, path: str) -> pd.DataFrame:
    """One row for each node of a model written to ``path``, by tree and number."""
    rows = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), "nodeData.id", "nodeData.prediction", "nodeData.impurityStats", F.col("nodeData.rawCount").alias("rows"),
        F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"), F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"), F.col("nodeData.split.numCategories").alias("categories"))
    out = rows.toPandas().sort_values(["tree", "id"], kind="stable", ignore_index=True)
    if (out["categories"] > 0).any():
        raise ValueError("categorical splits are not read; code categories before fitting")
    return out


def _tree(rows: pd.DataFrame, value: np.ndarray, cover: np.ndarray) -> Tree:
    feature = rows["feature"].fillna(NONE).to_numpy(np.int64)
    return Tree(rows["left"].to_numpy(np.int64), rows["right"].to_numpy(np.int64), feature, rows["threshold"].fillna(0.0).to_numpy(float),
                value, cover, rows["rows"].to_numpy(np.int64))


def ensemble(model: Model) -> Ensemble:
    """The trees of a fitted forest (they add up to the probability) or of boosted trees (to the log-odds)."""
    spark = SparkSession.active()
    path = f"{working_dir(spark)}/trees/{uuid.uuid4().hex}"
    model.write().save(path)
    forest = isinstance(model, RandomForestClassificationModel)
    trees = []
    for (_, rows), weight in zip(node_rows(spark, path).groupby("tree"), model.treeWeights):
        stats = np.stack(rows["impurityStats"])
        if forest:
            trees.append(_tree(rows, stats[:, 1] / stats.sum(1) / len(model.treeWeights), stats.sum(1)))
        else:
            trees.append(_tree(rows, 2.0 * weight * rows["prediction"].to_numpy(float), stats[:, 0]))
    return Ensemble(tuple(trees), not forest)


def collapse(model: RandomForestClassificationModel, min_split: int) -> RandomForestClassificationModel:
    """The forest in which every node with fewer than ``min_split`` training rows is a leaf: its written node table is
    rewritten and loaded."""
    spark = SparkSession.active()
    path = f"{working_dir(spark)}/trees/{uuid.uuid4().hex}"
    model.write().save(f"{path}/grown")
    nodes = spark.read.parquet(f"{path}/grown/data")
    frames = []
    for number, rows in node_rows(spark, f"{path}/grown").groupby("tree"):
        grown = _tree(rows, rows["prediction"].to_numpy(float), np.zeros(len(rows)))
        kept, made = grown.kept(grown.rows < min_split), grown.collapsed(min_split)
        frames.append(pd.DataFrame({"tree": number, "old": kept, "new": np.arange(len(kept)), "l": made.left, "r": made.right}))
    names = spark.createDataFrame(pd.concat(frames, ignore_index=True), "tree int, old int, new int, l int, r int")
    is_leaf = F.col("l") == NONE
    renamed = nodes.join(names, (F.col("treeID") == F.col("tree")) & (F.col("nodeData.id") == F.col("old"))).select(
        "treeID", F.col("nodeData").withField("id", F.col("new")).withField("leftChild", F.col("l")).withField("rightChild", F.col("r"))
        .withField("gain", F.when(is_leaf, F.lit(-1.0)).otherwise(F.col("nodeData.gain")))
        .withField("split.featureIndex", F.when(is_leaf, F.lit(NONE)).otherwise(F.col("nodeData.split.featureIndex")))
        .withField("split.leftCategoriesOrThreshold", F.when(is_leaf, F.array().cast("array<double>")).otherwise(F.col("nodeData.split.leftCategoriesOrThreshold")))
        .withField("split.numCategories", F.when(is_leaf, F.lit(NONE)).otherwise(F.col("nodeData.split.numCategories"))).alias("nodeData"))
    renamed.write.parquet(f"{path}/cut/data")
    spark.read.parquet(f"{path}/grown/treesMetadata").write.parquet(f"{path}/cut/treesMetadata")
    spark.read.text(f"{path}/grown/metadata").coalesce(1).write.text(f"{path}/cut/metadata")
    return RandomForestClassificationModel.load(f"{path}/cut")


# ---------------------------------------------------------------- staged scores

@dataclass(frozen=True)
class Variant:
    """A model that a larger fit contains: its first trees, to a depth, with nodes of few rows left unsplit."""

    trees: int
    depth: int | None = None
    min_split: int = 2


def staged_scores(x: np.ndarray, trees: Iterable[Tree], variants: Sequence[Variant], count: int | None = None) -> np.ndarray:
    """(rows, variants): summed leaf values of each variant, in one walk down the trees. ``trees`` may be fewer than asked for;
    with their ``count`` they may be read one at a time."""
    shapes = sorted({(v.depth if v.depth is not None else 1 << 30, v.min_split) for v in variants})
    sums, out = np.zeros((len(shapes), len(x))), np.zeros((len(x), len(variants)))
    last = {v: min(v.trees, len(trees) if count is None else count) for v in variants}
    for number, tree in enumerate(trees, 1):
        sums += _ends(tree, shapes)[:, _leaf_of(tree, x)]
        for i, v in enumerate(variants):
            if last[v] == number:
                out[:, i] = sums[shapes.index((v.depth if v.depth is not None else 1 << 30, v.min_split))]
    return out


def _ends(tree: Tree, shapes: Sequence[tuple[int, int]]) -> np.ndarray:
    """(shapes, nodes): the value that a row on its way to a node ends with in each shape: at the first node that is too deep or
    has too few rows, else there."""
    depths, leasts = (np.array(some)[:, None] for some in zip(*shapes))
    out = np.tile(np.asarray(tree.value, float), (len(shapes), 1))
    ended, level, nodes = np.zeros((len(shapes), 1), bool), 0, np.zeros(1, np.int64)
    while len(nodes):
        inner = tree.left[nodes] != NONE
        nodes, ended = nodes[inner], ended[:, inner]
        ended = ended | (level >= depths) | (tree.rows[nodes] < leasts)
        for child in (tree.left[nodes], tree.right[nodes]):
            out[:, child] = np.where(ended, out[:, nodes], out[:, child])
        nodes, ended, level = np.concatenate([tree.left[nodes], tree.right[nodes]]), np.concatenate([ended, ended], axis=1), level + 1
    return out


def _leaf_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    at = np.zeros(len(x), np.int64)
    open_ = np.arange(len(x)) if tree.left[0] != NONE else np.zeros(0, np.int64)
    while len(open_):
        node = at[open_]
        node = np.where(x[open_, tree.feature[node]] <= tree.threshold[node], tree.left[node], tree.right[node])
        at[open_] = node
        open_ = open_[tree.left[node] != NONE]
    return at


def staged_probabilities(df: DataFrame, model: Ensemble, variants: Sequence[Variant], keep: Sequence[str], features_col: str = "features") -> DataFrame:
    """(keep, variant, probability): every variant's probability for each row. Forest values are means over the variant's trees."""
    shared = df.sparkSession.sparkContext.broadcast((model, tuple(variants)))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, asked = shared.value
        share = np.array([1.0 if fitted.log_odds else len(fitted.trees) / min(v.trees, len(fitted.trees)) for v in asked])
        for batch in batches:
            x = np.array(batch.column(0).to_pylist(), float).reshape(batch.num_rows, -1)
            p = fitted.probability(staged_scores(x, fitted.trees, asked) * share + fitted.start)
            where = pa.array(np.repeat(np.arange(batch.num_rows), len(asked)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i + 1).take(where) for i in range(len(keep))), pa.array(np.tile(np.arange(len(asked), dtype=np.int32), batch.num_rows)),
                 pa.array(p.ravel())], [*keep, "variant", "probability"])

    schema = ", ".join([*(f"{q(c)} {kinds[c]}" for c in keep), "variant int, probability double"])
    return df.select(vector_to_array(features_col).alias("__x"), *[F.col(q(c)) for c in keep]).mapInArrow(run, schema)


# ---------------------------------------------------------------- attribution by node cover

@dataclass(frozen=True)
class Path:
    """A leaf with the interval (low, high] of each feature on its way, and the share of the cover that followed the
    feature's splits down to the leaf."""

    value: float
    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray


def paths(tree: Tree) -> list[Path]:
    out, open_ = [], [(0, {})]
    while open_:
        node, on_way = open_.pop()
        if tree.left[node] == NONE:
            features = sorted(on_way)
            low, high, share = (np.array([on_way[f][k] for f in features], float) for k in range(3))
            out.append(Path(float(tree.value[node]), np.array(features, np.int64), low, high, share))
            continue
        f, cut = int(tree.feature[node]), float(tree.threshold[node])
        low, high, share = on_way.get(f, (-np.inf, np.inf, 1.0))
        for child, bounds in ((tree.left[node], (low, min(high, cut))), (tree.right[node], (max(low, cut), high))):
            part = tree.cover[child] / tree.cover[node] if tree.cover[node] else 0.0
            open_.append((int(child), on_way | {f: (*bounds, share * part)}))
    return out


def _add_path(path: Path, x: np.ndarray, phi: np.ndarray, weights: list[np.ndarray]) -> None:
    """Add one leaf's Shapley values to ``phi`` (rows, features).

    A known feature lets a row follow its split fully or not at all, an unknown one lets the cover's share follow. The product
    over features of (share + follows * t) has at t^k the summed weight of subsets of k known features: it is extended by
    one factor for each feature of the path, and each feature in turn is unwound from it.
    """
    size = len(path.features)
    follows = ((x[:, path.features] > path.low) & (x[:, path.features] <= path.high)).astype(float)
    subsets = np.zeros((len(x), size + 1))
    subsets[:, 0] = 1.0
    for j in range(size):
        subsets[:, 1:] = subsets[:, 1:] * path.share[j] + subsets[:, :-1] * follows[:, [j]]
        subsets[:, 0] *= path.share[j]
    for j in range(size):
        share, yes = path.share[j], follows[:, j] > 0
        without = np.empty((len(x), size))
        if share > 0:
            without[~yes] = subsets[~yes, :size] / share
        else:  # a feature that neither the row nor any cover follows: the others are multiplied anew
            rest = np.ones((int((~yes).sum()), 1))
            for i in range(size):
                if i != j:
                    rest = np.pad(rest * path.share[i], ((0, 0), (0, 1))) + np.pad(rest * follows[~yes, i][:, None], ((0, 0), (1, 0)))
            without[~yes] = rest
        carried = np.zeros(int(yes.sum()))
        some = subsets[yes]
        for k in range(size - 1, -1, -1):
            carried = some[:, k + 1] - share * carried
            without[yes, k] = carried
        phi[:, path.features[j]] += path.value * (follows[:, j] - share) * (without @ weights[size])


def cover_weights(deepest: int) -> list[np.ndarray]:
    """weights[m][k] = k! (m-k-1)! / m!, the Shapley weight of a subset of k of the other m-1 features."""
    out = [np.zeros(0)]
    for m in range(1, deepest + 1):
        row = [1.0 / m]
        for k in range(1, m):
            row.append(row[-1] * k / (m - k))
        out.append(np.array(row))
    return out


def cover_attribution(df: DataFrame, model: Ensemble, names: Sequence[str], key: str, features_col: str = "features") -> DataFrame:
    """Shapley values of a tree ensemble in which an unknown feature follows the training cover of the nodes.

    Units are those of the leaves: log-odds for boosted trees, probability for a forest. The base value is the cover-weighted
    mean of the leaves; contributions and base value add up to the score. No background rows are needed.
    """
    names, found = list(names), [p for tree in model.trees for p in paths(tree)]
    base = model.start + sum(p.value * float(np.prod(p.share)) for p in found)
    shared = df.sparkSession.sparkContext.broadcast([p for p in found if len(p.features)])
    weights = cover_weights(max((len(p.features) for p in found), default=0))
    log_odds = model.log_odds

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), AT_ONCE):
                some = pdf.iloc[at:at + AT_ONCE]
                x = np.array(some["x"].tolist(), float).reshape(len(some), len(names))
                phi = np.zeros(x.shape)
                for path in shared.value:
                    _add_path(path, x, phi, weights)
                total = base + phi.sum(1)
                chance = 1.0 / (1.0 + np.exp(-total)) if log_odds else total
                yield pd.DataFrame({key: some[key].repeat(len(names)).to_numpy(), "feature": names * len(some), "value": x.ravel(),
                                    "contribution": phi.ravel(), "base_value": base, "probability": chance.repeat(len(names))})

    tasks = max(2, df.sparkSession.sparkContext.defaultParallelism)
    spread = df.select(q(key), vector_to_array(features_col).alias("x")).repartition(tasks, q(key))  # a sample lies in few tasks
    return spread.mapInPandas(explain, f"{q(key)} {df.schema[key].dataType.simpleString()}, {ATTRIBUTION}")


def from_nested(nested, columns: Sequence[str], scale: float = 1.0) -> Tree:
    """A tree from nested tuples: (column, threshold, left, right), or (value, cover) for a leaf."""
    nodes: list[list] = []

    def add(node) -> int:
        at = len(nodes)
        nodes.append([NONE, NONE, NONE, 0.0, 0.0, 0.0])
        if len(node) == 2:
            nodes[at][4:] = [scale * node[0], float(node[1])]
        else:
            left, right = add(node[2]), add(node[3])
            nodes[at] = [left, right, columns.index(node[0]), float(node[1]), 0.0, nodes[left][5] + nodes[right][5]]
        return at

    add(nested)
    left, right, feature, threshold, value, cover = (np.array(c) for c in zip(*nodes))
    return Tree(left, right, feature, threshold, value, cover, cover.astype(np.int64))
