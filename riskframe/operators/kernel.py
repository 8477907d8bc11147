"""Kernel-weighted attribution for any classifier: coalitions of features, and one weighted least-squares solution.

A coalition takes some features from the row and the others from background rows; its value is the mean probability of
these hybrids. Contributions are the weighted least-squares fit of the values by the features taken, under the constraint
that they add up. All rows have the same coalitions, so the solution is one matrix, worked out once: the contributions are
sums of coalition values times its entries, an aggregate over the coalition table.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import array, num, q, struct, text


@dataclass(frozen=True)
class Coalitions:
    """``masks`` (coalitions, features): which features come from the row; the first row is empty, the last is full.
    ``solve`` (features, coalitions): the contribution of a feature is the sum of its entries times the coalition values."""

    masks: np.ndarray
    solve: np.ndarray


def shapley_kernel(size: int, width: int) -> float:
    """Weight of one coalition of ``size`` out of ``width`` features."""
    return (width - 1) / (math.comb(width, size) * size * (width - size))


def drawn_masks(width: int, count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Proper coalitions and their weights: all of them if they are few enough, else drawn by the kernel in pairs of a
    coalition and the rest, with their number as weight."""
    if 2 ** width - 2 <= count:
        masks = np.array([m for m in itertools.product((0, 1), repeat=width) if 0 < sum(m) < width]).reshape(-1, width)
        return masks, np.array([shapley_kernel(int(m.sum()), width) for m in masks])
    draw, sizes = np.random.default_rng(seed), np.arange(1, width)
    share = (width - 1) / (sizes * (width - sizes))
    masks = np.zeros((count // 2 * 2, width), np.int64)
    for i, size in enumerate(draw.choice(sizes, count // 2, p=share / share.sum())):
        masks[2 * i, draw.choice(width, size, replace=False)] = 1
        masks[2 * i + 1] = 1 - masks[2 * i]
    masks, times = np.unique(masks, axis=0, return_counts=True)
    return masks, times.astype(float)


def eliminated(a: np.ndarray, b: np.ndarray) -> np.ndarray | None:
    """x with a x = b by elimination with pivots; None if ``a`` is singular. Plain array operations: threads of a linear
    algebra library were seen to hang in a driver beside the JVM."""
    n, wide = len(a), np.concatenate([a, b], 1).astype(float)
    least = 1e-10 * np.abs(a).max()
    for i in range(n):
        pivot = i + int(np.abs(wide[i:, i]).argmax())
        if abs(wide[pivot, i]) <= least:
            return None
        wide[[i, pivot]] = wide[[pivot, i]]
        wide[i] /= wide[i, i]
        others = np.arange(n) != i
        wide[others] -= wide[others, i][:, None] * wide[i]
    return wide[:, n:]


def coalitions(width: int, count: int = 2048, seed: int = 42) -> Coalitions:
    """Coalitions and the matrix that solves the constrained least squares for any values. One feature gets the difference.

    Minimising sum w (v - v0 - z phi)^2 under sum phi = v1 - v0: the last feature is eliminated, the rest follows from the
    normal equations; a tiny ridge stands in where too few coalitions were drawn.
    """
    if width < 1:
        raise ValueError("at least one feature is needed")
    masks, weights = drawn_masks(width, count, seed) if width > 1 else (np.zeros((0, 1), np.int64), np.zeros(0))
    n = len(masks)
    solve = np.zeros((width, n + 2))
    if n:
        x = (masks[:, :-1] - masks[:, [-1]]).astype(float)
        weighted = x * weights[:, None]
        normal = np.einsum("ci,cj->ij", weighted, x)
        part = eliminated(normal, weighted.T)  # (features - 1, coalitions)
        if part is None:
            part = eliminated(normal + 1e-9 * np.trace(normal) * np.eye(width - 1), weighted.T)
        last = masks[:, -1]
        solve[:-1, 1:-1] = part
        solve[:-1, 0] = -(part * (1 - last)).sum(1)
        solve[:-1, -1] = -(part * last).sum(1)
    solve[-1] = -solve[:-1].sum(0)
    solve[-1, 0] -= 1.0
    solve[-1, -1] += 1.0
    return Coalitions(np.concatenate([np.zeros((1, width), np.int64), masks, np.ones((1, width), np.int64)]), solve)


def kernel_attribution(df: DataFrame, model: Model, names: Sequence[str], key: str, background: np.ndarray, count: int = 2048,
                       seed: int = 42, features_col: str = "features") -> DataFrame:
    """(key, feature, value, contribution, base_value, probability) by kernel weights, for at most the rows of a sample.

    Tasks only build the hybrids; the model scores them as a DataFrame. What is summed has one row for each row, coalition
    and background row, and is combined before the shuffle.
    """
    names = list(names)
    made = coalitions(len(names), count, seed)
    spark, kind = df.sparkSession, df.schema[key].dataType.simpleString()
    shared = spark.sparkContext.broadcast((made.masks.astype(bool), np.asarray(background, float)))

    def hybrids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks, behind = shared.value
        width = masks.shape[1]
        at_once = max(1, 200_000 // (len(behind) * width))  # coalitions of a batch
        for batch in batches:
            keys = batch.column(0)
            for i, x in enumerate(batch.column(1).to_pylist()):
                for first in range(0, len(masks), at_once):
                    some = masks[first:first + at_once]
                    cells = np.where(some[:, None, :], np.asarray(x, float), behind[None]).reshape(-1, width)
                    n = len(cells)
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(keys[i], n), pa.array(np.repeat(np.arange(first, first + len(some), dtype=np.int32), len(behind))),
                         pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(cells.ravel()))], [key, "c", "h"])

    tasks = max(2, spark.sparkContext.defaultParallelism)
    inputs = df.select(q(key), vector_to_array(features_col).alias("x")).repartition(tasks, q(key))  # a sample lies in few tasks
    mixed = inputs.mapInArrow(hybrids, f"{q(key)} {kind}, c int, h array<double>")
    scored = model.transform(mixed.withColumn(features_col, array_to_vector("h"))).select(q(key), "c", vector_to_array("probability")[1].alias("p"))
    # one row for each coalition, a number set by the caller
    table = spark.createDataFrame([(i, made.solve[:, i].tolist()) for i in range(len(made.masks))], "c int, solve array<double>")
    shares = num(1.0 / len(background))
    sums = scored.join(F.broadcast(table), "c").groupBy(key).agg(
        F.expr(f"sum(CASE WHEN c = 0 THEN p END) * {shares} AS base_value"),
        F.expr(f"sum(CASE WHEN c = {len(made.masks) - 1} THEN p END) * {shares} AS probability"),
        *[F.expr(f"sum(p * solve[{i}]) * {shares} AS phi_{i}") for i in range(len(names))])
    records = array([struct(feature=text(n), value=f"x[{i}]", contribution=f"phi_{i}") for i, n in enumerate(names)])
    return sums.join(inputs, key).selectExpr(q(key), f"inline({records})", "base_value", "probability")
