"""Exact quantiles of many columns without gathering a column in one task.

Every table goes one way. Each wanted order statistic starts with an open value range. While a range holds more than
``ORDERED_ROWS`` values, mergeable sketches of the values inside propose two of them, the rows below, at and between are
counted, and the part that holds the rank becomes the range. Sketches only propose: the counts decide, and each part is
smaller than the whole. What is left is ordered and read. Interpolation happens in one place.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import array, double, num, q, struct

#: Values of a range that one task may order. Speed depends on it, results don't.
ORDERED_ROWS = 20_000
MERGE_GROUPS = 256
SKETCH_SIZE = 800
BRANCH = 12
MARGIN = 0.006


@dataclass(frozen=True)
class Range:
    """The values of a column strictly between two of them (or an open end), and how many come up to its lower end."""

    column: str
    lo: float | None = None
    hi: float | None = None
    upto: int = 0
    between: int = 0

    @property
    def value(self) -> str:
        return double(self.column)

    def inside(self) -> str:
        ends = [f"{self.value} IS NOT NULL"]
        if self.lo is not None:
            ends.append(f"{self.value} > {num(float(self.lo))}")
        if self.hi is not None:
            ends.append(f"{self.value} < {num(float(self.hi))}")
        return f"({' AND '.join(ends)})"


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of the present values, one list per column."""
    if not columns:
        return {}
    counts = df.agg(*[F.count(F.expr(double(c))) for c in columns]).first()
    sizes = dict(zip(columns, counts))
    positions = {(c, p): p * (sizes[c] - 1) for c in columns if sizes[c] for p in probabilities}
    wanted = {(c, rank): Range(c, between=sizes[c]) for (c, _), at in positions.items()
              for rank in (math.floor(at), math.ceil(at))}
    known = _order_statistics(df, wanted)

    def interpolated(c: str, p: float) -> float | None:
        if not sizes[c]:
            return None
        at = positions[c, p]
        lower, upper = known[c, math.floor(at)], known[c, math.ceil(at)]
        return lower if lower == upper else lower + (upper - lower) * (at - math.floor(at))

    return {c: [interpolated(c, p) for p in probabilities] for c in columns}


def split_points(df: DataFrame, column: str, parts: int) -> list[float]:
    """Increasing values that cut a column into about ``parts`` ranges of equal row counts."""
    wanted = array([num(i / parts) for i in range(1, parts)])
    partial = df.selectExpr(f"spark_partition_id() % {MERGE_GROUPS} AS g", f"{double(column)} AS v").groupBy("g").agg(
        F.expr(f"kll_sketch_agg_double(v, {SKETCH_SIZE}) AS s"))
    row = partial.agg(F.expr(f"kll_merge_agg_double(s, {SKETCH_SIZE}) AS s")).selectExpr(
        f"kll_sketch_get_quantile_double(s, {wanted}) AS edges").first()
    return sorted(set(row.edges))


def _order_statistics(df: DataFrame, wanted: dict[tuple[str, int], Range]) -> dict[tuple[str, int], float]:
    """The value at each (column, rank), ranks counted from 0."""
    known: dict[tuple[str, int], float] = {}
    while wide := {k: r for k, r in wanted.items() if k not in known and r.between > ORDERED_ROWS}:
        pairs = _propose(df, wide)
        counts = _count(df, list(dict.fromkeys((r, pairs[k]) for k, r in wide.items())))
        for key, r in wide.items():
            a, b = pairs[key]
            below, at_a, between, at_b = counts[r, (a, b)]
            offset = key[1] - r.upto
            if offset < below:
                wanted[key] = replace(r, hi=a, between=below)
            elif offset < below + at_a:
                known[key] = a
            elif offset < below + at_a + between:
                wanted[key] = replace(r, lo=a, hi=b, upto=r.upto + below + at_a, between=between)
            elif offset < below + at_a + between + at_b:
                known[key] = b
            else:
                passed = below + at_a + between + at_b
                wanted[key] = replace(r, lo=b, upto=r.upto + passed, between=r.between - passed)
    return known | _ordered(df, {k: r for k, r in wanted.items() if k not in known})


def _propose(df: DataFrame, wide: dict[tuple[str, int], Range]) -> dict[tuple[str, int], tuple[float, float]]:
    """Two values inside each range, likely just below and above the rank. Targets in one range share its sketch."""
    ranges = list(dict.fromkeys(wide.values()))
    cells = [f"CASE WHEN {r.inside()} THEN {r.value} END AS v{i}" for i, r in enumerate(ranges)]
    partial = df.selectExpr(f"spark_partition_id() % {MERGE_GROUPS} AS g", *cells).groupBy("g").agg(
        *[F.expr(f"kll_sketch_agg_double(v{i}, {SKETCH_SIZE}) AS s{i}") for i in range(len(ranges))])
    merged = partial.agg(*[F.expr(f"kll_merge_agg_double(s{i}, {SKETCH_SIZE}) AS s{i}") for i in range(len(ranges))])
    asked = []
    for i, (key, r) in enumerate(wide.items()):
        share = (key[1] - r.upto + 0.5) / r.between
        ends = array([num(max(0.0, share - MARGIN)), num(min(1.0, share + MARGIN))])
        asked.append(f"kll_sketch_get_quantile_double(s{ranges.index(r)}, {ends}) AS q{i}")
    row = merged.selectExpr(*asked).first()
    return {key: (min(row[i]), max(row[i])) for i, key in enumerate(wide)}


def _count(df: DataFrame, splits: list[tuple[Range, tuple[float, float]]]) -> dict:
    """Rows of each range below, at and between the two proposed values, and at the second if it is another one."""
    found = None
    # a few splits per branch keep the generated method small; each branch scans its own columns
    for at in range(0, len(splits), BRANCH):
        part = list(enumerate(splits))[at:at + BRANCH]
        cells = []
        for i, (r, (a, b)) in part:
            below, between = replace(r, hi=a), Range(r.column, a, b)
            second = f"count_if({r.value} = {num(float(b))})" if b > a else "0L"
            cells.append(F.expr(struct(
                b=str(i), below=f"count_if({below.inside()})", at_a=f"count_if({r.value} = {num(float(a))})",
                between=f"count_if({between.inside()})", at_b=second)).alias(f"c{i}"))
        counts = df.agg(*cells).selectExpr(f"inline({array([f'c{i}' for i, _ in part])})")
        found = counts if found is None else found.unionAll(counts)
    rows = {r.b: (r.below, r.at_a, r.between, r.at_b) for r in found.collect()}
    return {split: rows[i] for i, split in enumerate(splits)}


def _ordered(df: DataFrame, wanted: dict[tuple[str, int], Range]) -> dict[tuple[str, int], float]:
    """Order the distinct values of each small range and read the wanted ranks."""
    if not wanted:
        return {}
    ranges = list(dict.fromkeys(wanted.values()))
    found = None
    for at in range(0, len(ranges), BRANCH):
        cells = array([f"CASE WHEN {r.inside()} THEN {struct(b=str(at + i), v=r.value)} END" for i, r in enumerate(ranges[at:at + BRANCH])])
        branch = df.selectExpr(f"inline({cells})").where("v IS NOT NULL")
        found = branch if found is None else found.unionAll(branch)
    running = found.groupBy("b", "v").count().selectExpr("b", "v", "sum(count) OVER (PARTITION BY b ORDER BY v) AS upto")
    ranks: dict[int, list[int]] = {i: [] for i in range(len(ranges))}
    for (_, rank), r in wanted.items():
        ranks[ranges.index(r)].append(rank - r.upto)
    # one row for each range and wanted rank: the smallest value with more than rank values up to it
    offsets = array([array([f"{x}L" for x in sorted(set(ranks[i]))]) for i in range(len(ranges))])
    rows = running.selectExpr("b", "v", "upto", f"explode(get({offsets}, b)) AS rank").where("upto > rank").groupBy("b", "rank").agg(
        F.min("v").alias("v")).collect()
    values = {(r.b, r["rank"]): r.v for r in rows}
    return {key: values[ranges.index(r), key[1] - r.upto] for key, r in wanted.items()}
