"""Deterministic splits, folds and samples driven by a hash of the row key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.config import TARGET, SplitConfig
from riskframe.functions.bounded import join_lookup
from riskframe.functions.columns import HASH_SPACE, hash32, names_of, num, q
from riskframe.operators.clean import require_columns

BUCKET_BITS = 16


def hash_split(df: DataFrame, key: Sequence[str], config: SplitConfig = SplitConfig()) -> DataFrame:
    """Add ``is_test``. The share holds in expectation, also within every class; no shuffle."""
    cut = int(round(config.test_share * HASH_SPACE))
    return df.selectExpr("*", f"{hash32(key, config.seed)} < {cut} AS is_test")


def _class_quotas(counts: DataFrame, share: float) -> DataFrame:
    """Test rows per class: ceil(share * rows) in total, largest remainders rounded up.

    The windows run over one row per class.
    """
    sized = counts.groupBy("cls").agg(F.sum("n").alias("n_cls")).selectExpr(
        "cls", "n_cls", "sum(n_cls) OVER () AS n_all",
    ).selectExpr("cls", "n_cls", "n_all", f"ceil(n_all * {num(float(share))}) AS n_test")
    based = sized.selectExpr(
        "cls", "n_test", "floor(n_test * n_cls / n_all) AS base",
        "n_test * n_cls / n_all - floor(n_test * n_cls / n_all) AS rest")
    return based.selectExpr(
        "cls", "base + CAST(row_number() OVER (ORDER BY rest DESC, cls ASC NULLS LAST)"
               " <= n_test - sum(base) OVER () AS BIGINT) AS quota")


def exact_split(df: DataFrame, key: Sequence[str], config: SplitConfig = SplitConfig(),
                label: str = TARGET) -> DataFrame:
    """Add ``is_test`` so that the test sizes are exact, per class when stratified.

    The rows with the smallest hashes of each class are the test rows. A histogram over 2^16
    hash ranges finds the range in which the quota falls, and only that range is ordered:
    about one row in 65,000. ``key`` must identify a row.
    """
    if config.stratify:
        require_columns(df, [label])
    cls = q(label) if config.stratify else "0"
    hashed = df.selectExpr("*", f"{hash32(key, config.seed)} AS h", f"{cls} AS cls")
    ranged = hashed.selectExpr("*", f"shiftright(h, {32 - BUCKET_BITS}) AS bucket")
    counts = ranged.groupBy("cls", "bucket").agg(F.count("*").alias("n"))
    running = counts.selectExpr("cls", "bucket", "n", "sum(n) OVER (PARTITION BY cls ORDER BY bucket) AS upto")
    quotas = _class_quotas(counts, config.test_share)
    cuts = running.alias("r").join(quotas.alias("q"), F.expr("r.cls <=> q.cls")).where(
        "upto >= quota AND upto - n < quota",
    ).selectExpr("r.cls AS cut_cls", "bucket AS cut_bucket", "quota - (upto - n) AS take")
    at_cut = join_lookup(ranged, cuts, F.expr("cls <=> cut_cls AND bucket = cut_bucket"), "inner")
    keys = ", ".join(names_of(key))
    last = at_cut.selectExpr(
        "*", f"row_number() OVER (PARTITION BY cls ORDER BY h, {keys}) AS rn",
    ).where("rn = take").selectExpr("cls AS last_cls", f"struct(h, {keys}) AS edge")
    marked = join_lookup(hashed, last, F.expr("cls <=> last_cls"), "left")
    return marked.selectExpr(
        *names_of(df.columns), f"edge IS NOT NULL AND struct(h, {keys}) <= edge AS is_test")


def train_and_test(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    return marked.where("NOT is_test").drop("is_test"), marked.where("is_test").drop("is_test")


def with_fold(df: DataFrame, key: Sequence[str], folds: int = 5, seed: int = 42, label: str | None = TARGET) -> DataFrame:
    """Add ``fold`` in [0, folds), of equal size within every class, from a hash that is independent of the split.

    Each class is cut where its running count over 2^16 hash ranges passes the next share, so a fold misses its share of a
    class by one range at most: about one row in 65,000. Without ``label`` all rows are one class.
    """
    cls, h = (q(label) if label else "0"), hash32(key, seed + 1)
    bucket = f"shiftright({h}, {32 - BUCKET_BITS})"
    counts = df.selectExpr(f"{cls} AS cls", f"{bucket} AS bucket").groupBy("cls", "bucket").agg(F.count("*").alias("n"))
    running = counts.selectExpr("cls", "bucket", "sum(n) OVER (PARTITION BY cls ORDER BY bucket) AS upto",
                                "sum(n) OVER (PARTITION BY cls) AS n_cls")
    # the last hash range of each fold but the last, one row for each class
    last = [f"min(CASE WHEN upto * {folds} >= n_cls * {k} THEN bucket END)" for k in range(1, folds)]
    ends = running.groupBy("cls").agg(F.expr(f"CAST(array({', '.join(last)}) AS ARRAY<BIGINT>)").alias("ends")).withColumnRenamed("cls", "fold_cls")
    marked = join_lookup(df.selectExpr("*", f"{cls} AS fold_of", f"{bucket} AS fold_bucket"), ends, F.expr("fold_of <=> fold_cls"), "left")
    return marked.selectExpr(*names_of(df.columns), "CAST(size(filter(ends, e -> e < fold_bucket)) AS INT) AS fold")


def sample_rows(df: DataFrame, key: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """At most ``n`` rows without replacement: those with the smallest hashes.

    A histogram of the hashes (it reads the key columns only) finds the range that holds the
    n-th row, so the ordered part is ``n`` rows and the rest of one range, not ``n`` rows from
    every task.
    """
    h = hash32(key, seed)
    bucket = f"shiftright({h}, {32 - BUCKET_BITS})"
    counts = df.selectExpr(f"{bucket} AS bucket").groupBy("bucket").agg(F.count("*").alias("n"))
    cut = counts.selectExpr("bucket", "sum(n) OVER (ORDER BY bucket) AS upto").where(
        f"upto >= {n}").agg(F.min("bucket")).first()[0]
    kept = df if cut is None else df.where(f"{bucket} <= {cut}")
    return kept.orderBy(F.expr(h), *names_of(key)).limit(n)
