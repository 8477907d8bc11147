"""Data quality, numeric profiles, drift and outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.config import TARGET
from riskframe.functions.bounded import reused
from riskframe.functions.columns import add_all, array, double, names_of, num, numeric_columns, q, struct, text
from riskframe.functions.quantiles import exact_quantiles
from riskframe.operators.clean import group_copies


def quality(df: DataFrame, columns: Sequence[str] | None = None, method: str = "exact") -> DataFrame:
    """Rows, columns, missing cells and repeated rows, from one grouping of the table.

    Equal rows collapse map-side, so the shuffle carries distinct rows only. ``hashed``
    shuffles a 128-bit digest per row instead of the row itself.
    """
    columns = list(columns or df.columns)
    cells = names_of(columns)
    if method == "exact":
        return quality_of_groups(group_copies(df.select(*cells)), columns)
    if method != "hashed":
        raise ValueError("method must be 'exact' or 'hashed'")
    digest = f"md5(to_json(struct({', '.join(cells)})))"
    groups = (df.selectExpr(f"{digest} AS digest", f"{_null_count(columns)} AS nulls")
              .groupBy("digest", "nulls").agg(F.count("*").alias("copies")))
    return _quality_totals(groups, len(columns))


def quality_of_groups(groups: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same from a table of distinct rows that carries the number of ``copies``: no shuffle."""
    return _quality_totals(groups.selectExpr("copies", f"{_null_count(columns)} AS nulls"), len(columns))


def _null_count(columns: Sequence[str]) -> str:
    return add_all([f"CAST({q(c)} IS NULL AS BIGINT)" for c in columns])


def _quality_totals(groups: DataFrame, width: int) -> DataFrame:
    totals = groups.agg(
        F.expr("coalesce(sum(copies), 0) AS rows"), F.expr("count(*) AS distinct_rows"),
        F.expr("coalesce(sum(copies * nulls), 0) AS missing_count"))
    return totals.selectExpr(
        "rows", f"CAST({width} AS BIGINT) AS columns", "missing_count",
        f"coalesce(try_divide(missing_count * 100D, rows * {width}), 0D) AS missing_percentage",
        "rows - distinct_rows AS duplicate_count",
        "coalesce(try_divide((rows - distinct_rows) * 100D, rows), 0D) AS duplicate_percentage",
    )


def target_distribution(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.selectExpr(f"{q(target)} AS value").where("value IS NOT NULL").groupBy("value").agg(
        F.count("*").alias("n"))


def _moments(c: str) -> dict[str, str]:
    x = double(c)
    return {"column": text(c), "n": f"count({x})", "mean": f"avg({x})", "std": f"stddev_samp({x})",
            "min": f"min({x})", "max": f"max({x})"}


def _as_rows(wide: DataFrame, n: int, keep: Sequence[str] = ()) -> DataFrame:
    """Struct columns c0..cn-1 of a small aggregate as rows."""
    return wide.selectExpr(*keep, f"inline({array([f'c{i}' for i in range(n)])})")


def moment_profile(df: DataFrame, columns: Sequence[str] | None = None,
                   by: str | None = None) -> DataFrame:
    """Long table (column, n, mean, std, min, max) from one aggregate, optionally per group."""
    columns = list(columns or numeric_columns(df, exclude=[by] if by else []))
    groups = [by] if by else []
    wide = df.groupBy(*groups).agg(*[
        F.expr(struct(**_moments(c))).alias(f"c{i}") for i, c in enumerate(columns)])
    return _as_rows(wide, len(columns), groups)


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None,
                    accuracy: int | None = None) -> DataFrame:
    """Mean, sample deviation, extremes and median of every numeric column.

    The median is exact; ``accuracy`` switches to Spark's approximate percentile and a single
    pass. The result says which one was used.
    """
    columns = list(columns or numeric_columns(df))
    if accuracy is not None:
        wide = df.agg(*[
            F.expr(struct(**_moments(c), median=f"percentile_approx({double(c)}, 0.5D, {accuracy})",
                          median_mode="'approximate'")).alias(f"c{i}")
            for i, c in enumerate(columns)
        ])
        return _as_rows(wide, len(columns))
    with reused(df.select(*names_of(columns))) as table:
        rows = moment_profile(table, columns).collect()
        medians = exact_quantiles(table, columns, [0.5])
    schema = ("column string, n bigint, mean double, std double, min double, max double, "
              "median double, median_mode string")
    filled = [(*r, medians[r["column"]][0], "exact") for r in rows]
    return df.sparkSession.createDataFrame(filled, schema)


def _judge_drift(paired: DataFrame, threshold: float) -> DataFrame:
    """|mean shift| in baseline deviations; a constant baseline drifts when its mean moves at all."""
    shift = "abs(current_mean - baseline_mean)"
    scored = (f"CASE WHEN baseline_std > 0 THEN {shift} / baseline_std WHEN {shift} = 0 THEN 0D "
              f"WHEN {shift} > 0 THEN double('Infinity') END")
    return paired.selectExpr("*", f"{scored} AS score").selectExpr(
        "*", f"coalesce(score > {num(float(threshold))}, false) AS drifted")


def drift(baseline: DataFrame, current: DataFrame, threshold: float = 0.1, keep: Sequence[str] = ()) -> DataFrame:
    """Compare two profiles by column: one row per column in the baseline, one per column and values of ``keep`` in the other."""
    b = baseline.selectExpr("column", "mean AS baseline_mean", "std AS baseline_std")
    c = current.selectExpr("column", "mean AS current_mean", *names_of(keep))
    return _judge_drift(b.join(c, "column"), threshold)


def group_drift(df: DataFrame, group: str, baseline, current, columns: Sequence[str],
                threshold: float = 0.1) -> DataFrame:
    """Drift between two groups of one table, both profiled in the same pass."""
    profile = moment_profile(df.where(F.col(group).isin(baseline, current)), columns, by=group)
    is_baseline = F.col(group) == F.lit(baseline)
    paired = profile.withColumn("b", is_baseline).groupBy("column").agg(
        F.expr("max(CASE WHEN b THEN mean END) AS baseline_mean"),
        F.expr("max(CASE WHEN b THEN std END) AS baseline_std"),
        F.expr("max(CASE WHEN NOT b THEN mean END) AS current_mean"))
    return _judge_drift(paired, threshold)


def _statistics(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    rows = moment_profile(df, columns).collect()
    return {r["column"]: (r["mean"], r["std"]) for r in rows}


def z_score(column: str, mean: float | None, std: float | None) -> str:
    if mean is None or not std:
        return "CAST(NULL AS DOUBLE)"
    return f"(({double(column)} - {num(mean)}) / {num(std)})"


def outlier_counts(df: DataFrame, columns: Sequence[str] | None = None,
                   threshold: float = 3.0) -> DataFrame:
    """Values further than ``threshold`` sample deviations from the mean, per column."""
    columns = list(columns or numeric_columns(df))
    cut = num(float(threshold))
    with reused(df.select(*names_of(columns))) as table:
        stats = _statistics(table, columns)
        wide = table.agg(*[
            F.expr(struct(column=text(c), n=f"count({q(c)})",
                          outliers=f"count_if(abs({z_score(c, *stats[c])}) > {cut})")).alias(f"c{i}")
            for i, c in enumerate(columns)
        ])
        rows = _as_rows(wide, len(columns)).collect()
    return df.sparkSession.createDataFrame(rows, "column string, n bigint, outliers bigint")


def with_outlier_flags(df: DataFrame, columns: Sequence[str], threshold: float = 3.0) -> DataFrame:
    """Add ``outlier_columns``: the names of the columns in which a row is an outlier."""
    stats = _statistics(df, columns)
    cut = num(float(threshold))
    names = [f"CASE WHEN abs({z_score(c, *stats[c])}) > {cut} THEN {text(c)} END" for c in columns]
    return df.selectExpr("*", f"array_compact({array(names)}) AS outlier_columns")
