"""Cleaning steps, each a DataFrame -> DataFrame function usable with ``df.transform``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.config import RAW_KEY, TARGET, TARGET_SOURCE_NAMES
from riskframe.functions.columns import FLOATING, finite_or_null, names_of, q, with_expressions


def drop_surrogate_key(df: DataFrame, key: str = RAW_KEY) -> DataFrame:
    return df.drop(key)


def canonical_target(df: DataFrame, names: Sequence[str] = TARGET_SOURCE_NAMES,
                     target: str = TARGET) -> DataFrame:
    """Rename the first known spelling of the label; the others are left alone."""
    if target in df.columns:
        return df
    found = next((n for n in names if n in df.columns), None)
    return df if found is None else df.withColumnRenamed(found, target)


def find_target(df: DataFrame, names: Sequence[str] = (TARGET, *TARGET_SOURCE_NAMES),
                last_column_fallback: bool = False) -> str:
    for name in names:
        if name in df.columns:
            return name
    if last_column_fallback:
        return df.columns[-1]
    raise ValueError(f"no target column among {list(names)}")


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def nulls_for_non_finite(df: DataFrame) -> DataFrame:
    """NaN and infinities become null, so aggregates skip them."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, FLOATING)]
    return with_expressions(df, {c: finite_or_null(c) for c in floating})


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without any null or NaN in the columns (all by default).

    One predicate per column: the scan can use each, and the optimizer handles them one by one.
    """
    tests = []
    for f in df.schema.fields:
        if columns is None or f.name in columns:
            tests.append(f"{q(f.name)} IS NOT NULL")
            if isinstance(f.dataType, FLOATING):
                tests.append(f"NOT isnan({q(f.name)})")
    return df.where(" AND ".join(tests)) if tests else df


def group_copies(df: DataFrame, key: str | None = None) -> DataFrame:
    """One row per distinct set of attributes with its number of ``copies``.

    With ``key`` the smallest key of each group of copies stays with it. The aggregation
    combines map-side, so a group of copies of any size collapses before the shuffle.
    """
    attributes = [c for c in df.columns if c != key]
    kept = [F.min(q(key)).alias(key)] if key in df.columns else []
    return df.groupBy(*names_of(attributes)).agg(*kept, F.count("*").alias("copies"))


def drop_repeated(df: DataFrame, key: str | None = None) -> DataFrame:
    """Keep one row per distinct set of attributes, under its smallest key if there is one."""
    if key is None or key not in df.columns:
        return df.dropDuplicates()
    return group_copies(df, key).select(*names_of(df.columns))


def fill_missing_with_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Non-finite and missing numeric cells become 0."""
    chosen = set(df.columns if columns is None else columns)
    filled = {}
    for f in df.schema.fields:
        if f.name in chosen and isinstance(f.dataType, T.NumericType):
            present = finite_or_null(f.name) if isinstance(f.dataType, FLOATING) else q(f.name)
            filled[f.name] = f"coalesce({present}, CAST(0 AS {f.dataType.simpleString()}))"
    return with_expressions(df, filled)


def clean_accounts(df: DataFrame, key: str | None = None) -> DataFrame:
    """Key dropped or kept as representative, label renamed, incomplete and repeated rows gone.

    ``key`` names a surrogate key to carry along; copies are still found on the attributes
    alone. Infinite money counts as present here; ``fill_missing_with_zero`` clears it after the
    features are built.
    """
    if key != RAW_KEY:
        df = drop_surrogate_key(df)
    df = canonical_target(df)
    attributes = [c for c in df.columns if c != key]
    return drop_repeated(drop_incomplete(df, attributes), key)


def project_features(df: DataFrame, target: str = TARGET) -> tuple[list[str], str]:
    """Names of the feature columns and of the label, after checking the label is there."""
    require_columns(df, [target])
    return [c for c in df.columns if c != target], target
